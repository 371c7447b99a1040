import random

import pytest
from helpers import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from servicerank.operators.calendar import Calendar
from servicerank.operators.imputation import add_far_means, group_means, impute_group_mean, spread_over_salts
from servicerank.plans.report import imputed_wait, open_queue


def frame(spark, data, key="long"):
    return spark.createDataFrame(data, f"id long, load {key}, wait long")


def window_form(df):
    mean = F.avg("wait").over(Window.partitionBy("load")) / 60
    return df.withColumn("filled", F.coalesce(F.col("wait") / 60, mean))


def rounded(df):
    return rows(df.withColumn("filled", F.round("filled", 9)))


def test_missing_values_take_the_mean_of_their_group(spark):
    df = frame(spark, [(1, 50, 60), (2, 50, 180), (3, 50, None), (4, None, 120), (5, None, None), (6, 7, None)])
    got = {r.id: r.filled for r in impute_group_mean(df, "wait", "load", "filled").collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 2.0, 4: 2.0, 5: 2.0, 6: None}


# Keys beyond the dense range, some negative, take the salted path.
@pytest.mark.parametrize("dense_keys,salts", [(65_536, 64), (5, 1), (5, 8), (0, 3)])
def test_equals_window_form(spark, dense_keys, salts):
    rng = random.Random(dense_keys)
    keys = [None, -7, 0, 1, 2, 4, 5, 6, 2**40]
    # One key of the salted path holds a third of the rows.
    data = [
        (i, 2**40 if i % 3 == 0 else rng.choice(keys), rng.choice([None, rng.randrange(1000)])) for i in range(2000)
    ]
    df = frame(spark, data)
    got = impute_group_mean(df, "wait", "load", "filled", dense_keys=dense_keys, salts=salts)
    assert got.columns == ["id", "load", "wait", "filled"]
    assert rounded(got) == rounded(window_form(df))


def test_text_keys(spark):
    df = frame(spark, [(1, "a", 60), (2, "a", None), (3, None, None), (4, None, 30), (5, "b", None)], "string")
    assert rounded(impute_group_mean(df, "wait", "load", "filled")) == rounded(window_form(df))


def test_identical_rows_are_all_kept(spark):
    df = frame(spark, [(1, 99_999_999, None)] * 50 + [(1, 99_999_999, 60)] + [(2, 3, None)] * 50)
    got = impute_group_mean(df, "wait", "load", "filled")
    assert got.count() == 101
    assert got.filter("filled = 1").count() == 51


def test_broadcast_is_bounded_by_the_key_range(spark, tmp_path):
    frame(spark, [(i, i % 10, i) for i in range(1000)]).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    shown = plan(impute_group_mean(stored, "wait", "load", "filled"))
    # Scans: rows and means of each part; those of the second part skip row groups by key.
    assert shown.count("Scan parquet") >= 4
    assert "LessThan(load,0),GreaterThan(load,65535)" in shown
    assert "GreaterThanOrEqual(load,0),LessThanOrEqual(load,65535)" in shown
    assert "Window" not in shown and "Cartesian" not in shown and "NestedLoop" not in shown


def test_closed_rows_neither_count_nor_appear(spark):
    queue = spark.createDataFrame(
        [(1, 1, 5, 60, 1, True), (1, 2, 5, None, 1, True), (1, 3, 5, 600, 1, False), (1, 4, 5, 600, 1, None)],
        "service_point_id long, time_id long, customers_currently_waiting long, expected_wait_time long, "
        "active_counters long, is_open boolean",
    )
    assert open_queue(queue).count() == 2
    assert [r.expected_wait_time_imputed for r in imputed_wait(queue, Calendar()).collect()] == [1.0, 1.0]


@pytest.mark.parametrize("salt_rows", [7, 100])
def test_salted_means_equal_window_form(spark, salt_rows):
    rng = random.Random(salt_rows)
    keys = [None, -7, 3, 2**40, 2**41]
    data = [(i % 50, 2**40 if i % 3 == 0 else rng.choice(keys), rng.choice([None, 60, 90])) for i in range(3000)]
    df = frame(spark, data)
    got = impute_group_mean(df, "wait", "load", "filled", dense_keys=0, salts=16, salt_rows=salt_rows)
    assert rounded(got) == rounded(window_form(df))


def test_equal_rows_reach_many_salts_and_small_keys_one_copy(spark, tmp_path):
    hot = spark.range(200_000).select(F.lit(1).alias("id"), F.lit(10**9).alias("load"), F.lit(None).cast("long").alias("wait"))
    rest = frame(spark, [(2, 10**9, 60), (3, 10**9 + 1, None), (4, 10**9 + 1, 120)])
    hot.unionByName(rest).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    means = group_means(df, "wait", "load")
    joined = add_far_means(df.filter("wait IS NULL"), means, "load", "load", salt_rows=2_000)
    assert joined.groupBy("load", "group_mean").count().orderBy("load").collect() == [(10**9, 60.0, 200_000), (10**9 + 1, 120.0, 1)]
    salts = spread_over_salts(df.filter("wait IS NULL"), "load", 2_000)
    per_salt = {(r.load, r._salt): r["count"] for r in salts.groupBy("load", "_salt").count().collect()}
    assert len(per_salt) == 101 and max(per_salt.values()) <= 2_100
    assert per_salt[10**9 + 1, 0] == 1
