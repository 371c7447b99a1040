import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from servicerank.operators import numbering
from servicerank.operators.numbering import ordered_row_ids


def brute_force(data, order):
    def key(row):
        rest = [c for c in range(len(row)) if c not in order]
        return [(row[i] is not None, row[i] if row[i] is not None else 0) for i in [*order, *rest]]

    return sorted((i + 1, *row) for i, row in enumerate(sorted(data, key=key)))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ids_follow_the_order(spark, partitions):
    rng = random.Random(partitions)
    data = [(rng.choice([None, *range(20)]), rng.choice("abc"), rng.randrange(5)) for _ in range(500)]
    df = spark.createDataFrame(data, "a long, b string, c long").repartition(7)
    got = ordered_row_ids(df, ["b", "a"], "id", partitions)
    assert got.columns == ["id", "a", "b", "c"]
    assert sorted(tuple(r) for r in got.collect()) == brute_force(data, [1, 0])


def test_hot_copies_are_spread(spark):
    # A third of the rows are one row; ranges of about 100 rows.
    data = [(1, "hot")] * 500 + [(i, "x") for i in range(1000)]
    df = spark.createDataFrame(data, "a long, b string")
    got = ordered_row_ids(df, ["a"], "id", partitions=15)
    assert sorted(tuple(r) for r in got.collect()) == brute_force(data, [0])
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 500


def test_ids_do_not_depend_on_partitioning(spark):
    data = [(i % 17, str(i % 5)) for i in range(300)]
    df = spark.createDataFrame(data, "a long, b string")
    results = [rows(ordered_row_ids(df.repartition(n), ["a"], "id", n)) for n in (2, 9)]
    assert results[0] == results[1]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "a long, b string")
    assert ordered_row_ids(empty, ["a"], "id").collect() == []


def test_one_shuffle_and_as_many_ranges_as_the_rows_need(spark, monkeypatch):
    written = []

    def write(df, label):
        written.append((label, df))
        return store(df, label)

    store = numbering.materialize
    monkeypatch.setattr(numbering, "materialize", write)
    monkeypatch.setattr(numbering, "ROWS_PER_TASK", 100)
    df = spark.range(450).select((F.col("id") % 7).alias("a"), F.col("id").cast("string").alias("b"))
    got = ordered_row_ids(df, ["a"], "id")
    assert [label for label, _ in written] == ["row-ids"]
    plan = written[0][1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan and ", 5)" in plan
    assert sorted(r.id for r in got.collect()) == list(range(1, 451))


def test_rows_of_a_shuffle_are_settled_first(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("a"), F.lit("x").alias("b")).repartition(5)
    got = ordered_row_ids(df, ["a"], "id", 4, settle=True)
    assert sorted(tuple(r) for r in got.collect()) == brute_force([(i % 3, "x") for i in range(300)], [0])
