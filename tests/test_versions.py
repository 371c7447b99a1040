import uuid
from datetime import date, datetime, timedelta

import pytest
from helpers import plan, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from servicerank.operators.audit import audit_keys, duplicate_keys
from servicerank.operators.calendar import Calendar, join_calendar, time_dimension
from servicerank.schemas import queue_fact_schema
from servicerank.sources import files
from servicerank.sources.versions import current_version, drop_old_versions, swap_table
from servicerank.sources.warehouse import load_day, read_queue_fact, replace_table, store_bucketed


@pytest.fixture
def name():
    return f"table_{uuid.uuid4().hex}"


def test_a_failing_rebuild_leaves_the_old_rows(spark, tmp_path, name):
    path, df = str(tmp_path / "t"), spark.range(5)
    swap_table(df, path, name=name)
    broken = df.withColumn("id", F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises((PySparkException, Py4JJavaError)):
        replace_table(broken, path, name=name)
    assert spark.table(name).count() == 5
    assert spark.read.parquet(current_version(spark, path)).count() == 5


def test_other_sessions_read_by_name_and_readers_survive_a_swap(spark, tmp_path, name):
    path = str(tmp_path / "t")
    replace_table(spark.range(5).withColumn("day", F.lit(date(2024, 3, 4))), path, ["day"], name=name)
    running = spark.read.parquet(current_version(spark, path))
    other = spark.newSession()
    assert other.table(name).count() == 5
    # Once swapped, always swapped.
    replace_table(spark.range(9).withColumn("day", F.lit(date(2024, 3, 5))), path, ["day"])
    assert spark.read.parquet(current_version(spark, path)).count() == 9
    replace_table(spark.range(7).withColumn("day", F.lit(date(2024, 3, 5))), path, ["day"], name=name)
    assert rows(other.table(name)) == [(i, date(2024, 3, 5)) for i in range(7)]
    assert running.count() == 5
    assert drop_old_versions(spark, path) == 0
    assert drop_old_versions(spark, path, timedelta(0)) > 0
    assert other.sql(f"SELECT max(id) FROM {name}").first()[0] == 6
    assert len({f.path.split("/data/")[1].split("/")[0] for f in files.stored(spark, f"{path}/data")}) == 1


def test_a_table_without_rows_has_a_name_too(spark, tmp_path, name):
    empty = spark.range(0).withColumn("day", F.lit(date(2024, 3, 4)))
    replace_table(empty, str(tmp_path / "t"), ["day"], name=name)
    assert spark.table(name).schema.simpleString() == "struct<id:bigint,day:date>" and spark.table(name).count() == 0


def test_plain_tables_stay_plain(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        replace_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3 and current_version(spark, path) == path


def test_days_load_into_the_current_version(spark, tmp_path):
    from test_warehouse import CALENDAR, snapshots

    from servicerank.sources.warehouse import load_queue_fact

    path, lake = str(tmp_path / "fact"), snapshots(spark, range(4, 10))
    load_queue_fact(lake, path, date(2024, 3, 4), date(2024, 3, 6), CALENDAR, swap=True)
    load_queue_fact(lake, path, date(2024, 3, 4), date(2024, 3, 8), CALENDAR)
    for _ in range(2):
        load_day(lake, path, date(2024, 3, 9), calendar=CALENDAR)
    assert read_queue_fact(spark, path).count() == 15


def test_bucketed_fact_is_joined_and_audited_without_moving_it(spark, tmp_path, name):
    calendar = Calendar(origin=datetime(2024, 1, 1), minutes=5000)
    data = [(i % 6, i % 600 * 10 + 1, i % 5, None, 1, True) for i in range(4000)]
    plain = spark.createDataFrame(data, queue_fact_schema())
    dimension = time_dimension(spark, calendar)
    fact = store_bucketed(plain, name, str(tmp_path / "fact"), ["time_id"], 4)
    dim = store_bucketed(dimension, f"{name}_time", str(tmp_path / "time"), ["time_id"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_calendar(fact, dim)
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        assert "SelectedBucketsCount: 4 out of 4" in plan(joined)
        assert rows(joined) == rows(join_calendar(plain, dimension))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    key = ["service_point_id", "time_id"]
    assert "Exchange" not in plan(duplicate_keys(fact, key)) and "Exchange" in plan(duplicate_keys(plain, key))
    assert rows(duplicate_keys(fact, key)) == rows(duplicate_keys(plain, key)) != []
    assert rows(audit_keys(fact, key, {}, {"time_id": calendar})) == rows(audit_keys(plain, key, {}, {"time_id": calendar}))
    assert len(list(files.stored(spark, str(tmp_path / "fact")))) == 4
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP TABLE {name}_time")
