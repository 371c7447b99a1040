from datetime import date, datetime

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from servicerank.operators.calendar import Calendar
from servicerank.operators.facts import fact_date
from servicerank.schemas import SNAPSHOT_COLUMNS
from servicerank.sources.lake import append_lake, load_summary, read_lake
from servicerank.sources.snapshots import to_lake_rows
from servicerank.sources.warehouse import (
    load_day, load_queue_fact, load_reviews_fact, load_time_dimension, read_queue_fact, read_reviews_fact,
    read_time_dimension,
)

CALENDAR = Calendar(origin=datetime(2024, 3, 1), minutes=31 * 1440)


def snapshots(spark, days, points=3):
    data = [
        (str(p), str(p + d), "60", "1", "True", f"24/03/{d:02d} 10:{p:02d}:00") for d in days for p in range(points)
    ]
    columns = "id string, currently_waiting string, expected_wait_time string, active_counters string, is_open string, time string"
    return to_lake_rows(spark.createDataFrame(data, columns), F.col("time"))


@pytest.fixture
def lake(spark, tmp_path):
    path = str(tmp_path / "lake")
    append_lake(snapshots(spark, range(4, 10)), path)
    return read_lake(spark, path)


def test_lake_round_trip(spark, tmp_path, lake):
    assert lake.columns == [*SNAPSHOT_COLUMNS, "ingest_date"]
    append_lake(snapshots(spark, [10]), str(tmp_path / "lake"))
    assert rows(load_summary(spark, str(tmp_path / "lake"))) == [(21, 32)]


def test_backfill_then_days_equal_one_backfill(spark, tmp_path, lake):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    load_queue_fact(lake, a, date(2024, 3, 4), date(2024, 3, 8), CALENDAR)
    load_day(lake, a, date(2024, 3, 9), calendar=CALENDAR)
    load_day(lake, a, date(2024, 3, 10), calendar=CALENDAR)
    load_queue_fact(lake, b, date(2024, 3, 4), date(2024, 3, 10), CALENDAR, rebalance=True)
    assert rows(read_queue_fact(spark, a)) == rows(read_queue_fact(spark, b))
    stored = read_queue_fact(spark, a)
    assert stored.filter(F.col("fact_date") != fact_date(CALENDAR)).count() == 0


def test_rerun_of_a_day_replaces_or_appends(spark, tmp_path, lake):
    path = str(tmp_path / "fact")
    load_queue_fact(lake, path, date(2024, 3, 4), date(2024, 3, 8), CALENDAR)
    before = rows(read_queue_fact(spark, path))
    load_day(lake, path, date(2024, 3, 5), calendar=CALENDAR)
    assert rows(read_queue_fact(spark, path)) == before
    load_day(lake, path, date(2024, 3, 5), mode="append", calendar=CALENDAR)
    assert read_queue_fact(spark, path).count() == len(before) + 3
    with pytest.raises(ValueError, match="mode"):
        load_day(lake, path, date(2024, 3, 5), mode="merge")


def test_rerun_of_a_day_without_snapshots_empties_it(spark, tmp_path, lake):
    path = str(tmp_path / "fact")
    load_queue_fact(lake, path, date(2024, 3, 4), date(2024, 3, 8), CALENDAR)
    load_day(lake.filter("id = 'none'"), path, date(2024, 3, 5), calendar=CALENDAR)
    kept = {str(r.fact_date) for r in read_queue_fact(spark, path).select("fact_date").distinct().collect()}
    assert kept == {"2024-03-05", "2024-03-06", "2024-03-07"}


def test_backfill_replaces_the_table(spark, tmp_path, lake):
    path = str(tmp_path / "fact")
    load_queue_fact(lake, path, date(2024, 3, 4), date(2024, 3, 8), CALENDAR)
    load_queue_fact(lake, path, date(2024, 3, 6), date(2024, 3, 7), CALENDAR)
    assert read_queue_fact(spark, path).count() == 3


def test_day_load_prunes_partitions_and_pushes_the_range(spark, lake):
    from servicerank.operators.facts import queue_fact_of_day

    shown = plan(queue_fact_of_day(lake, date(2024, 3, 6), calendar=CALENDAR, vouched=True))
    assert "PartitionFilters: [isnotnull(ingest_date" in shown
    assert "GreaterThanOrEqual(time,24/03/05 00:00:00)" in shown
    assert "Exchange" not in shown
    # Columns the fact does not need are not read.
    assert "name:string" not in shown


def test_time_dimension_and_reviews_round_trip(spark, tmp_path):
    load_time_dimension(spark, str(tmp_path / "time"), CALENDAR)
    assert read_time_dimension(spark, str(tmp_path / "time")).count() == CALENDAR.minutes
    raw = spark.createDataFrame(
        [(1, 1_709_251_200_000_000_000, 5, 1, "good")],
        "id_bq long, Date long, Rating int, Helpful_count int, Review string",
    )
    for _ in range(2):
        load_reviews_fact(raw, str(tmp_path / "reviews"), CALENDAR)
    assert rows(read_reviews_fact(spark, str(tmp_path / "reviews"))) == [(1, 1, 1, 5, 1, "good")]
