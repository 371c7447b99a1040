from datetime import date, datetime

import pytest
from helpers import plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from servicerank.operators.audit import rejected_times
from servicerank.operators.calendar import Calendar, join_time_id, time_dimension
from servicerank.operators.facts import queue_fact, queue_fact_of_day, reviews_fact
from servicerank.operators.staging import queue_spec, stage_typed
from servicerank.schemas import queue_fact_schema, reviews_fact_schema

SCHEMA = "id string, time string, currently_waiting string, expected_wait_time string, active_counters string, is_open string"
MARCH = Calendar(origin=datetime(2024, 3, 1), minutes=31 * 1440)
DATA = [
    ("1", "24/03/03 23:59:59", "1", "60", "2", "True"),
    ("1", "24/03/04 00:00:00", "2", "None", "2", "true"),
    ("1", "24/03/04 00:00:40", "3", "12.0", "", "yes"),
    ("2", "24/03/21 23:59:59", "nan", "90", "1", "False"),
    ("2", "24/03/22 00:00:00", "4", "90", "1", "False"),
]


def lake(spark, data=DATA):
    return spark.createDataFrame(data, SCHEMA)


def test_backfill_is_half_open_and_keeps_duplicates(spark):
    got = queue_fact(lake(spark), date(2024, 3, 4), date(2024, 3, 22), MARCH)
    assert [f.dataType for f in got.schema] == [f.dataType for f in queue_fact_schema()]
    first = 3 * 1440 + 1
    assert rows(got) == [
        (1, first, 2, None, 2, True),
        (1, first, 3, None, None, None),
        (2, 21 * 1440, None, 90, 1, False),
    ]


@pytest.mark.parametrize("vouched", [True, False])
def test_arithmetic_fact_equals_join(spark, vouched):
    got = queue_fact(lake(spark), date(2024, 3, 1), date(2024, 4, 1), MARCH, vouched=vouched)
    typed = stage_typed(lake(spark), queue_spec())
    want = join_time_id(typed, "time_format", time_dimension(spark, MARCH)).select(got.columns)
    assert rows(got) == rows(want)


def test_times_outside_the_calendar_are_dropped(spark):
    short = Calendar(origin=datetime(2024, 3, 4), minutes=1)
    got = queue_fact(lake(spark), date(2000, 1, 1), date(2100, 1, 1), short)
    assert [r.time_id for r in got.collect()] == [1, 1]


def test_daily_takes_the_day_before(spark):
    got = queue_fact_of_day(lake(spark), date(2024, 3, 5), calendar=MARCH, entity="place")
    assert got.columns[0] == "place"
    assert sorted(r.customers_currently_waiting for r in got.collect()) == [2, 3]


def test_bad_id_or_time_fails_the_load(spark):
    for bad in (("x", "24/03/04 00:00:00"), ("1", "None")):
        with pytest.raises(PySparkException):
            queue_fact(lake(spark, [(*bad, "1", "1", "1", "True")]), date(2024, 3, 4), date(2024, 3, 5)).collect()


def test_malformed_times_fail_in_every_layout(spark):
    rows_ = lake(spark, [("1", t, "1", "1", "1", "True") for t in ("24/03/04 10:00:00", "garbage", "2024-03-04 10:00:00")])
    for layout in (rows_, rows_.withColumn("ingest_date", F.lit(date(2024, 3, 4)))):
        with pytest.raises(PySparkException):
            queue_fact(layout, date(2024, 3, 4), date(2024, 3, 5)).collect()
    got = {r.reason: (r.n_texts, r.n_rows) for r in rejected_times(rows_).collect()}
    assert got == {"malformed": (2, 2), "outside the calendar": (0, 0)}


def test_pushdown_reaches_the_scan_and_nothing_shuffles(spark, tmp_path):
    lake(spark).write.parquet(str(tmp_path / "lake"))
    stored = spark.read.schema(SCHEMA).parquet(str(tmp_path / "lake"))
    shown = plan(queue_fact(stored, date(2024, 3, 4), date(2024, 3, 22), vouched=True))
    assert "GreaterThanOrEqual(time,24/03/04 00:00:00)" in shown
    assert "LessThan(time,24/03/22 00:00:00)" in shown
    assert "Exchange" not in shown


def test_reviews(spark):
    nanos = 1_000_000_000
    start = 1_709_251_200  # 2024-03-01 00:00:00
    data = [
        (7, (start + 59) * nanos + nanos // 2, 5, 0, "late"),  # rounds into minute 2
        (7, start * nanos, 1, 3, "first"),
        (8, start * nanos, None, None, None),
        (9, (start - 60) * nanos, 4, 0, "before the calendar"),
    ]
    raw = spark.createDataFrame(data, "id_bq long, Date long, Rating int, Helpful_count int, Review string")
    got = reviews_fact(raw, MARCH)
    assert got.columns == reviews_fact_schema().names
    # Id 1 goes to the review that the calendar drops.
    assert rows(got) == [
        (2, 7, 1, 1, 3, "first"),
        (3, 8, 1, None, None, None),
        (4, 7, 2, 5, 0, "late"),
    ]


def test_reviews_load_leaves_no_work_table(spark, tmp_path):
    from pathlib import Path

    from servicerank.session import shared_dir
    from servicerank.sources.warehouse import load_reviews_fact, read_reviews_fact

    raw = spark.createDataFrame([(7, 1, 5, 0, "a")], "id_bq long, Date long, Rating int, Helpful_count int, Review string")
    before = {p.name for p in Path(shared_dir(spark)).iterdir()}
    load_reviews_fact(raw, f"{tmp_path}/reviews", Calendar(origin=datetime(1970, 1, 1)))
    assert read_reviews_fact(spark, f"{tmp_path}/reviews").count() == 1
    assert {p.name for p in Path(shared_dir(spark)).iterdir()} == before
