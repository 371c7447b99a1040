import random
from datetime import date, datetime

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from servicerank.operators.calendar import Calendar
from servicerank.operators.peaks import fold_waits, merge_folds
from servicerank.plans.report import ranked_report, rush_hour_waits, rush_hour_waits_of_state, service_point_matrix_of_state
from servicerank.schemas import LOAD, WAIT, reviews_fact_schema, rush_state_schema, service_point_schema
from servicerank.sources.lake import append_lake, read_lake
from servicerank.sources.snapshots import to_lake_rows
from servicerank.sources.warehouse import (
    load_day, load_queue_fact, read_queue_fact, read_rush_state, refresh_rush_state,
)

CALENDAR = Calendar(origin=datetime(2024, 3, 1), minutes=31 * 1440)
COLUMNS = "id string, currently_waiting string, expected_wait_time string, active_counters string, is_open string, time string"


def snapshots(spark, days, seed):
    rng = random.Random(seed)
    data = [
        (
            str(rng.randrange(3)), rng.choice(["None", *map(str, range(6))]), rng.choice(["None", str(rng.randrange(3000))]), "1",
            rng.choice(["True", "True", "False"]), f"24/03/{d:02d} {rng.randrange(8, 12):02d}:{rng.randrange(60):02d}:00",
        )
        for d in days for _ in range(120)
    ]
    return to_lake_rows(spark.createDataFrame(data, COLUMNS), F.col("time"))


@pytest.fixture
def paths(spark, tmp_path):
    made = {n: str(tmp_path / n) for n in ("lake", "queue", "state")}
    append_lake(snapshots(spark, range(4, 20), 1), made["lake"])
    load_queue_fact(read_lake(spark, made["lake"]), made["queue"], date(2024, 3, 4), date(2024, 3, 15), CALENDAR)
    refresh_rush_state(spark, made["queue"], made["state"], calendar=CALENDAR)
    return made


def same_waits(spark, paths):
    want = rush_hour_waits(read_queue_fact(spark, paths["queue"]), CALENDAR)
    got = rush_hour_waits_of_state(read_rush_state(spark, paths["state"]), CALENDAR)
    assert rows(got) == rows(want) != []


def test_state_follows_replaced_and_appended_days(spark, paths):
    same_waits(spark, paths)
    lake = read_lake(spark, paths["lake"])
    load_day(lake, paths["queue"], date(2024, 3, 16), calendar=CALENDAR, state=paths["state"])
    same_waits(spark, paths)
    append_lake(snapshots(spark, [15, 10], 2), paths["lake"])
    lake = read_lake(spark, paths["lake"])
    for _ in range(2):
        load_day(lake, paths["queue"], date(2024, 3, 16), calendar=CALENDAR, state=paths["state"])
        same_waits(spark, paths)
    before = read_queue_fact(spark, paths["queue"]).count()
    load_day(lake, paths["queue"], date(2024, 3, 11), mode="append", calendar=CALENDAR, state=paths["state"])
    assert read_queue_fact(spark, paths["queue"]).count() > before
    same_waits(spark, paths)
    # A day that is loaded as empty is gone from the state.
    load_day(lake.filter("id = 'none'"), paths["queue"], date(2024, 3, 16), calendar=CALENDAR, state=paths["state"])
    same_waits(spark, paths)


def test_a_refresh_reads_one_day_and_a_report_no_fact(spark, paths):
    one_day = read_queue_fact(spark, paths["queue"]).filter(F.col("fact_date") == F.lit(date(2024, 3, 5)))
    assert "PartitionFilters: [isnotnull(fact_date" in plan(one_day)
    state = read_rush_state(spark, paths["state"])
    assert state.columns == [*rush_state_schema().names, "fact_date"]
    reviews = spark.createDataFrame([(i, i % 3, 1, i % 5 + 1, i % 3, "t") for i in range(20)], reviews_fact_schema())
    points = spark.createDataFrame(
        [(p, f"P{p}", None, None, None, None, None, None, None, 40 + p, p + 1) for p in range(3)], service_point_schema()
    )
    shown = plan(service_point_matrix_of_state(state, reviews, points, CALENDAR))
    assert paths["state"] in shown and paths["queue"] not in shown
    fact = read_queue_fact(spark, paths["queue"])
    want = ranked_report(fact, reviews, points, CALENDAR, safe=True)
    assert rows(ranked_report(state, reviews, points, CALENDAR, safe=True, of_state=True)) == rows(want)


def test_folds_merge_into_the_fold_of_all_rows(spark):
    rng = random.Random(3)
    data = [(rng.randrange(2), rng.randrange(3), rng.choice([None, 1, 2]), rng.choice([None, rng.randrange(90)])) for _ in range(300)]
    df = spark.createDataFrame(data, f"id long, slot long, {LOAD} long, {WAIT} long")
    parts = [fold_waits(df.filter(F.hash(*df.columns) % 3 == k), "id", "slot", LOAD, WAIT) for k in (-2, -1, 0, 1, 2)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    want = fold_waits(df, "id", "slot", LOAD, WAIT)
    assert rows(merge_folds(whole, "id", "slot", LOAD).select(want.columns)) == rows(want)
