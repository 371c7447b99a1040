import json
from datetime import date, datetime, timedelta

import pytest
from helpers import plan, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from servicerank.operators.calendar import Calendar
from servicerank.operators.facts import queue_fact
from servicerank.schemas import SNAPSHOT_COLUMNS
from servicerank.sources import files, ledger
from servicerank.sources.lake import append_lake, ingest_snapshots, load_summary, open_lake, read_lake
from servicerank.sources.ledger import BatchLake, ConflictError, landed_batch
from servicerank.sources.snapshots import to_lake_rows
from servicerank.sources.warehouse import load_day, load_queue_fact, read_queue_fact

CALENDAR = Calendar(origin=datetime(2024, 3, 1), minutes=31 * 1440)
COLUMNS = "id string, currently_waiting string, expected_wait_time string, active_counters string, is_open string, time string"


def snapshots(spark, days, points=3, minute=0):
    data = [
        (str(p), str(p + d), "60", "1", "True", f"24/03/{d:02d} 10:{minute + p:02d}:00") for d in days for p in range(points)
    ]
    return to_lake_rows(spark.createDataFrame(data, COLUMNS), F.col("time"))


@pytest.fixture
def lake(spark, tmp_path):
    return BatchLake(spark, str(tmp_path / "lake"))


def test_a_batch_counts_once(spark, lake):
    assert lake.read().count() == 0 and rows(lake.summary()) == [(0, 32)]
    assert lake.append(snapshots(spark, [4, 5]), "run-1")
    before = rows(lake.read())
    assert not lake.append(snapshots(spark, [4, 5]), "run-1")
    assert rows(lake.read()) == before and len(before) == 6
    # The rerun wrote nothing, not even files that nobody reads.
    assert {f.path.split("batch=")[1][:6] for f in files.stored(spark, lake.data)} == {"run-1."}
    assert lake.append(snapshots(spark, [5]), "run-2")
    assert rows(lake.summary()) == [(9, 32)]
    assert lake.read().columns == [*SNAPSHOT_COLUMNS, "ingest_date"]
    assert rows(lake.batches().select("batch", "rows", "first_time", "files")) == [
        ("run-1", 6, "2024-03-04 10:00:00", lake.batches().filter("batch = 'run-1'").first().files),
        ("run-2", 3, "2024-03-05 10:00:00", lake.batches().filter("batch = 'run-2'").first().files),
    ]


def test_an_attempt_killed_midway_is_not_read(spark, lake):
    lake.append(snapshots(spark, [4]), "run-1")
    lake._write(snapshots(spark, [4, 5]), "run-2.dead")
    assert lake.read().count() == 3
    assert lake.append(snapshots(spark, [5]), "run-2")
    assert lake.read().count() == 6
    assert lake.vacuum() == 0, "may be under way"
    assert lake.vacuum(timedelta(0)) > 0
    assert lake.read().count() == 6
    assert "run-2.dead" not in "".join(f.path for f in files.stored(spark, lake.data, hidden=True))


def test_of_two_attempts_one_is_committed(spark, lake, monkeypatch):
    lake.append(snapshots(spark, [4]), "run-1")
    # The second attempt looked before the first one was committed.
    monkeypatch.setattr(files, "exists", lambda *_: False)
    assert not lake.append(snapshots(spark, [4]), "run-1")
    monkeypatch.undo()
    assert lake.read().count() == 3
    assert len({f.path.split("/")[-3] for f in files.stored(spark, lake.data)}) == 1


def test_a_failing_batch_leaves_nothing(spark, lake):
    broken = snapshots(spark, [4]).withColumn("name", F.raise_error(F.lit("lost")))
    with pytest.raises((PySparkException, Py4JJavaError)):
        lake.append(broken, "run-1")
    assert lake.read().count() == 0
    assert lake.append(snapshots(spark, [4]), "run-1")
    assert lake.read().count() == 3


def test_publish_is_for_one(spark, tmp_path):
    path = str(tmp_path / "made" / "entry.json")
    assert files.publish(spark, path, {"a": 1})
    assert not files.publish(spark, path, {"a": 2})
    assert json.loads((tmp_path / "made" / "entry.json").read_text()) == {"a": 1}


def test_packing_bounds_files_and_keeps_rows(spark, lake):
    for n in range(6):
        lake.append(snapshots(spark, [4, 5], points=40).repartition(4), f"run-{n}")
    lake.append(snapshots(spark, [9]).coalesce(1), "alone")
    before, running = rows(lake.read()), lake.read()
    day = lambda d: [f for p in lake._parts() if p.day == d for f in files.stored(spark, f"{lake.data}/batch={p.folder}/ingest_date={d}")]
    assert len(day("2024-03-04")) >= 24
    assert lake.pack() >= 48
    assert len(day("2024-03-04")) <= 2 and len(day("2024-03-05")) <= 2 and len(day("2024-03-09")) == 1
    assert rows(lake.read()) == before
    # A reader that began before goes on, and summaries and reruns are what they were.
    assert rows(running) == before
    assert rows(lake.summary()) == [(483, 32)]
    assert not lake.append(snapshots(spark, [4, 5]), "run-3")
    assert lake.pack() == 0
    lake.vacuum(timedelta(0))
    assert rows(lake.read()) == before
    lake.append(snapshots(spark, [4]), "later")
    assert lake.pack(days=[date(2024, 3, 5)]) == 0
    assert lake.pack(days=[date(2024, 3, 4)]) >= 2 and lake.read().count() == len(before) + 3


def test_a_busy_day_gets_several_files(spark, lake):
    for n in range(4):
        lake.append(snapshots(spark, [4], points=50, minute=0).repartition(6), f"run-{n}")
    size = sum(p.bytes for p in lake._parts())
    lake.pack(file_bytes=size // 5)
    assert 3 <= sum(p.files for p in lake._parts()) <= 7
    assert lake.read().count() == 200


def test_a_packed_file_holds_a_bounded_number_of_rows(spark, lake, monkeypatch):
    monkeypatch.setattr(ledger, "FILE_ROWS", 40)
    for n in range(4):
        lake.append(snapshots(spark, [4, 5], points=50).repartition(6), f"run-{n}")
    before = rows(lake.read())
    assert lake.pack() > 0 and rows(lake.read()) == before
    # The same four rows are in one file.
    held = lake.read().groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("*")).first()
    assert held[0] <= 60 and 10 <= held[1] <= 12
    assert lake.pack() == 0


def test_two_packings_do_not_both_count(spark, lake, monkeypatch):
    for n in range(3):
        lake.append(snapshots(spark, [4]), f"run-{n}")
    other = BatchLake(spark, lake.path)
    parts = lake._parts()
    assert other.pack() > 0
    monkeypatch.setattr(lake, "_last_pack", lambda: 0)
    monkeypatch.setattr(lake, "_parts", lambda: parts)
    with pytest.raises(ConflictError):
        lake.pack()
    monkeypatch.undo()
    assert lake.read().count() == 9


def test_loads_prune_what_the_ledger_vouches_for(spark, lake, tmp_path):
    lake.append(snapshots(spark, range(4, 10)), "checked")
    shown = plan(lake.window(date(2024, 3, 5), date(2024, 3, 6)))
    assert "GreaterThanOrEqual(time,24/03/05 00:00:00)" in shown
    assert "/ingest_date=2024-03-05]" in shown and "ingest_date=2024-03-06" not in shown
    path = str(tmp_path / "fact")
    load_queue_fact(open_lake(spark, lake.path), path, date(2024, 3, 4), date(2024, 3, 8), CALENDAR)
    load_day(open_lake(spark, lake.path), path, date(2024, 3, 9), calendar=CALENDAR)
    whole = queue_fact(read_lake(spark, lake.path), date(2024, 3, 4), date(2024, 3, 9), CALENDAR)
    assert rows(read_queue_fact(spark, path).drop("fact_date")) == rows(whole)


@pytest.mark.parametrize("time", ["None", "2024-03-05 10:00:00"])
def test_malformed_times_of_unchecked_batches_still_fail(spark, lake, time):
    lake.append(snapshots(spark, [4, 5]), "checked")
    odd = snapshots(spark, [5]).withColumn("time", F.lit(time))
    lake.append(odd, "odd")
    assert rows(lake.batches().select("batch", "malformed")) == [("checked", 0), ("odd", 3)]
    for day in (5, 20):
        with pytest.raises((PySparkException, Py4JJavaError)):
            queue_fact(lake, date(2024, 3, day), date(2024, 3, day + 1), CALENDAR).collect()


def test_rows_in_another_days_folder_are_found(spark, lake):
    moved = snapshots(spark, [5]).withColumn("ingest_date", F.lit("2024-03-07").cast("date"))
    lake.append(snapshots(spark, [4, 5]), "checked")
    lake.append(moved, "moved")
    lake.append(snapshots(spark, [6]).withColumn("ingest_date", F.lit(None).cast("date")), "no-day")
    assert queue_fact(lake, date(2024, 3, 5), date(2024, 3, 6), CALENDAR).count() == 6
    assert queue_fact(lake, date(2024, 3, 6), date(2024, 3, 8), CALENDAR).count() == 3
    assert lake.pack() == 0 or lake.read().count() == 12


def test_ingest_names_what_has_landed(spark, tmp_path):
    src, path = tmp_path / "src", str(tmp_path / "lake")
    src.mkdir()
    (src / "a.json").write_text('[{"id": "1"}, {"id": "2"}]')
    stamp = datetime(2024, 3, 4, 10)
    name = landed_batch(spark, str(src))
    for _ in range(2):
        summary = ingest_snapshots(spark, str(src), path, batch_time=stamp, batch=landed_batch(spark, str(src)))
        assert rows(summary) == [(2, 32)]
    (src / "b.json").write_text('[{"id": "3"}]')
    assert landed_batch(spark, str(src)) != name
    assert rows(load_summary(spark, path)) == [(2, 32)]
    with pytest.raises(ValueError, match="ledger"):
        append_lake(snapshots(spark, [4]), path)
    plain = str(tmp_path / "plain")
    append_lake(snapshots(spark, [4]), plain)
    with pytest.raises(ValueError, match="no ledger"):
        ingest_snapshots(spark, str(src), plain, batch_time=stamp, batch="x")
    assert read_lake(spark, path, plain).count() == 5
    with pytest.raises(ValueError, match="named by"):
        BatchLake(spark, path).append(snapshots(spark, [4]), "a/b")
