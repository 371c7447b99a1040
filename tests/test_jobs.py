import json

from helpers import rows

from servicerank.jobs import main
from servicerank.schemas import REPORT_CRITERIA, reviews_schema, service_point_schema
from servicerank.sources.snapshots import feed_schema


def snapshot(key, waiting, wait):
    blank = dict.fromkeys(feed_schema().names)
    return {**blank, "id": str(key), "currently_waiting": waiting, "expected_wait_time": wait, "is_open": True}


def test_from_landed_files_to_report(spark, tmp_path, capsys):
    path = {n: str(tmp_path / n) for n in ("src", "lake", "streamed", "queue", "raw", "reviews", "points", "time", "report")}
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.json").write_text(json.dumps([snapshot(1, 3, 600), snapshot(2, 5, 1200)]))
    spark.createDataFrame([(1, 10**18, 4, 0, "x"), (2, 10**18, 5, 1, "y")], reviews_schema()).write.parquet(path["raw"])
    spark.createDataFrame(
        [(p, f"P{p} ® S", None, None, None, None, None, None, None, 40 * p, p) for p in (1, 2)], service_point_schema()
    ).write.parquet(path["points"])

    def run(*argv):
        main(["--origin", "2001-01-01", "--minutes", "20000000", *argv], spark)

    run("ingest", path["src"], path["lake"])
    assert "lake holds 2 rows of 32 columns" in capsys.readouterr().out
    run("stream", path["src"], path["streamed"], str(tmp_path / "checkpoint"))
    run("time-dimension", path["time"])
    both = path["lake"] + "," + path["streamed"]
    run("backfill", both, path["queue"], "2024-01-01", "2035-01-01")
    run("day", both, path["queue"])  # yesterday: nothing
    run("reviews", path["raw"], path["reviews"])
    run("report", path["queue"], path["reviews"], path["points"], path["report"], "--label-pattern", " ® S")

    assert spark.read.parquet(path["queue"]).count() == 4
    got = {r.service_point_id: r for r in spark.read.parquet(path["report"]).collect()}
    assert {k: r.name for k, r in got.items()} == {1: "P1", 2: "P2"}
    # Waits 10 and 20 minutes, hours 40 and 80, stops 1 and 2, ratings 4 and 5.
    assert [round(got[1][c], 6) for c in REPORT_CRITERIA] == [0.45, 0.075, 0.075, 0.2]
    assert [round(got[2][c], 6) for c in REPORT_CRITERIA] == [0.225, 0.15, 0.15, 0.25]


def test_batches_packs_and_the_report_of_the_state(spark, tmp_path, capsys):
    path = {n: str(tmp_path / n) for n in ("src", "lake", "queue", "state", "raw", "reviews", "points", "report", "again")}
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.json").write_text(json.dumps([snapshot(1, 3, 600), snapshot(2, 5, 1200)]))
    spark.createDataFrame([(1, 10**18, 4, 0, "x"), (2, 10**18, 5, 1, "y")], reviews_schema()).write.parquet(path["raw"])
    spark.createDataFrame(
        [(p, f"P{p}", None, None, None, None, None, None, None, 40 * p, p) for p in (1, 2)], service_point_schema()
    ).write.parquet(path["points"])

    def run(*argv):
        main(["--origin", "2001-01-01", "--minutes", "20000000", *argv], spark)

    for _ in range(2):
        run("ingest", path["src"], path["lake"], "--batch", "landed")
    run("ingest", path["src"], path["lake"], "--batch", "monday")
    assert capsys.readouterr().out.split("lake holds ")[1:] == ["2 rows of 32 columns\n"] * 2 + ["4 rows of 32 columns\n"]
    run("pack", path["lake"], "--vacuum-hours", "0")
    assert "files packed" in capsys.readouterr().out
    run("backfill", path["lake"], path["queue"], "2024-01-01", "2035-01-01")
    run("state", path["queue"], path["state"])
    run("day", path["lake"], path["queue"], "--state", path["state"])
    run("reviews", path["raw"], path["reviews"])
    run("report", path["queue"], path["reviews"], path["points"], path["report"])
    run("report", path["state"], path["reviews"], path["points"], path["again"], "--of-state")
    assert spark.read.parquet(path["queue"]).count() == 4
    assert rows(spark.read.parquet(path["again"])) == rows(spark.read.parquet(path["report"])) != []
