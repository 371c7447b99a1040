"""Command line for scheduled runs, for spark-submit.

    spark-submit servicerank/jobs.py ingest landing/ lake/
    spark-submit servicerank/jobs.py day lake/ queue/ --as-of 2024-03-22

The lake of `backfill` and `day` may be several folders, separated by commas.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date, datetime, timedelta
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from servicerank.operators.calendar import DEFAULT_CALENDAR, Calendar  # noqa: E402
from servicerank.plans.report import ranked_report  # noqa: E402
from servicerank.schemas import ENTITY, reviews_schema, service_point_schema  # noqa: E402
from servicerank.session import discarding, get_session  # noqa: E402
from servicerank.sources import lake, warehouse  # noqa: E402
from servicerank.sources.ledger import BatchLake, landed_batch  # noqa: E402
from servicerank.streaming.ingest import stream_snapshots  # noqa: E402


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    batch = landed_batch(spark, args.src) if args.batch == "landed" else args.batch
    summary = lake.ingest_snapshots(
        spark, args.src, args.lake, stamp=args.stamp, multi_line=not args.lines, batch=batch, split=args.split
    ).first()
    print(f"lake holds {summary.row_count} rows of {summary.column_count} columns")


def pack(spark: SparkSession, args: argparse.Namespace) -> None:
    batches = BatchLake(spark, args.lake)
    print(f"{batches.pack(args.megabytes << 20)} files packed")
    if args.vacuum_hours is not None:
        print(f"{batches.vacuum(timedelta(hours=args.vacuum_hours))} files removed")


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    stream_snapshots(
        spark, args.src, args.lake, args.checkpoint, stamp=args.stamp, multi_line=not args.lines
    ).awaitTermination()


def time_dimension(spark: SparkSession, args: argparse.Namespace) -> None:
    warehouse.load_time_dimension(spark, args.table, _calendar(args), args.swap, args.name)


def backfill(spark: SparkSession, args: argparse.Namespace) -> None:
    warehouse.load_queue_fact(
        lake.open_lake(spark, *args.lake.split(",")), args.table, args.lo, args.hi, _calendar(args), entity=args.entity,
        rebalance=args.rebalance, vouched=args.vouched, swap=args.swap, name=args.name,
    )


def day(spark: SparkSession, args: argparse.Namespace) -> None:
    warehouse.load_day(
        lake.open_lake(spark, *args.lake.split(",")), args.table, args.as_of, args.mode, _calendar(args), args.state,
        entity=args.entity, vouched=args.vouched,
    )


def state(spark: SparkSession, args: argparse.Namespace) -> None:
    warehouse.refresh_rush_state(spark, args.queue, args.state, args.day, _calendar(args), args.entity)


def reviews(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = spark.read.schema(reviews_schema()).parquet(args.reviews)
    warehouse.load_reviews_fact(raw, args.table, _calendar(args), args.swap, args.name, entity=args.entity)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    with discarding(spark):
        read = warehouse.read_rush_state if args.of_state else warehouse.read_queue_fact
        result = ranked_report(
            read(spark, args.queue, args.entity),
            warehouse.read_reviews_fact(spark, args.reviews, args.entity),
            spark.read.schema(service_point_schema(args.entity)).parquet(args.points),
            _calendar(args),
            args.entity,
            label_pattern=args.label_pattern,
            safe=args.safe,
            of_state=args.of_state,
        )
        warehouse.replace_table(result, args.table, None, args.swap, args.name)


def _calendar(args: argparse.Namespace) -> Calendar:
    return Calendar(args.origin, args.minutes, tuple(args.weekend))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description="Service-point analytics jobs")
    top.add_argument("--entity", default=ENTITY, help="name of the service-point key")
    top.add_argument("--origin", type=datetime.fromisoformat, default=DEFAULT_CALENDAR.origin, help="first minute")
    top.add_argument("--minutes", type=int, default=DEFAULT_CALENDAR.minutes, help="length of the calendar")
    top.add_argument("--weekend", type=int, nargs="+", default=DEFAULT_CALENDAR.weekend, help="days, 1 is Sunday")
    top.add_argument("--swap", action="store_true", help="replace whole tables in one step, keeping the old version")
    top.add_argument("--name", help="name of the replaced table in the session catalog; implies --swap")
    jobs = top.add_subparsers(required=True)

    def job(run, *paths: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__.replace("_", "-"))
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(path)
        return sub

    for sub in (job(ingest, "src", "lake"), job(stream, "src", "lake", "checkpoint")):
        sub.add_argument("--stamp", choices=["batch", "file"], default="batch")
        sub.add_argument("--lines", action="store_true", help="JSON lines instead of arrays")
        if sub.get_default("run") is ingest:
            sub.add_argument("--split", action="store_true", help="arrays so large that several tasks shall read one")
            sub.add_argument("--batch", help="name under which this load counts once; 'landed': the files that are there")
    sub = job(pack, "lake")
    sub.add_argument("--megabytes", type=int, default=128, help="size of a packed file")
    sub.add_argument("--vacuum-hours", type=float, help="then remove files that have been out of use for so long")
    job(time_dimension, "table")
    sub = job(backfill, "lake", "table")
    sub.add_argument("lo", type=date.fromisoformat)
    sub.add_argument("hi", type=date.fromisoformat)
    sub.add_argument("--rebalance", action="store_true")
    sub.add_argument("--vouched", action="store_true", help="all times are well formed: prune and push down")
    sub = job(day, "lake", "table")
    sub.add_argument("--as-of", type=date.fromisoformat, help="load the day before; default today, UTC")
    sub.add_argument("--mode", choices=warehouse.DAY_MODES, default="replace")
    sub.add_argument("--vouched", action="store_true", help="all times are well formed: prune and push down")
    sub.add_argument("--state", help="rush-hour state to bring up to date for the day")
    sub = job(state, "queue", "state")
    sub.add_argument("--day", type=date.fromisoformat, nargs="+", help="these days only")
    job(reviews, "reviews", "table")
    sub = job(report, "queue", "reviews", "points", "table")
    sub.add_argument("--label-pattern")
    sub.add_argument("--of-state", action="store_true", help="`queue` is the rush-hour state, not the fact")
    sub.add_argument("--safe", action="store_true", help="NULL instead of failing on division by zero")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or get_session("servicerank"), args)


if __name__ == "__main__":
    main()
