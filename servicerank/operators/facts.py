"""Queue and review facts."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicerank.functions.clock import (
    add_minutes, from_epoch_nanos, ntz, parse_snapshot_time, snapshot_time_between,
)
from servicerank.operators.calendar import DEFAULT_CALENDAR, Calendar, attach_time_id
from servicerank.operators.numbering import ordered_row_ids
from servicerank.operators.staging import queue_spec, stage_typed
from servicerank.schemas import ENTITY, queue_fact_schema, reviews_fact_schema


class Windowed(Protocol):
    """A lake that knows which of its days and times were checked, such as a BatchLake."""

    def window(self, lo: date | datetime, hi: date | datetime) -> DataFrame:
        """What snapshot_window gives."""


def snapshot_window(
    lake: DataFrame | Windowed, lo: date | datetime, hi: date | datetime, vouched: bool = False
) -> DataFrame:
    """Raw snapshots taken in [lo, hi).

    Every row's time is parsed, and text that is not a time fails the load,
    whatever the lake's layout. Who knows that all times are well formed, and an
    `ingest_date` is their day, as to_lake_rows writes them, may vouch for it:
    then days that aren't needed are pruned, and the raw text is compared, which
    reaches the Parquet scan. `rejected_times` tells whether that holds. A lake
    with a ledger needs nobody's word.
    """
    lo, hi = _midnight(lo), _midnight(hi)
    if not isinstance(lake, DataFrame):
        return lake.window(lo, hi)
    if vouched:
        if "ingest_date" in lake.columns:
            last = hi - timedelta(microseconds=1)
            lake = lake.filter(F.col("ingest_date").between(lo.date(), last.date()))
        return lake.filter(snapshot_time_between(F.col("time"), lo, hi))
    taken = parse_snapshot_time(F.col("time"))
    return lake.filter((taken >= ntz(lo)) & (taken < ntz(hi)))


def queue_fact(
    lake: DataFrame | Windowed,
    lo: date | datetime,
    hi: date | datetime,
    calendar: Calendar = DEFAULT_CALENDAR,
    entity: str = ENTITY,
    source_id: str = "id",
    vouched: bool = False,
) -> DataFrame:
    """Typed queue rows of [lo, hi), keyed by minute: one narrow pass, no shuffle.

    The range is cut to the calendar, so every row has a time id. Snapshots of
    one point in the same minute are all kept; the key audit reports them.
    """
    lo, hi = max(_midnight(lo), calendar.origin), min(_midnight(hi), calendar.end)
    spec = {**queue_spec(entity, source_id), "time_format": ("time", "time")}
    typed = stage_typed(snapshot_window(lake, lo, hi, vouched), spec)
    keyed = typed.withColumn("time_id", calendar.time_id(F.col("time_format")))
    return keyed.select(queue_fact_schema(entity).names)


def queue_fact_of_day(lake: DataFrame | Windowed, as_of: date, **options) -> DataFrame:
    """Queue rows of the day before `as_of`."""
    return queue_fact(lake, as_of - timedelta(days=1), as_of, **options)


def open_known(queue: DataFrame, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """Queue rows of open points (NULL counts as closed) within the calendar."""
    return queue.filter(F.col("is_open").eqNullSafe(True) & F.col("time_id").between(1, calendar.minutes))


def fact_date(calendar: Calendar = DEFAULT_CALENDAR, time_id: str = "time_id"):
    """Day of a time id: the partition column of a stored fact."""
    return add_minutes(calendar.origin, F.col(time_id) - 1).cast("date")


def reviews_fact(
    reviews: DataFrame,
    calendar: Calendar = DEFAULT_CALENDAR,
    entity: str = ENTITY,
    partitions: int | None = None,
) -> DataFrame:
    """Review rows keyed by minute.

    Ids are given before the calendar drops rows, so they may have gaps. They
    follow (Date, id_bq, Review), so a rerun gives the same ids.
    """
    named = reviews.select("id_bq", "Date", "Rating", "Helpful_count", "Review")
    numbered = ordered_row_ids(named, ["Date", "id_bq", "Review"], "review_id", partitions)
    timed = numbered.withColumn("_written", from_epoch_nanos(F.col("Date")))
    return attach_time_id(timed, "_written", calendar).select(
        "review_id",
        F.col("id_bq").alias(entity),
        "time_id",
        F.col("Rating").alias("review_score"),
        F.col("Helpful_count").alias("number_upvotes_review"),
        F.col("Review").alias("full_review"),
    ).select(reviews_fact_schema(entity).names)


def _midnight(value: date | datetime) -> datetime:
    return value if isinstance(value, datetime) else datetime.combine(value, time())
