"""Warehouse tables: full rebuilds, day loads and named views."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicerank.operators.calendar import DEFAULT_CALENDAR, Calendar, time_dimension
from servicerank.operators.facts import (
    Windowed, fact_date, open_known, queue_fact, queue_fact_of_day, reviews_fact,
)
from servicerank.operators.peaks import fold_waits
from servicerank.schemas import (
    ENTITY, LOAD, WAIT, queue_fact_schema, reviews_fact_schema, rush_state_schema, time_dimension_schema,
)
from servicerank.session import discarding
from servicerank.sources.versions import current_version, is_versioned, swap_table

DAY_MODES = ("replace", "append")


def replace_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, swap: bool = False, name: str | None = None
) -> None:
    """Create or replace a table as the rows of `df`.

    Overwrites in place; with `swap`, or a `name` to read it by, and always once
    a table has been swapped, the rows are written beside it and take its place
    in one step (versions.swap_table).
    """
    if swap or name is not None or is_versioned(df.sparkSession, path):
        swap_table(df, path, partition_by, name)
        return
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(current_version(spark, path))


def load_time_dimension(
    spark: SparkSession,
    path: str,
    calendar: Calendar = DEFAULT_CALENDAR,
    swap: bool = False,
    name: str | None = None,
) -> None:
    replace_table(time_dimension(spark, calendar), path, None, swap, name)


def read_time_dimension(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, time_dimension_schema())


def load_queue_fact(
    lake: DataFrame | Windowed,
    path: str,
    lo: date | datetime,
    hi: date | datetime,
    calendar: Calendar = DEFAULT_CALENDAR,
    rebalance: bool = False,
    swap: bool = False,
    name: str | None = None,
    **options,
) -> None:
    """Rebuild the queue fact from the snapshots of [lo, hi), partitioned by day.

    `rebalance` shuffles the rows into evenly sized files per day, splitting a
    hot day; worth it for a lake that is not partitioned by day, from which
    every task would write a file for every day. `swap` and `name` are those of
    replace_table.
    """
    rows = queue_fact(lake, lo, hi, calendar, **options).withColumn("fact_date", fact_date(calendar))
    if rebalance:
        rows = rows.hint("rebalance", "fact_date")
    replace_table(rows.sortWithinPartitions("fact_date", "time_id"), path, ["fact_date"], swap, name)


def load_day(
    lake: DataFrame | Windowed,
    path: str,
    as_of: date | None = None,
    mode: str = "replace",
    calendar: Calendar = DEFAULT_CALENDAR,
    state: str | None = None,
    **options,
) -> None:
    """Load the snapshots of the day before `as_of` (default: today, UTC).

    'replace' writes that day's partition anew, so a rerun changes nothing;
    'append' adds the rows once more on every run. Rows are sorted by time
    within files, for tight Parquet minima and maxima. A `state` kept at that
    path is brought up to date for the day.
    """
    if mode not in DAY_MODES:
        raise ValueError(f"mode is one of {DAY_MODES}, not {mode!r}")
    as_of = as_of or datetime.now(timezone.utc).date()
    day = as_of - timedelta(days=1)
    rows = queue_fact_of_day(lake, as_of, calendar=calendar, **options).sortWithinPartitions("time_id")
    spark = rows.sparkSession
    part = f"{current_version(spark, path)}/fact_date={day.isoformat()}"
    rows.write.mode("overwrite" if mode == "replace" else "append").parquet(part)
    if state is not None:
        refresh_rush_state(spark, path, state, [day], calendar, options.get("entity", ENTITY))


def read_queue_fact(spark: SparkSession, path: str, entity: str = ENTITY) -> DataFrame:
    """Queue fact with its partition column `fact_date`, on which readers prune."""
    return _stored(spark, path, queue_fact_schema(entity).add("fact_date", T.DateType()))


def refresh_rush_state(
    spark: SparkSession,
    queue: str,
    state: str,
    days: list[date] | None = None,
    calendar: Calendar = DEFAULT_CALENDAR,
    entity: str = ENTITY,
) -> None:
    """Bring the rush-hour state of a stored queue fact up to date: for `days`, or as a whole.

    The state holds what rush hours and their waits need of the fact: for each
    point, hour and waiting count the largest wait, the sum and number of the
    known ones, and the number of missing ones, over open snapshots. These merge,
    and an hour lies within a day, so a day's part replaces that day's only, and
    is made from that day's rows only. Running it again changes nothing, so a
    load that died between fact and state is mended by a rerun.
    """
    fact = read_queue_fact(spark, queue, entity)
    if days is None:
        folded = _fold(fact, calendar, entity, "fact_date")
        replace_table(folded.sortWithinPartitions("fact_date", entity, "slot"), state, ["fact_date"])
        return
    for day in days:
        rows = fact.filter(F.col("fact_date") == F.lit(day))
        part = f"{current_version(spark, state)}/fact_date={day.isoformat()}"
        _fold(rows, calendar, entity).sortWithinPartitions(entity, "slot").write.mode("overwrite").parquet(part)


def _fold(fact: DataFrame, calendar: Calendar, entity: str, *also: str) -> DataFrame:
    known = open_known(fact, calendar).withColumn("slot", calendar.hour_number(F.col("time_id")))
    return fold_waits(known, [*also, entity], "slot", LOAD, WAIT)


def read_rush_state(spark: SparkSession, path: str, entity: str = ENTITY) -> DataFrame:
    """Rows of the rush-hour state with their `fact_date`."""
    return _stored(spark, path, rush_state_schema(entity).add("fact_date", T.DateType()))


def load_reviews_fact(
    reviews: DataFrame,
    path: str,
    calendar: Calendar = DEFAULT_CALENDAR,
    swap: bool = False,
    name: str | None = None,
    **options,
) -> None:
    """Rebuild the reviews fact."""
    with discarding(reviews.sparkSession):
        replace_table(reviews_fact(reviews, calendar, **options), path, None, swap, name)


def read_reviews_fact(spark: SparkSession, path: str, entity: str = ENTITY) -> DataFrame:
    return _stored(spark, path, reviews_fact_schema(entity))


def store_bucketed(
    df: DataFrame, name: str, path: str, by: list[str], buckets: int, sort_by: list[str] | None = None
) -> DataFrame:
    """Store `df` as a table of the session catalog, its rows dealt into buckets by the hash of `by`; gives the table.

    One shuffle here saves one in every later join, aggregation or audit on keys
    that hold `by`: tables with equally many buckets of a key are joined bucket
    by bucket. A fact and the time dimension, both by `time_id`, are joined, and
    the fact's keys audited, without moving the fact. Each bucket is one file,
    sorted by `sort_by` (the key by default); choose `buckets` so that a file
    has some hundreds of megabytes.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*(sort_by or by))
    dealt.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def create_views(tables: dict[str, DataFrame]) -> None:
    """Name lazy tables for SQL; nothing is computed."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
