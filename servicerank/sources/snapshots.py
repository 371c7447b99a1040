"""Landed JSON snapshots as raw all-string rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicerank.functions.clock import format_snapshot_time, ntz, parse_snapshot_time, utc_now
from servicerank.functions.text import spell
from servicerank.schemas import SNAPSHOT_COLUMNS, lake_schema
from servicerank.sources.json_arrays import read_arrays

STAMPS = ("batch", "file")


def feed_schema() -> T.StructType:
    """The feed as text: the lake columns without the ingest time."""
    return T.StructType([f for f in lake_schema() if f.name != "time"])


def json_options(multi_line: bool) -> dict[str, str]:
    # A snapshot that is not valid JSON fails the load.
    return {"multiLine": str(multi_line).lower(), "mode": "FAILFAST"}


def read_snapshots(
    spark: SparkSession,
    src: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    split: bool = False,
) -> DataFrame:
    """Snapshot files, each a JSON array of objects (or JSON lines).

    An array is read by one task, as one poll's worth should be. Lines split,
    and so do arrays with `split`, at the cost of a shuffle of their text.

    Text columns keep the JSON text of numbers, booleans and lists; declare
    other types in `schema` to have them spelled by to_lake_rows.
    """
    if split and multi_line:
        return read_arrays(spark, src, schema or feed_schema())
    return spark.read.schema(schema or feed_schema()).options(**json_options(multi_line)).json(src)


def stringify(df: DataFrame, null_text: str | None = "None") -> DataFrame:
    """All columns as text; NULL as `null_text`."""
    return df.select([spell(F.col(f.name), f.dataType, null_text).alias(f.name) for f in df.schema])


def ingest_time(stamp: str = "batch", batch_time: datetime | None = None) -> Column:
    """Ingest time text: of the batch (now, or as given), or of each landed file."""
    if stamp not in STAMPS:
        raise ValueError(f"stamp is one of {STAMPS}, not {stamp!r}")
    if stamp == "file":
        landed = F.unix_timestamp(F.col("_metadata.file_modification_time"))
        return format_snapshot_time(ntz(datetime(1970, 1, 1)) + F.make_dt_interval(secs=landed))
    return format_snapshot_time(utc_now() if batch_time is None else ntz(batch_time))


def to_lake_rows(df: DataFrame, time: Column) -> DataFrame:
    """All-string rows in lake order, stamped with `time`, its day as `ingest_date`.

    Columns the feed lacks become 'None'; columns the lake lacks are refused.
    """
    extra = set(df.columns) - set(SNAPSHOT_COLUMNS)
    if extra:
        raise ValueError(f"columns not in the lake schema: {sorted(extra)}")
    types = {f.name: f.dataType for f in df.schema}
    texts = [
        spell(F.col(c), types[c]).alias(c) if c in types else F.lit("None").alias(c)
        for c in SNAPSHOT_COLUMNS
        if c != "time"
    ]
    rows = df.select(*texts, time.alias("time"))
    return rows.withColumn("ingest_date", parse_snapshot_time(F.col("time")).cast("date"))
