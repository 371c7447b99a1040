"""The raw lake: append-only Parquet, partitioned by ingest day.

A folder either grows by plain appends, or by a stream, or by batches that a
ledger counts once (`ledger.BatchLake`); readers take all three.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicerank.schemas import SNAPSHOT_COLUMNS, lake_schema
from servicerank.session import discarding
from servicerank.sources import files
from servicerank.sources.ledger import BatchLake, is_batch_lake
from servicerank.sources.snapshots import ingest_time, read_snapshots, to_lake_rows


def stored_lake_schema() -> T.StructType:
    return lake_schema().add("ingest_date", T.DateType())


def append_lake(rows: DataFrame, lake: str) -> None:
    """Append rows of to_lake_rows to a folder that no stream writes to and that has no ledger."""
    if written_by_stream(rows.sparkSession, lake):
        raise ValueError(f"{lake} is written by a stream, whose log would hide appended files; use another folder")
    if is_batch_lake(rows.sparkSession, lake):
        raise ValueError(f"{lake} has a ledger, which would not name appended files; append a batch")
    rows.write.mode("append").partitionBy("ingest_date").parquet(lake)


def read_lake(spark: SparkSession, *lakes: str) -> DataFrame:
    """Raw rows and their `ingest_date`, on which readers prune.

    Several folders, such as a streamed and an appended one, are read as one lake.
    """
    reader = spark.read.schema(stored_lake_schema())
    parts = [BatchLake(spark, lake).read() if is_batch_lake(spark, lake) else reader.parquet(lake) for lake in lakes]
    return reduce(DataFrame.unionAll, parts)


def open_lake(spark: SparkSession, *lakes: str) -> DataFrame | BatchLake:
    """What the queue loads take: one lake with a ledger as it is, so that they prune by it, otherwise raw rows."""
    if len(lakes) == 1 and is_batch_lake(spark, lakes[0]):
        return BatchLake(spark, lakes[0])
    return read_lake(spark, *lakes)


def written_by_stream(spark: SparkSession, lake: str) -> bool:
    """Whether a folder has a stream's log of committed files; readers of it see those files only."""
    return files.exists(spark, f"{lake}/_spark_metadata")


def written_by_batch(spark: SparkSession, lake: str) -> bool:
    """Whether a folder has data files and no stream's log; the listing ends at the first one."""
    return not written_by_stream(spark, lake) and any(True for _ in files.stored(spark, lake))


def load_summary(spark: SparkSession, *lakes: str) -> DataFrame:
    """Row and column count of the whole lake; one with a ledger is not read for it."""
    opened = open_lake(spark, *lakes)
    return opened.summary() if isinstance(opened, BatchLake) else count_table(opened.select(SNAPSHOT_COLUMNS))


def count_table(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count")
    )


def ingest_snapshots(
    spark: SparkSession,
    src: str,
    lake: str,
    schema: T.StructType | None = None,
    batch_time: datetime | None = None,
    stamp: str = "batch",
    multi_line: bool = True,
    batch: str | None = None,
    split: bool = False,
) -> DataFrame:
    """Append the snapshot files under `src` to the lake; gives its load summary.

    With a `batch` the lake keeps a ledger: a rerun under the same name adds
    nothing, and the summary does not read the lake. `landed_batch` names the
    files that are there. Without one, appending the same files again appends
    their rows again; the streaming variant remembers what it has read. `split`
    lets several tasks read one array; it can't go with stamps by file.
    """
    if split and stamp == "file":
        raise ValueError("arrays that are split have no file's time; stamp them as a batch")
    is_new = not is_batch_lake(spark, lake)
    if batch is not None and (written_by_stream(spark, lake) or (is_new and written_by_batch(spark, lake))):
        raise ValueError(f"{lake} holds files that no ledger names; use another folder")
    with discarding(spark):
        feed = read_snapshots(spark, src, schema, multi_line, split)
        rows = to_lake_rows(feed, ingest_time(stamp, batch_time))
        if batch is None:
            append_lake(rows, lake)
        else:
            BatchLake(spark, lake).append(rows, batch)
    return load_summary(spark, lake)
