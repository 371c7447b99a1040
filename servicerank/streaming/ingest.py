"""Incremental ingest of landed snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from servicerank.sources.lake import written_by_batch
from servicerank.sources.snapshots import feed_schema, ingest_time, json_options, to_lake_rows


def stream_snapshots(
    spark: SparkSession,
    src: str,
    lake: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    batch_time: datetime | None = None,
    stamp: str = "batch",
    multi_line: bool = True,
    files_per_batch: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append snapshot files to the lake as they land, each exactly once.

    By default the query reads what has landed since the last run and stops; a
    `trigger` such as {"processingTime": "1 minute"} keeps it running. Stateless:
    every snapshot is kept, so there is nothing to wait for or to expire. The
    lake is a folder of its own: the log by which each file counts once would
    hide files that something else appends.
    """
    if written_by_batch(spark, lake):
        raise ValueError(f"{lake} holds appended files, which a stream's log would hide; use another folder")
    options = json_options(multi_line)
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    feed = spark.readStream.schema(schema or feed_schema()).options(**options).json(src)
    return (
        to_lake_rows(feed, ingest_time(stamp, batch_time))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("ingest_date")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(lake)
    )
