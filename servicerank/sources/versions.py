"""Tables that are replaced as a whole, in one step.

    <table>/data/<version>/...
    <table>/versions/00000001.json, 00000002.json, ...

A rebuild is written beside the version in use and takes its place when its entry
is published, so a rebuild that fails changes nothing, and readers that began
before go on with the files they know until these are dropped.
"""

from __future__ import annotations

import time
import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from servicerank.sources import files


def swap_table(df: DataFrame, path: str, partition_by: list[str] | None = None, name: str | None = None) -> str:
    """Make `df` the current version of the table at `path`; gives the version's folder.

    With a `name` the session catalog's view of that name shows the new version;
    other sessions read it by the name. Of two rebuilds at once the one that is
    published later stays.
    """
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/data/{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(folder)
    number = (_numbers(spark, path) or [0])[-1] + 1
    while not files.publish(spark, _entry(path, number), {"folder": folder}):
        number += 1
    if name is not None:
        name_version(df, folder, name)
    return folder


def current_version(spark: SparkSession, path: str) -> str:
    """The folder that readers of a table read: its latest version's, or `path` itself if it isn't kept in versions."""
    numbers = _numbers(spark, path)
    return files.read_json(spark, _entry(path, numbers[-1]))["folder"] if numbers else path


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def name_version(df: DataFrame, folder: str, name: str) -> None:
    """Show a folder with the columns of `df` under a name of the session catalog."""
    spark = df.sparkSession
    held = any(True for _ in files.stored(spark, folder))
    columns = ", ".join(
        f"CAST({f'`{f.name}`' if held else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema
    )
    rows = f"SELECT {columns} FROM parquet.`{folder}`" if held else f"SELECT {columns} WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {rows}")


def drop_old_versions(spark: SparkSession, path: str, older_than: timedelta = timedelta(days=1)) -> int:
    """Remove files that are not of the current version and unchanged for so long; gives their number.

    Younger ones may belong to a rebuild under way, or to a reader of the last version.
    """
    current = files.locate(spark, current_version(spark, path))[0].toString()
    limit = (time.time() - older_than.total_seconds()) * 1000
    gone = 0
    for file in files.stored(spark, f"{path}/data", hidden=True):
        if not file.path.startswith(current + "/") and file.changed <= limit:
            gone += files.remove(spark, file.path)
    return gone


def _entry(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/versions/{number:08d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = (f.path.rpartition("/")[2] for f in files.stored(spark, f"{path.rstrip('/')}/versions"))
    return sorted(int(name.removesuffix(".json")) for name in found)
