"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the operators rely on: ANSI casts fail on bad text, AQE splits skewed
# join partitions and coalesces small ones, day loads replace single partitions.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_session(app_name: str = "servicerank", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; `conf` adds to them or overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session that names none gets a temporary folder; a cluster session
    that names none is refused, since a machine-local folder would lose data.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="servicerank-")
    spark.sparkContext.setCheckpointDir(local)
    return local


# Work paths made inside each open `discarding` block.
_discarded: list[list[str]] = []


def new_work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a work table under the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    discard(path)
    return path


def discard(path: str) -> None:
    """Let the innermost `discarding` block remove a path as well, made before it or outside of it."""
    if _discarded:
        _discarded[-1].append(path)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Remove the work tables made inside the block when it ends; write what reads them before."""
    _discarded.append([])
    try:
        yield
    finally:
        for made in _discarded.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(made)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write `df` as a work table and read it back; `options` are the Parquet writer's, such as `compression`.

    Cuts lineage, so readers agree on the rows even if an executor is lost, and
    keeps them columnar, so a reader of one column reads one column.
    """
    path = new_work_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
