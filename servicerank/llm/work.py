"""Work tables of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from servicerank import session


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """`session.materialize`, after which Spark may remove the shuffle files behind the table.

    It does so once the driver has collected the plan that made them as garbage;
    without being asked to, that may be long after the job.
    """
    stored = session.materialize(df, label, **options)
    df.sparkSession._jvm.System.gc()
    return stored


def settle(spark: SparkSession, label: str, make: Callable[[], DataFrame], **options: str) -> DataFrame:
    """`materialize` of what `make` gives, after which the work tables made for it are removed."""
    path = session.new_work_path(spark, label)
    with session.discarding(spark):
        made = make()
        made.write.options(**options).parquet(path)
    spark._jvm.System.gc()
    return spark.read.schema(made.schema).parquet(path)
