"""Rush hours, and the waits in them.

A bucket (hour) of a period (day of week) is an entity's peak if the daily
maximum of its load, averaged over the days, is the highest. Days are folded into
hourly maxima before anything is shuffled or joined, so a shuffle carries at most
one row per entity, day and hour and map task, not the snapshots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_max(df: DataFrame, keys: list[str], day: str, metric: str, output: str) -> DataFrame:
    """Maximum of `metric` per day and key columns."""
    return df.groupBy(day, *keys).agg(F.max(metric).alias(output))


def mean_daily_max(df: DataFrame, keys: list[str], day: str, metric: str, output: str) -> DataFrame:
    """Mean over the days of the daily maxima."""
    return daily_max(df, keys, day, metric, "_daily").groupBy(*keys).agg(F.avg("_daily").alias(output))


def ranked_buckets(
    df: DataFrame, entity: str, period: str, bucket: str, day: str, metric: str, rank: str = "ranked_rush"
) -> DataFrame:
    """Every bucket of an entity's period with its rank; equal means rank by bucket."""
    means = mean_daily_max(df, [entity, period, bucket], day, metric, "avg_max")
    order = Window.partitionBy(entity, period).orderBy(F.desc_nulls_last("avg_max"), bucket)
    return means.withColumn(rank, F.row_number().over(order))


def peak_bucket(df: DataFrame, entity: str, period: str, bucket: str, day: str, metric: str) -> DataFrame:
    """The peak bucket of every entity and period; the smallest among equals."""
    means = mean_daily_max(df, [entity, period, bucket], day, metric, "_avg")
    best = F.max_by(bucket, _peak_order("_avg", bucket))
    return means.groupBy(entity, period).agg(best.alias(bucket))


def daily_max_in_peak(
    df: DataFrame, peaks: DataFrame, entity: str, period: str, bucket: str, day: str, metric: str, output: str
) -> DataFrame:
    """Daily maximum of `metric` within the peak buckets.

    The maxima are taken before the join, which then meets one row per entity,
    day and bucket. Peaks are unique per entity and period, so an inner join
    repeats no row; a semi join would do as well, but the optimizer would push
    it below the maxima, on to the raw rows.
    """
    keys = [entity, period, bucket]
    return daily_max(df, keys, day, metric, output).join(peaks.select(keys), keys, "inner")


def metric_in_peak(
    df: DataFrame,
    peaks: DataFrame,
    entity: str,
    period: str,
    bucket: str,
    day: str,
    metric: str,
    output: str,
    scale: float = 1,
) -> DataFrame:
    """Per entity: mean over its peak days of the daily maximum, over `scale`, rounded up.

    Give whole numbers and a `scale` rather than scaled fractions: their sums are
    exact, so a mean that is a whole number is not rounded up by a stray last bit.
    """
    maxima = daily_max_in_peak(df, peaks, entity, period, bucket, day, metric, "_daily")
    mean = F.sum("_daily") / (F.nullif(F.count("_daily"), F.lit(0)) * scale)
    return maxima.groupBy(entity).agg(F.ceil(mean).cast("bigint").alias(output))


def fold_waits(df: DataFrame, keys: str | list[str], slot: str, load: str, wait: str) -> DataFrame:
    """One row for each key, slot and load: `most`, `total`, `known` and `missing` of its waits.

    All that rush_wait needs of the snapshots. Folds of disjoint rows merge into
    the fold of their union (merge_folds), so they can be kept day by day.
    """
    keys = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*keys, slot, load).agg(
        F.max(wait).alias("most"),
        F.sum(wait).alias("total"),
        F.count(wait).alias("known"),
        F.count_if(F.col(wait).isNull()).alias("missing"),
    )


def merge_folds(folds: DataFrame, entity: str, slot: str, load: str) -> DataFrame:
    """The fold of all rows behind several folds, given as one table."""
    return folds.groupBy(entity, slot, load).agg(
        F.max("most").alias("most"), *(F.sum(c).alias(c) for c in ("total", "known", "missing"))
    )


def rush_wait(
    df: DataFrame,
    entity: str,
    slot: str,
    period: Column,
    bucket: Column,
    load: str,
    wait: str,
    output: str,
    scale: float = 60,
) -> DataFrame:
    """Imputation, peaks and the wait in them as one chain of aggregations.

    `slot` numbers the buckets of all days (hours since some time); `period` and
    `bucket` are its day of week and hour, computed once per slot, not per row.

    Same result as impute_group_mean, peak_bucket and metric_in_peak. The rows
    are folded first, to one for each entity, slot and load; the rest needs the
    folded rows only.
    """
    return rush_wait_of_fold(fold_waits(df, entity, slot, load, wait), entity, slot, period, bucket, load, output, scale)


def rush_wait_of_fold(
    folded: DataFrame,
    entity: str,
    slot: str,
    period: Column,
    bucket: Column,
    load: str,
    output: str,
    scale: float = 60,
) -> DataFrame:
    """rush_wait from the rows of fold_waits, or of a table that keeps them.

    Means are added up from the folded rows, and joined with them. Each bucket
    carries the sum and count of its daily maxima, the peak's are picked with it,
    and an entity's mean is their total sum over their total count. `scale`
    divides last, so sums of whole waits are exact.
    """
    means = folded.groupBy(load).agg((F.sum("total") / F.nullif(F.sum("known"), F.lit(0))).alias("group_mean"))
    # Equal plans up to here, so the fold's shuffle serves both; a hot load is split by adaptive execution.
    same = F.col("_key").eqNullSafe(F.col(load))
    filled = folded.join(means.withColumnRenamed(load, "_key"), same, "left").withColumn(
        "_filled", F.greatest(F.col("most").cast("double"), F.when(F.col("missing") > 0, F.col("group_mean")))
    )

    slots = filled.groupBy(entity, slot).agg(F.max(load).alias("_load"), F.max("_filled").alias("_wait"))
    buckets = (
        slots.select(entity, period.alias("_period"), bucket.alias("_bucket"), "_load", "_wait")
        .groupBy(entity, "_period", "_bucket")
        .agg(
            F.avg("_load").alias("_avg"),
            F.struct(F.sum("_wait").alias("sum"), F.count("_wait").alias("n")).alias("_waits"),
        )
    )
    peaks = buckets.groupBy(entity, "_period").agg(
        F.max_by("_waits", _peak_order("_avg", "_bucket")).alias("_waits")
    )
    mean = F.sum("_waits.sum") / (F.nullif(F.sum("_waits.n"), F.lit(0)) * scale)
    return peaks.groupBy(entity).agg(F.ceil(mean).cast("bigint").alias(output))


def _peak_order(mean: str, bucket: str) -> Column:
    """Orders buckets so that the peak is the maximum: high mean, then small bucket."""
    return F.struct(F.col(mean), (-F.col(bucket)).alias("neg"))
