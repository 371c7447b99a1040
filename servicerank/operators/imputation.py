"""Filling missing values with the mean of the rows that share a key.

As a window over the key this would put each key's rows, however many, into one
task. Here the means are aggregated first (partial sums before the shuffle) and
looked up:

* keys that are NULL or in [0, dense_keys) have at most dense_keys + 1 means,
  whatever the data, so those are broadcast;
* the remaining keys are joined by shuffle, and only for rows that miss a value.
  These are counted per key first (partial sums before the shuffle). A key gets a
  salt, and a copy of its mean, for every `salt_rows` of them, and its rows take
  the salts in turn by where they stand, so that equal rows are spread as well.
  Only the keys with several salts are broadcast to the rows: there is at most
  one for every `salt_rows` rows.

Both filters reach a Parquet scan, which skips the row groups the second part
does not need - usually all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DENSE_KEYS = 65_536
#: Rows of one key that share a salt, and the most salts of a key.
SALT_ROWS = 1 << 16
SALTS = 1 << 16


def group_means(df: DataFrame, value: str, by: str, scale: float = 1) -> DataFrame:
    """One row per key: `by`, mean of value/scale (NULL if no value is known)."""
    return df.groupBy(by).agg((F.avg(value) / scale).alias("group_mean"))


def split_rows(df: DataFrame, key: str, needed: Column, dense_keys: int = DENSE_KEYS) -> tuple[DataFrame, DataFrame]:
    """Rows for add_near_means and rows for add_far_means; `needed` must never be NULL."""
    dense = _dense(df, key, dense_keys)
    return df.filter(~needed | dense), df.filter(needed & ~dense)


def add_near_means(
    df: DataFrame, means: DataFrame, key: str, by: str, needed: Column, dense_keys: int = DENSE_KEYS
) -> DataFrame:
    """Add `group_mean` where it is `needed`, by broadcast; `df` is the first part of split_rows."""
    dense = means.filter(_dense(means, by, dense_keys))
    # One whole number per key, NULL included, makes the broadcast an array to look up in.
    near = dense.select(_code(dense, by).alias("_code"), "group_mean")
    coded = df.withColumn("_key_code", F.when(needed, _code(df, key)))
    return coded.join(F.broadcast(near), F.col("_key_code") == F.col("_code"), "left").drop("_key_code", "_code")


def add_far_means(
    df: DataFrame,
    means: DataFrame,
    key: str,
    by: str,
    dense_keys: int = DENSE_KEYS,
    salts: int = SALTS,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """Add `group_mean` by a salted shuffle; `df` is the second part of split_rows.

    Where a row stands must not change when a lost task is run again, as is the
    case for scans and narrow steps over them.
    """
    far = means.filter(~_dense(means, by, dense_keys)).select(F.col(by).alias("_key"), "group_mean")
    copies = far.join(_hot_keys(df, key, salt_rows, salts), F.col("_key") == F.col("_hot"), "left").select(
        "_key", "group_mean", F.explode(F.sequence(F.lit(0).cast("bigint"), _n_salts() - 1)).alias("_mean_salt")
    )
    same = (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_mean_salt"))
    salted = spread_over_salts(df, key, salt_rows, salts)
    return salted.join(copies, same, "left").select(*df.columns, "group_mean")


def spread_over_salts(df: DataFrame, key: str, salt_rows: int = SALT_ROWS, salts: int = SALTS) -> DataFrame:
    """Add `_salt`: 0 for keys of up to `salt_rows` rows; the rows of others take as many salts as they fill, in turn."""
    hot = F.broadcast(_hot_keys(df, key, salt_rows, salts))
    placed = df.withColumn("_at", F.monotonically_increasing_id()).join(hot, F.col(key) == F.col("_hot"), "left")
    return placed.withColumn("_salt", F.pmod("_at", _n_salts())).select(*df.columns, "_salt")


def _hot_keys(df: DataFrame, key: str, salt_rows: int, salts: int) -> DataFrame:
    """Keys with more than `salt_rows` rows, and their number of salts."""
    counted = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > salt_rows)
    return counted.select("_hot", F.least(F.ceil(F.col("_n") / salt_rows), F.lit(salts)).cast("bigint").alias("_salts"))


def impute_group_mean(
    df: DataFrame,
    value: str,
    by: str,
    output: str,
    scale: float = 60,
    dense_keys: int = DENSE_KEYS,
    salts: int = SALTS,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """Add `output` = value/scale, or the mean of it over the rows with the same `by`.

    Filter the rows first: every row of `df` takes part in the means. Rows whose
    group has no known value stay NULL; NULL is a group of its own.
    """
    missing = F.col(value).isNull()
    means = group_means(df, value, by, scale)
    near, far = split_rows(df, by, missing, dense_keys)
    looked_up = add_near_means(near, means, by, by, missing, dense_keys).unionByName(
        add_far_means(far, means, by, by, dense_keys, salts, salt_rows)
    )
    return looked_up.select(*df.columns, F.coalesce(F.col(value) / scale, "group_mean").alias(output))


def _n_salts() -> Column:
    return F.coalesce("_salts", F.lit(1).cast("bigint"))


def _dense(df: DataFrame, key: str, dense_keys: int) -> Column:
    """Whether a key is in the bounded range; of keys that are not whole numbers only NULL is."""
    if not _is_whole(df, key):
        return F.col(key).isNull()
    return F.col(key).isNull() | F.col(key).between(0, dense_keys - 1)


def _code(df: DataFrame, key: str) -> Column:
    """A dense key as a whole number; NULL is -1."""
    whole = F.col(key).cast("bigint") if _is_whole(df, key) else F.lit(None).cast("bigint")
    return F.coalesce(whole, F.lit(-1).cast("bigint"))


def _is_whole(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, T.IntegralType)
