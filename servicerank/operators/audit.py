"""Checks of declared but unenforced keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicerank.functions.clock import ntz, parse_snapshot_time
from servicerank.operators.calendar import DEFAULT_CALENDAR, Calendar


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row, with `n_rows`."""
    return _key_counts(df, key).filter(F.col("n_rows") > 1)


def null_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key has a NULL part."""
    return df.filter(_any_null(key))


def orphan_keys(fact: DataFrame, foreign_key: list[str], dim: DataFrame, key: list[str]) -> DataFrame:
    """Foreign keys without a row in `dim`, with `n_rows`; keys with a NULL part are exempt.

    The fact is reduced to its distinct keys before the join, so a hot key is
    one row there.
    """
    used = _key_counts(fact.dropna(subset=foreign_key), foreign_key)
    known = dim.select([F.col(k).alias(f) for f, k in zip(foreign_key, key)])
    return used.join(known, foreign_key, "left_anti")


def orphan_time_ids(fact: DataFrame, calendar: Calendar = DEFAULT_CALENDAR, time_id: str = "time_id") -> DataFrame:
    """Time ids outside the calendar, with `n_rows`; a filter, no join."""
    outside = fact.filter(~F.col(time_id).between(1, calendar.minutes))
    return _key_counts(outside, [time_id])


def rejected_times(lake: DataFrame, calendar: Calendar = DEFAULT_CALENDAR, time: str = "time") -> DataFrame:
    """Raw time texts that a load refuses or leaves out: `reason`, `n_texts`, `n_rows`, one row for each reason.

    Malformed texts (NULL among them) fail a load; well-formed ones outside the calendar are dropped by it.
    """
    taken = parse_snapshot_time(F.col(time), strict=False)
    inside = (taken >= ntz(calendar.origin)) & (taken < ntz(calendar.end))
    counts = _key_counts(lake.select(time), [time])
    checks = {"malformed": taken.isNull(), "outside the calendar": F.coalesce(~inside, F.lit(False))}
    found = _totals(counts, checks)
    return found.select(
        F.col("check_name").alias("reason"), F.col("bad_keys").alias("n_texts"), F.col("bad_rows").alias("n_rows")
    )


def audit_keys(
    df: DataFrame,
    primary_key: list[str],
    foreign_keys: dict[str, tuple[DataFrame, str]] | None = None,
    time_ids: dict[str, Calendar] | None = None,
) -> DataFrame:
    """One row per check: `check_name`, `bad_keys`, `bad_rows`.

    `foreign_keys` maps a column to (dimension, its key column), `time_ids` a
    column to the calendar it numbers minutes of.
    """
    counts = _key_counts(df, primary_key)
    own = {"duplicate primary key": F.col("n_rows") > 1, "null primary key": _any_null(primary_key)}
    audits = [_totals(counts, own)]
    for column, (dim, key) in (foreign_keys or {}).items():
        audits.append(_totals(orphan_keys(df, [column], dim, [key]), {f"orphan {column}": F.lit(True)}))
    for column, calendar in (time_ids or {}).items():
        audits.append(_totals(orphan_time_ids(df, calendar, column), {f"orphan {column}": F.lit(True)}))
    return reduce(DataFrame.unionAll, audits)


def _totals(counts: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Keys and rows that meet each condition, in one pass."""
    bad = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.count_if(condition).alias("bad_keys"),
            F.coalesce(F.sum(F.when(condition, F.col("n_rows"))), F.lit(0)).alias("bad_rows"),
        )
        for name, condition in checks.items()
    ]
    return counts.agg(F.array(*bad).alias("checks")).select(F.inline("checks"))


def _any_null(key: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])


def _key_counts(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
