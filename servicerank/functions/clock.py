"""Date-time expressions on TIMESTAMP_NTZ.

None of them goes through a zoned timestamp, so the results do not depend on the
session time zone (date_trunc and timestampdiff would, around DST changes).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from servicerank.schemas import SNAPSHOT_TIME_FORMAT

# Two-digit years from here on belong to the 1900s.
CENTURY_PIVOT = "69"

_YEAR_ONE = datetime(1, 1, 1)


def ntz(value: datetime) -> Column:
    """Literal date-time without a zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_snapshot_time(text: Column, strict: bool = True) -> Column:
    """`yy/MM/dd HH:mm:ss` text as a date-time.

    Strict parsing fails the query on bad text; otherwise bad text is NULL.
    """
    century = F.when(F.substring(text, 1, 2) >= CENTURY_PIVOT, F.lit("19")).otherwise(F.lit("20"))
    full = F.concat(century, text)
    if strict:
        return F.to_timestamp_ntz(full, F.lit("yy" + SNAPSHOT_TIME_FORMAT))
    well_formed = text.rlike(r"^\d\d/\d\d/\d\d \d\d:\d\d:\d\d$")
    return F.when(well_formed, F.translate(full, "/", "-").try_cast("timestamp_ntz"))


def format_snapshot_time(ts: Column) -> Column:
    """A date-time as `yy/MM/dd HH:mm:ss` text (fractions are cut off)."""
    return F.translate(F.substring(ts.cast("timestamp_ntz").cast("string"), 3, 17), "-", "/")


def snapshot_time_between(text: Column, lo: datetime, hi: datetime) -> Column:
    """Whether well-formed time text lies in [lo, hi), without parsing it.

    The text sorts by time within a century, so this is a comparison of the raw
    column (of two ranges if 2000 lies between), which reaches a Parquet scan.
    """
    first, end = datetime(1969, 1, 1), datetime(2069, 1, 1)
    lo, hi = max(_whole_second(lo), first), min(_whole_second(hi), end)
    if lo >= hi:
        return F.lit(False)
    from_lo = text >= _raw(lo)
    to_hi = text < (CENTURY_PIVOT if hi == end else _raw(hi))
    return (from_lo | to_hi) if lo.year < 2000 <= hi.year else (from_lo & to_hi)


def _raw(value: datetime) -> str:
    return value.strftime("%y/%m/%d %H:%M:%S")


def _whole_second(value: datetime) -> datetime:
    """The first whole second not before `value`."""
    return (value + timedelta(microseconds=999_999)).replace(microsecond=0)


def utc_now() -> Column:
    """Start of the query or micro-batch as a UTC date-time, to the second."""
    return from_epoch_seconds(F.unix_timestamp(F.current_timestamp()))


def from_epoch_seconds(seconds: Column) -> Column:
    return ntz(datetime(1970, 1, 1)) + F.make_dt_interval(secs=seconds)


def from_epoch_nanos(nanos: Column) -> Column:
    """Epoch nanoseconds as a date-time, rounded half away from zero to the second.

    A plain cast would truncate and could move the value into another minute.
    """
    return from_epoch_seconds(F.round(nanos / 1_000_000_000).cast("bigint"))


def minute_floor(ts: Column) -> Column:
    return add_minutes(_YEAR_ONE, whole_minutes_since(_YEAR_ONE, ts))


def day_floor(ts: Column) -> Column:
    """Midnight of the day, still a date-time."""
    return ts.cast("date").cast("timestamp_ntz")


def add_minutes(origin: datetime, minutes: Column) -> Column:
    return ntz(origin) + F.make_dt_interval(mins=minutes.cast("int"))


def whole_minutes_since(origin: datetime, ts: Column) -> Column:
    """Minutes from `origin` to `ts`; meaningful for `ts >= origin` only."""
    return (ts - ntz(origin)).cast("interval minute").cast("bigint")


def sunday_week(ts: Column) -> Column:
    """Week of the year 0-53, weeks starting on Sunday (days before the first Sunday: 0)."""
    return F.floor((F.dayofyear(ts) - F.dayofweek(ts) + 7) / 7).cast("int")
