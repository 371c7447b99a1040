"""Minute calendar: the time dimension and the keys into it.

Ids number a gap-free minute series from 1, so an id and its date-time convert
by arithmetic. Facts get their time key, and their calendar attributes, without
shuffling against (or broadcasting) a dimension of millions of rows. The join
forms remain for dimensions that were edited by hand.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from servicerank.functions.clock import add_minutes, ntz, sunday_week, whole_minutes_since


@dataclass(frozen=True)
class Calendar:
    """`minutes` rows from `origin`; `weekend` holds day numbers (1 = Sunday).

    The default weekend is Sunday and Friday, for parity with existing tables;
    pass (1, 7) for Sunday and Saturday.
    """

    origin: datetime = datetime(2017, 1, 1)
    minutes: int = 10_000_000
    weekend: tuple[int, ...] = (1, 6)

    def __post_init__(self) -> None:
        if self.origin.second or self.origin.microsecond:
            raise ValueError(f"a calendar begins on a whole minute, not at {self.origin}")

    @property
    def end(self) -> datetime:
        """The first minute past the last row."""
        return self.origin + timedelta(minutes=self.minutes)

    def time_id(self, ts: Column) -> Column:
        """Id of the minute of `ts`; meaningful within the calendar only."""
        return whole_minutes_since(self.origin, ts) + 1

    def hour_number(self, time_id: Column) -> Column:
        """Hours from the hour of the origin to the hour of an id."""
        return F.floor((time_id - 1 + self.origin.minute) / 60)

    def hour_start(self, hour_number: Column) -> Column:
        first = self.origin.replace(minute=0, second=0, microsecond=0)
        return ntz(first) + F.make_dt_interval(hours=hour_number.cast("int"))

    def columns(self, full_date: Column) -> list[Column]:
        """Attributes of a minute, in table order."""
        day = full_date.cast("date")
        return [
            F.dayofweek(day).alias("day_of_week"),
            F.hour(full_date).alias("hour"),
            F.dayofmonth(day).alias("day_number_in_month"),
            sunday_week(day).alias("week_number_in_year"),
            F.month(day).alias("month_number"),
            (~F.dayofweek(day).isin(*self.weekend)).alias("weekday_flag"),
            F.lit(False).alias("holiday_flag"),
        ]


DEFAULT_CALENDAR = Calendar()


def time_dimension(spark: SparkSession, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """One row per minute; generated in parallel, no shuffle."""
    dates = spark.range(calendar.minutes).select(
        (F.col("id") + 1).alias("time_id"),
        add_minutes(calendar.origin, F.col("id")).alias("full_date"),
    )
    return dates.select("time_id", "full_date", *calendar.columns(F.col("full_date")))


def attach_time_id(
    df: DataFrame, ts: str, calendar: Calendar = DEFAULT_CALENDAR, time_id: str = "time_id"
) -> DataFrame:
    """Add the id of the minute of `ts`; rows outside the calendar are dropped."""
    inside = df.filter((F.col(ts) >= ntz(calendar.origin)) & (F.col(ts) < ntz(calendar.end)))
    return inside.withColumn(time_id, calendar.time_id(F.col(ts)))


def attach_calendar(
    df: DataFrame, calendar: Calendar = DEFAULT_CALENDAR, time_id: str = "time_id"
) -> DataFrame:
    """Add full_date and the calendar attributes; ids outside the calendar are dropped."""
    known = df.filter(F.col(time_id).between(1, calendar.minutes))
    dated = known.withColumn("full_date", add_minutes(calendar.origin, F.col(time_id) - 1))
    return dated.select("*", *calendar.columns(F.col("full_date")))


def join_time_id(df: DataFrame, ts: str, dim: DataFrame) -> DataFrame:
    """Join form of attach_time_id, for a `dim` that is not a plain minute series.

    Shuffles the rows by minute unless `dim` is small; AQE splits a hot minute.
    """
    keys = dim.select("time_id", F.col("full_date").alias(ts))
    return df.join(keys, ts, "inner")


def join_calendar(df: DataFrame, dim: DataFrame, time_id: str = "time_id") -> DataFrame:
    """Join form of attach_calendar."""
    return df.join(dim.withColumnRenamed("time_id", time_id), time_id, "inner")
