"""The test tables in the roles of the feed, the reviews and the service points."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from servicerank.functions.clock import format_snapshot_time, whole_minutes_since
from servicerank.functions.text import safe_bool
from servicerank.operators.calendar import DEFAULT_CALENDAR, Calendar
from servicerank.operators.facts import queue_fact, reviews_fact
from servicerank.schemas import ENTITY
from servicerank.sources.snapshots import to_lake_rows

# Days of the events, and a calendar that reaches back to the orders.
FIRST_DAY, END_DAY = date(2024, 1, 1), date(2024, 1, 31)
REVIEW_CALENDAR = Calendar(origin=datetime(1995, 1, 1))
LABEL_PATTERN = " ® Suffix"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    """The number in `{"k": 12}`."""
    return F.substring_index(F.substring_index("props", ": ", -1), "}", 1).cast("bigint")


def feed(events: DataFrame) -> DataFrame:
    """An event as one service point's snapshot, with texts as unclean as the real feed's."""
    k = _k()
    return events.select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("Point "), F.col("user_id")).alias("name"),
        F.col("value").alias("lat"),
        F.array(F.col("event_type"), k.cast("string")).alias("stops"),
        F.when(k >= 97, None).when(k % 10 == 3, F.concat(k, F.lit(".0"))).otherwise(k.cast("string"))
        .alias("currently_waiting"),
        F.when(F.col("event_type") != "error", F.floor(F.col("value") * 60)).alias("expected_wait_time"),
        (k % 5).alias("active_counters"),
        _is_open(k).alias("is_open"),
        format_snapshot_time(F.col("ts")).alias("time"),
    )


def _is_open(k: Column) -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "signup", "False")
        .when((kind == "purchase") & (k < 5), "yes")
        .when(kind == "view", "true")
        .otherwise("True")
    )


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw lake rows, each stamped with its own time."""
    return to_lake_rows(feed(table(spark, sf_dir, "events")), F.col("time"))


def unpartitioned_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).drop("ingest_date")


def unclean_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unpartitioned lake with some times in another form, missing, or before the calendar."""
    rows, k = unpartitioned_lake(spark, sf_dir), F.col("active_counters")
    odd = (
        F.when((k == "1") & (F.col("is_open") == "true"), F.translate("time", "/", "-"))
        .when((k == "2") & (F.col("is_open") == "False"), "None")
        .when(k == "3", F.concat(F.lit("10"), F.substring("time", 3, 20)))
        .otherwise(F.col("time"))
    )
    return rows.withColumn("time", odd)


def queue_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue fact over all days of the events, by way of their text."""
    return queue_fact(unpartitioned_lake(spark, sf_dir), FIRST_DAY, END_DAY)


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fact from the events' numbers."""
    k = _k()
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(ENTITY),
        DEFAULT_CALENDAR.time_id(F.col("ts")).alias("time_id"),
        F.when((k < 97) & (k % 10 != 3), k).alias("customers_currently_waiting"),
        F.when(F.col("event_type") != "error", F.floor(F.col("value") * 60)).alias("expected_wait_time"),
        (k % 5).alias("active_counters"),
        safe_bool(_is_open(k)).alias("is_open"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reviews; their times end in half a second, some scores and votes are missing."""
    key = F.col("o_orderkey")
    seconds = whole_minutes_since(datetime(1970, 1, 1), F.col("o_orderdate")) * 60 + key % 86400
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id_bq"),
        (seconds * 1_000_000_000 + 500_000_000).alias("Date"),
        F.when(key % 17 != 0, F.substring("o_orderpriority", 1, 1).cast("int")).alias("Rating"),
        F.when(key % 13 != 0, (key % 4).cast("int")).alias("Helpful_count"),
        F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("Review"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_fact(raw_reviews(spark, sf_dir), REVIEW_CALENDAR)


def rating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a rating needs of the reviews, which is neither their ids nor their times."""
    return raw_reviews(spark, sf_dir).select(
        F.col("id_bq").alias(ENTITY),
        F.col("Rating").alias("review_score"),
        F.col("Helpful_count").alias("number_upvotes_review"),
    )


def service_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias(ENTITY),
        F.concat(F.col("s_name"), F.when(key % 5 == 0, LABEL_PATTERN * 2).otherwise(LABEL_PATTERN)).alias("name"),
        F.concat(F.lit("POINT("), key, F.lit(" "), F.col("s_nationkey"), F.lit(")")).alias("location"),
        (40 + key * 7 % 60).cast("int").alias("number_of_open_hours_per_week"),
        (1 + key * 3 % 11).cast("int").alias("number_of_bus_stops"),
    )
