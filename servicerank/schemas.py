"""Table schemas and the column names shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of a raw snapshot, all text, in file order.
SNAPSHOT_COLUMNS = [
    "id", "name", "lat", "lon", "phone", "email", "url", "address", "postal_code", "locality",
    "parish_id", "parish_name", "municipality_id", "municipality_name", "district_id", "district_name",
    "region_id", "region_name", "hours_monday", "hours_tuesday", "hours_wednesday", "hours_thursday",
    "hours_friday", "hours_saturday", "hours_sunday", "hours_special", "stops", "currently_waiting",
    "expected_wait_time", "active_counters", "is_open", "time",
]

# The text form of a snapshot's ingest time (UTC).
SNAPSHOT_TIME_FORMAT = "yy/MM/dd HH:mm:ss"

# Criteria of the decision matrix and of the ranked report.
MATRIX_CRITERIA = [
    "average_expected_wait_time_in_rush_hour",
    "number_of_opening_hours_per_week",
    "number_of_bus_stops",
    "weighted_average_rating_on_google_reviews",
]
REPORT_CRITERIA = [
    "expected_wait_time_in_rush_hour",
    "number_of_opnening_hours_per_week",
    "number_of_bus_stops",
    "average_rating_on_google_reviews",
]

# Weights of the criteria above, in the same order.
DEFAULT_WEIGHTS = [0.45, 0.15, 0.15, 0.25]

# Default name of the service-point key; every operator takes another one.
ENTITY = "service_point_id"

# Load and wait of a queue snapshot.
LOAD = "customers_currently_waiting"
WAIT = "expected_wait_time"


def lake_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in SNAPSHOT_COLUMNS])


def reviews_schema() -> T.StructType:
    return T.StructType([
        T.StructField("id_bq", T.LongType()),
        T.StructField("Date", T.LongType()),
        T.StructField("Rating", T.IntegerType()),
        T.StructField("Helpful_count", T.IntegerType()),
        T.StructField("Review", T.StringType()),
    ])


def service_point_schema(entity: str = ENTITY) -> T.StructType:
    texts = ["name", "location", "phone", "address", "postal_code", "municipality_name", "district_name", "shift"]
    return T.StructType(
        [T.StructField(entity, T.LongType(), False)]
        + [T.StructField(c, T.StringType()) for c in texts]
        + [T.StructField(c, T.IntegerType()) for c in ("number_of_open_hours_per_week", "number_of_bus_stops")]
    )


def time_dimension_schema() -> T.StructType:
    parts = ["day_of_week", "hour", "day_number_in_month", "week_number_in_year", "month_number"]
    return T.StructType(
        [T.StructField("time_id", T.LongType()), T.StructField("full_date", T.TimestampNTZType())]
        + [T.StructField(c, T.IntegerType()) for c in parts]
        + [T.StructField(c, T.BooleanType()) for c in ("weekday_flag", "holiday_flag")]
    )


def queue_fact_schema(entity: str = ENTITY) -> T.StructType:
    longs = [entity, "time_id", "customers_currently_waiting", "expected_wait_time", "active_counters"]
    return T.StructType([T.StructField(c, T.LongType()) for c in longs] + [T.StructField("is_open", T.BooleanType())])


def rush_state_schema(entity: str = ENTITY) -> T.StructType:
    longs = [entity, "slot", LOAD, "most", "total", "known", "missing"]
    return T.StructType([T.StructField(c, T.LongType()) for c in longs])


def reviews_fact_schema(entity: str = ENTITY) -> T.StructType:
    return T.StructType(
        [T.StructField(c, T.LongType()) for c in ("review_id", entity, "time_id")]
        + [T.StructField(c, T.IntegerType()) for c in ("review_score", "number_upvotes_review")]
        + [T.StructField("full_review", T.StringType())]
    )
