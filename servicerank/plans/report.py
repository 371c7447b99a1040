"""From the facts to the ranked report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from servicerank.functions.clock import day_floor
from servicerank.operators.calendar import DEFAULT_CALENDAR, Calendar, attach_calendar
from servicerank.operators.decision import REPORT_WEIGHTS, decision_matrix, weighted_sum_rank
from servicerank.operators.imputation import impute_group_mean
from servicerank.operators.facts import open_known
from servicerank.operators.peaks import rush_wait, rush_wait_of_fold
from servicerank.operators.ratings import weighted_rating
from servicerank.schemas import ENTITY, LOAD, WAIT
from servicerank.session import materialize
from servicerank.sources.warehouse import create_views

RUSH_WAIT = "avg_max_wait_time_rush_hour"

# Arguments of the peak operators on the open queue.
PEAK = {"period": "day_of_week", "bucket": "hour", "day": "cday"}


def open_queue(queue: DataFrame, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """Queue rows of open points (NULL counts as closed) with day and calendar attributes."""
    return attach_calendar(open_known(queue, calendar), calendar).withColumn("cday", day_floor(F.col("full_date")))


def imputed_wait(
    queue: DataFrame, calendar: Calendar = DEFAULT_CALENDAR, entity: str = ENTITY, **options
) -> DataFrame:
    """Open queue rows with their wait in minutes, missing waits imputed."""
    rows = open_queue(queue, calendar).select(entity, "cday", "day_of_week", "hour", LOAD, WAIT)
    return impute_group_mean(rows, WAIT, LOAD, "expected_wait_time_imputed", scale=60, **options).drop(WAIT)


def rush_hour_waits(
    queue: DataFrame, calendar: Calendar = DEFAULT_CALENDAR, entity: str = ENTITY, **options
) -> DataFrame:
    """Mean rush-hour wait in minutes per service point."""
    slots = open_known(queue, calendar).withColumn("slot", calendar.hour_number(F.col("time_id")))
    return rush_wait(slots, entity, "slot", *_period_and_bucket(calendar), LOAD, WAIT, RUSH_WAIT, 60, **options)


def rush_hour_waits_of_state(
    state: DataFrame, calendar: Calendar = DEFAULT_CALENDAR, entity: str = ENTITY
) -> DataFrame:
    """rush_hour_waits from the stored rush-hour state instead of the fact."""
    return rush_wait_of_fold(state, entity, "slot", *_period_and_bucket(calendar), LOAD, RUSH_WAIT, 60)


def _period_and_bucket(calendar: Calendar) -> tuple[Column, Column]:
    """Day of week and hour of a slot."""
    start = calendar.hour_start(F.col("slot"))
    return F.dayofweek(start.cast("date")), F.hour(start)


def review_ratings(reviews: DataFrame, entity: str = ENTITY) -> DataFrame:
    return weighted_rating(reviews, entity, "review_score", "number_upvotes_review")


def service_point_matrix(
    queue: DataFrame,
    reviews: DataFrame,
    points: DataFrame,
    calendar: Calendar = DEFAULT_CALENDAR,
    entity: str = ENTITY,
) -> DataFrame:
    """Decision matrix from the two facts and the service-point dimension."""
    return decision_matrix(
        points, rush_hour_waits(queue, calendar, entity), review_ratings(reviews, entity), entity
    )


def service_point_matrix_of_state(
    state: DataFrame,
    reviews: DataFrame,
    points: DataFrame,
    calendar: Calendar = DEFAULT_CALENDAR,
    entity: str = ENTITY,
) -> DataFrame:
    """The same matrix from the rush-hour state; the queue fact is not read."""
    return decision_matrix(
        points, rush_hour_waits_of_state(state, calendar, entity), review_ratings(reviews, entity), entity
    )


def ranked_report(
    queue: DataFrame,
    reviews: DataFrame,
    points: DataFrame,
    calendar: Calendar = DEFAULT_CALENDAR,
    entity: str = ENTITY,
    weights: dict[str, float] = REPORT_WEIGHTS,
    label_pattern: str | None = None,
    safe: bool = False,
    of_state: bool = False,
) -> DataFrame:
    """Service points by weighted score, best first.

    Runs the matrix when called and stores its one row per point: the report
    reads it twice, for the rows and for the extremes, and Spark would otherwise
    go through the facts for each. With `of_state`, `queue` is the rush-hour
    state kept beside the fact.
    """
    made = service_point_matrix_of_state if of_state else service_point_matrix
    matrix = materialize(made(queue, reviews, points, calendar, entity), "matrix")
    return weighted_sum_rank(matrix, points, entity, weights, label_pattern, safe)


def ranked_report_of_views(
    spark: SparkSession,
    entity: str = ENTITY,
    weights: dict[str, float] = REPORT_WEIGHTS,
    label_pattern: str | None = None,
    safe: bool = False,
) -> DataFrame:
    """ranked_report from the session's views `view_decision_matrix` and `dim_service_point`, whoever made them."""
    matrix = materialize(spark.table("view_decision_matrix"), "matrix")
    return weighted_sum_rank(matrix, spark.table("dim_service_point"), entity, weights, label_pattern, safe)


def register_views(
    queue: DataFrame,
    reviews: DataFrame,
    points: DataFrame,
    time: DataFrame,
    calendar: Calendar = DEFAULT_CALENDAR,
    entity: str = ENTITY,
) -> None:
    """The star schema and the decision matrix as views for Spark SQL."""
    create_views({
        "dim_time": time,
        "dim_service_point": points,
        "fact_customers_queue": queue,
        "fact_customers_reviews": reviews,
        "view_decision_matrix": service_point_matrix(queue, reviews, points, calendar, entity),
    })
