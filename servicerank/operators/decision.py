"""Decision matrix, normalised criteria and the weighted ranking."""

from __future__ import annotations

from math import isclose

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicerank.functions.text import strip_pattern
from servicerank.schemas import DEFAULT_WEIGHTS, ENTITY, MATRIX_CRITERIA, REPORT_CRITERIA

# Criteria where less is better are divided into their minimum, the others by their maximum.
MATRIX_KINDS = dict(zip(MATRIX_CRITERIA, ["cost", "benefit", "benefit", "benefit"]))
REPORT_WEIGHTS = dict(zip(REPORT_CRITERIA, DEFAULT_WEIGHTS))


def decision_matrix(
    points: DataFrame,
    waits: DataFrame,
    ratings: DataFrame,
    entity: str = ENTITY,
    wait: str = "avg_max_wait_time_rush_hour",
    rating: str = "weighted_average_review_score",
) -> DataFrame:
    """One row per service point that has both a rush-hour wait and a rating.

    Three inputs with one row per point each; left to the optimizer, which
    broadcasts what is small and merges the rest.
    """
    wait_name, hours_name, stops_name, rating_name = MATRIX_CRITERIA
    return (
        points.join(waits, entity)
        .join(ratings, entity)
        .select(
            entity,
            F.col(wait).alias(wait_name),
            F.col("number_of_open_hours_per_week").alias(hours_name),
            F.col("number_of_bus_stops").alias(stops_name),
            F.col(rating).alias(rating_name),
        )
    )


def normalize_criteria(
    df: DataFrame, criteria: dict[str, str] = MATRIX_KINDS, safe: bool = False, prefix: str = "normalized_"
) -> DataFrame:
    """Scale criteria to at most 1: x/max for a 'benefit', min/x for a 'cost'.

    The extremes are one aggregated row, read as a scalar subquery; no window
    over the whole table. `df` is read twice, so give a stored table if it is
    costly to compute. A division by zero fails the query, or gives NULL
    with `safe`. Columns outside `criteria` are kept.
    """
    unknown = set(criteria.values()) - {"cost", "benefit"}
    if unknown:
        raise ValueError(f"criteria are 'cost' or 'benefit', not {sorted(unknown)}")
    extremes = [(F.min if kind == "cost" else F.max)(c).alias(c) for c, kind in criteria.items()]
    extreme = df.agg(F.struct(*extremes).alias("extremes")).scalar()
    divide = F.try_divide if safe else Column.__truediv__

    def scaled(name: str) -> Column:
        value, bound = F.col(name).cast("double"), F.col("_extremes").getField(name).cast("double")
        return divide(bound, value) if criteria[name] == "cost" else divide(value, bound)

    others = [c for c in df.columns if c not in criteria]
    # As a column of its own the subquery is planned once, not once per criterion.
    return df.withColumn("_extremes", extreme).select(*others, *[scaled(c).alias(prefix + c) for c in criteria])


def weigh_criteria(df: DataFrame, weights: dict[str, tuple[str, float]], score: str = "performance_score") -> DataFrame:
    """Replace normalised criteria by weighted ones and add their sum.

    `weights` maps a column to (output column, weight); weights must sum to 1.
    """
    total = sum(weight for _, weight in weights.values())
    if not isclose(total, 1.0, abs_tol=1e-9):
        raise ValueError(f"weights must sum to 1, not {total}")
    others = [c for c in df.columns if c not in weights]
    weighted = df.select(*others, *[(F.col(c) * F.lit(w)).alias(name) for c, (name, w) in weights.items()])
    names = [name for name, _ in weights.values()]
    return weighted.withColumn(score, sum((F.col(n) for n in names[1:]), F.col(names[0])))


def rank_by_score(df: DataFrame, tie_break: str, score: str = "performance_score") -> DataFrame:
    """Best score first, equal scores by `tie_break`."""
    return df.orderBy(F.desc_nulls_last(score), tie_break)


def clean_labels(points: DataFrame, pattern: str, column: str = "name") -> DataFrame:
    """Remove every match of `pattern` from a label."""
    return points.withColumn(column, strip_pattern(F.col(column), pattern))


def weighted_sum_rank(
    matrix: DataFrame,
    points: DataFrame,
    entity: str = ENTITY,
    weights: dict[str, float] = REPORT_WEIGHTS,
    label_pattern: str | None = None,
    safe: bool = False,
) -> DataFrame:
    """The ranked report: named service points, weighted criteria, score."""
    if list(weights) != REPORT_CRITERIA:
        raise ValueError(f"weights are needed for {REPORT_CRITERIA}, in this order")
    normalized = normalize_criteria(matrix, MATRIX_KINDS, safe)
    scored = weigh_criteria(
        normalized, {"normalized_" + c: (name, weights[name]) for c, name in zip(MATRIX_CRITERIA, REPORT_CRITERIA)}
    )
    labels = points.select(entity, "name", "location")
    if label_pattern is not None:
        labels = clean_labels(labels, label_pattern)
    report = scored.join(labels, entity).select(
        entity, "name", "location", *REPORT_CRITERIA, "performance_score"
    )
    return rank_by_score(report, entity)
