import pytest
from helpers import plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from servicerank.operators.decision import (
    decision_matrix, normalize_criteria, rank_by_score, weigh_criteria, weighted_sum_rank,
)
from servicerank.schemas import DEFAULT_WEIGHTS, MATRIX_CRITERIA, REPORT_CRITERIA

MATRIX = "service_point_id long, " + ", ".join(
    f"{c} {t}" for c, t in zip(MATRIX_CRITERIA, ["long", "int", "int", "double"])
)


def points(spark):
    return spark.createDataFrame(
        [(1, "A ® S", "POINT(0 0)", 40, 2), (2, "B ® S ® S", "POINT(1 1)", 80, 4), (3, "C", None, 10, 1)],
        "service_point_id long, name string, location string, number_of_open_hours_per_week int, number_of_bus_stops int",
    )


def matrix(spark, data=((1, 10, 40, 2, 4.0), (2, 20, 80, 4, 2.0))):
    return spark.createDataFrame(data, MATRIX)


def test_matrix_needs_wait_and_rating(spark):
    waits = spark.createDataFrame([(1, 10), (2, 20)], "service_point_id long, avg_max_wait_time_rush_hour long")
    ratings = spark.createDataFrame([(1, 4.0), (3, 5.0)], "service_point_id long, weighted_average_review_score double")
    got = decision_matrix(points(spark), waits, ratings)
    assert got.columns == ["service_point_id", *MATRIX_CRITERIA]
    assert rows(got) == [(1, 10, 40, 2, 4.0)]


def test_costs_and_benefits(spark):
    assert rows(normalize_criteria(matrix(spark))) == [(1, 1.0, 0.5, 0.5, 1.0), (2, 0.5, 1.0, 1.0, 0.5)]


def test_normalised_values_lie_in_unit_range_and_equal_window_form(spark):
    df = spark.range(1, 300).select(
        F.col("id").alias("service_point_id"), (F.col("id") * 7 % 31 + 1).alias("a"), (F.col("id") * 3 % 17 + 1).alias("b")
    )
    got = normalize_criteria(df, {"a": "cost", "b": "benefit"})
    whole = Window.partitionBy()
    want = df.select(
        "service_point_id", (F.min("a").over(whole) / F.col("a")).alias("normalized_a"),
        (F.col("b") / F.max("b").over(whole)).alias("normalized_b"),
    )
    assert rows(got) == rows(want)
    assert got.filter("not (normalized_a > 0 and normalized_a <= 1 and normalized_b > 0 and normalized_b <= 1)").count() == 0


def test_extremes_are_a_scalar_subquery(spark):
    shown = plan(normalize_criteria(matrix(spark)))
    assert "Subquery" in shown and "Window" not in shown and "NestedLoop" not in shown and "Cartesian" not in shown


def test_zero_wait_fails_or_is_null(spark):
    df = matrix(spark, [(1, 0, 40, 2, 4.0), (2, 20, 80, 4, 2.0)])
    with pytest.raises(PySparkException):
        normalize_criteria(df).collect()
    assert rows(normalize_criteria(df, safe=True))[0] == (1, None, 0.5, 0.5, 1.0)


def test_unknown_kind_is_refused(spark):
    with pytest.raises(ValueError, match="cost"):
        normalize_criteria(matrix(spark), {MATRIX_CRITERIA[0]: "price"})


def test_weights_must_sum_to_one(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0)], "id long, a double, b double")
    with pytest.raises(ValueError, match="sum to 1"):
        weigh_criteria(df, {"a": ("x", 0.5), "b": ("y", 0.55)})
    assert rows(weigh_criteria(df, {"a": ("x", 0.25), "b": ("y", 0.75)})) == [(1, 0.25, 0.75, 1.0)]
    with pytest.raises(ValueError, match="sum to 1"):
        weighted_sum_rank(matrix(spark), points(spark), weights=dict(zip(REPORT_CRITERIA, [0.5, 0.15, 0.15, 0.25])))


def test_ranked_report(spark):
    got = weighted_sum_rank(matrix(spark), points(spark), label_pattern=" ® S").collect()
    assert [(r.service_point_id, r.name, r.location) for r in got] == [(1, "A", "POINT(0 0)"), (2, "B", "POINT(1 1)")]
    assert got[0].performance_score == pytest.approx(0.45 + 0.075 + 0.075 + 0.25)
    assert got[1].performance_score == pytest.approx(0.225 + 0.15 + 0.15 + 0.125)
    assert list(got[0].asDict()) == ["service_point_id", "name", "location", *REPORT_CRITERIA, "performance_score"]
    assert sum(DEFAULT_WEIGHTS) == pytest.approx(1)


def test_order_is_by_score_then_id_with_nulls_last(spark):
    df = spark.createDataFrame([(3, 0.5), (1, None), (2, 0.5), (4, 0.9)], "id long, performance_score double")
    assert [r.id for r in rank_by_score(df, "id").collect()] == [4, 2, 3, 1]
