"""Vote-weighted ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weighted_rating(
    df: DataFrame, entity: str, score: str, votes: str, output: str = "weighted_average_review_score", digits: int = 2
) -> DataFrame:
    """Mean score per entity, a review weighing its votes plus the writer's own.

    A NULL score still adds its weight; NULL votes leave the review out.
    """
    # Whole numbers of 64 bits, as 32 may not hold a product of score and votes.
    weight = F.col(votes).cast("bigint") + 1
    mean = F.sum(F.col(score) * weight) / F.sum(weight)
    return df.groupBy(entity).agg(F.round(mean, digits).alias(output))
