from helpers import rows

from servicerank.operators.ratings import weighted_rating


def rate(spark, data, **options):
    df = spark.createDataFrame(data, "id long, score int, votes int")
    return rows(weighted_rating(df, "id", "score", "votes", **options))


def test_votes_plus_one_weigh(spark):
    assert rate(spark, [(1, 5, 0), (1, 1, 3)]) == [(1, 1.8)]


def test_null_score_counts_in_the_weight_only(spark):
    assert rate(spark, [(1, 5, None), (1, None, 3), (1, 4, 0)]) == [(1, 0.8)]


def test_no_votes_known(spark):
    assert rate(spark, [(1, 5, None)]) == [(1, None)]


def test_halves_round_up(spark):
    # 361 / 200 = 1.805
    data = [(1, 1, 38)] + [(1, 2, 160)]
    assert rate(spark, data) == [(1, 1.81)]
    assert rate(spark, data, digits=1) == [(1, 1.8)]


def test_products_of_score_and_votes_beyond_32_bits(spark):
    df = spark.createDataFrame([(1, 5, 2_000_000_000)], "id long, score int, votes int")
    assert weighted_rating(df, "id", "score", "votes", "out").first().out == 5.0
