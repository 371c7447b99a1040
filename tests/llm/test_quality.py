import numpy as np
import pytest
from pyspark.sql import functions as F

from servicerank.llm import quality
from servicerank.llm.queries import op6_quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return quality.train(docs, labels), docs, labels


def test_held_out_accuracy(spark, trained):
    _, _, labels = trained
    got = op6_quality(spark, SF).join(labels, "doc_id").filter("held_out")
    right = got.select(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.95


def test_held_out_rows_are_never_learned_from(spark, trained):
    _, docs, labels = trained
    spoiled = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.train(docs, t, sample=100) for t in (labels, spoiled))
    assert all(np.array_equal(one.weights[k], two.weights[k]) for k in one.weights)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    bags = [rng.normal(0, 1, (n, quality.WIDTH)) for n in (1, 3, 2, 5)]
    labels = np.array([0.0, 1, 1, 0])
    model = quality.fit(bags, labels, epochs=1)
    model.weights = {k: np.array(v) for k, v in model.weights.items()}
    x, text_of = np.concatenate(bags), np.repeat(np.arange(4), [1, 3, 2, 5])

    def loss():
        p = model.score(x, text_of, 4)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    found = quality._gradients(model, x, text_of, labels)
    for name, at in (("encode", (3, 5)), ("tanh", (2, 1)), ("gate", (4, 3)), ("attend", (2,)), ("score", (7,)), ("score_bias", ())):
        weights = model.weights[name]
        value = float(weights[at])
        ends = []
        for step in (1e-5, -1e-5):
            weights[at] = value + step
            ends.append(loss())
        weights[at] = value
        assert found[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=1e-3, abs=1e-7)


def test_every_text_has_a_score_alone_or_in_a_batch(trained, make):
    model = trained[0]
    texts = [None, "", "  \n ", "word", "the text " * 60_000, "a\n" * 500, "é!!!", "word"]
    got = {r.doc_id: r for r in quality.score(make(list(enumerate(texts))), model).collect()}
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got.values())
    assert got[0].score == got[1].score and got[3].score == got[7].score
    assert got[4].n_passages > 900
    alone = quality.score(make([(5, texts[5])]), model).first()
    assert alone.score == pytest.approx(got[5].score)
    assert quality.score(make([]), model).collect() == []


def test_filter_keeps_columns_and_agrees_with_scores(trained, make):
    model, docs, _ = trained
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.score(docs, model).filter("score >= 0.5").collect()}
    assert quality.keep_good(make([]), model).collect() == []


def test_no_labels_and_repeated_labels(make, trained, spark):
    _, docs, labels = trained
    model = quality.train(docs, labels.limit(0))
    assert quality.score(make([(1, "x")]), model).first().score > 0
    assert quality.train(docs, labels.unionAll(labels), sample=50).weights.keys() == model.weights.keys()
