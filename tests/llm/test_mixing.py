import math
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from servicerank.llm.mixing import mix, mixed_documents, n_words, targets
from servicerank.llm.queries import ORACLE_SQL, op11_mix_sources

SCHEMA = "doc_id long, text string, source string, size long, target int, _key string, weight string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, "k", "w") for i, t, s in rows], SCHEMA)


def resharing(held, shares, total, most):
    """Targets by sharing the excess again and again."""
    names = sorted(held, key=lambda s: (s is None, (s or "").encode()))
    share = {s: shares[i % len(shares)] for i, s in enumerate(names)}
    aim, left = dict.fromkeys(names, 0.0), total * sum(held.values())
    for _ in range(200):
        open_ = [s for s in names if aim[s] < most * held[s] - 1e-9]
        if left < 1e-9 or not open_:
            break
        weight, unit = sum(share[s] for s in open_), left
        for s in open_:
            more = min(unit * share[s] / weight, most * held[s] - aim[s])
            aim[s] += more
            left -= more
    return aim


def test_targets_equal_repeated_resharing(spark):
    held = {"a": 10, "b": 500, "Z": 40, "é": 3, None: 77, "": 0, "zz": 260, "b2": 8}
    rows = spark.createDataFrame([(s, n) for s, n in held.items()], "_source string, _size long")
    for total in (0.5, 1.5, 1.9, 2.0):
        got = {r._source: r._target for r in targets(rows, total=total).collect()}
        want = resharing(held, (5, 2, 1), total, 2)
        assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in want)


def mixture(spark):
    texts = ["a b c", "", None, " \x0b", "x" * 40, "long " * 300]
    return table(spark, [(i, texts[i % 6] if i % 4 else "w " * (i % 17), ["s", "t", "u", None, ""][min(i % 7, 4)]) for i in range(400)])


def test_source_sums_come_near_targets(spark):
    docs = mixture(spark)
    rows = mix(docs).collect()
    assert len(rows) == 400
    sums, most = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size and 0 <= r.copies <= 2
        sums[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    for r in rows:
        assert abs(sums[r.source] - r.target) <= most[r.source] / 2


def test_reruns_agree_whatever_the_partitions(spark):
    docs = mixture(spark)
    want = sorted(map(tuple, mix(docs).drop("source").collect()))
    assert sorted(map(tuple, mix(docs.repartition(7)).drop("source").collect())) == want
    assert sorted(map(tuple, mix(docs, seed=12).drop("source").collect())) != want


def test_weights_shift_the_draw(spark):
    docs = table(spark, [(i, "a b", "s") for i in range(2000)])
    weights = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(4.0).alias("weight"))
    odd = spark.createDataFrame([(1500, None), (1501, -1.0), (None, 3.0), (0, 4.0)], "doc_id long, weight double")
    rows = mix(docs, weights.union(odd)).collect()
    heavy = sum(r.copies for r in rows if r.doc_id < 1000) - 1000
    light = sum(r.copies for r in rows if r.doc_id >= 1000) - 1000
    assert heavy + light == 1000
    # Weights 4 and 1: the sampled half holds 1 - x**4 of the heavy ones and 1 - x of the light ones, with x = 0.72.
    assert 660 < heavy < 800


def test_odd_tables(spark):
    assert mix(table(spark, [])).collect() == []
    assert [tuple(r)[2:] for r in mix(table(spark, [(1, None, None), (None, "", "a")])).collect()] == [(0, 0, 0.0, 0, 0)] * 2
    rows = mix(table(spark, [(1, "a b", "s")] * 3 + [(None, "c", "s")])).collect()
    assert sum(r.taken for r in rows) == 11 or sum(r.taken for r in rows) == 10
    assert all(r.source_size == 7 and r.target == 10.5 for r in rows)


def test_mixed_documents_are_whole_rows(spark):
    docs = mixture(spark)
    drawn = mixed_documents(docs)
    assert drawn.columns == docs.columns
    want = {r.doc_id: r.taken for r in mix(docs).collect() if r.taken}
    got = drawn.groupBy("doc_id").agg(F.sum(n_words(F.col("text"))).alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == want


@pytest.mark.parametrize("odd", [False, True])
def test_query_equals_its_twin(spark, tables, tmp_path, odd):
    folder = tables
    if odd:
        folder = str(tmp_path)
        mixture(spark).write.parquet(f"{folder}/documents.parquet")
        labels = [(i, i % 2, 0) for i in range(0, 300, 3)] + [(3, 0, 0), (None, 1, 1), (6, None, None)]
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        files = f"{folder}/{name}.parquet/*.parquet" if odd else f"{folder}/{name}.parquet"
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    got = op11_mix_sources(spark, folder)
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op11_mix_sources']})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
