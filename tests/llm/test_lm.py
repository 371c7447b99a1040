import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import public_tokenizers
import pytest

from servicerank.llm import lm

PATH = public_tokenizers.path("byte_bpe_50k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def brute(rows):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    c = Counter(w for i, t in rows if not held[i] for w in tokens(t))
    n, v = c.total(), len(c)
    base = {i: sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)) for i, t in rows}
    return {i: (held[i], len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, pytest.approx(base[i])) for i, t in rows}


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 20])
def test_base_equals_brute_force(documents, frequent, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = lm.score(documents, PATH, sample=50).collect()
    assert {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == brute(rows)
    assert all(r.score < 0 for r in got)


def test_odd_texts(make):
    texts = [None, "", " \n", "Word wORD word", "long words " * 30_000, "ÉÈ é ü", "x" * 3000, "word"]
    rows = list(enumerate(texts)) + [(7, "word")]
    got = lm.score(make(rows), PATH).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].score == by_id[1].score and by_id[0].n_tokens == 1
    assert lm.score(make([]), PATH).collect() == []


def _model():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 60, 40)
    ids = rng.integers(0, 50, sizes.sum())
    pairs = np.unique(np.append(50 * 50 + ids, ids[:-1] * 50 + ids[1:]))
    return lm.fit(ids, sizes, np.bincount(ids, minlength=50), pairs, np.ones(len(pairs)), 49), ids, sizes


def test_probabilities_of_the_next_id_sum_to_one():
    model, _, _ = _model()
    for text in ([], [3], [7, 7, 1], list(range(30))):
        total = 0.0
        for last in range(50):
            ids = np.array([*text, last])
            clusters = model.score(ids, np.array([len(ids)]), np.array([0]))[0]
            rest = model.score(ids[:-1], np.array([len(text)]), np.array([0]))[0] if text else 0.0
            share = model.shares.of(ids[-2:], np.array([len(ids[-2:])]))[0]
            share -= model.shares.of(ids[-2:-1], np.array([1]))[0] if text else 0
            total += 10 ** (clusters - rest + share)
        assert total == pytest.approx(1, abs=1e-3)


def test_scores_do_not_depend_on_the_batch():
    model, ids, sizes = _model()
    begins = np.cumsum(sizes) - sizes
    together = model.score(ids, sizes, begins)
    for i in range(len(sizes)):
        alone = model.score(ids[begins[i] : begins[i] + sizes[i]], sizes[i : i + 1], np.array([0]))
        assert alone[0] == pytest.approx(together[i], rel=1e-4)


def test_no_place_sees_later_ids():
    model, _, _ = _model()
    ids = np.arange(40)
    changed = ids.copy()
    changed[20:] = 5
    inputs = [model.windows(x, np.array([40]), np.array([0])) for x in (ids, changed)]
    one, two = (model.forward(i, e)["out"].reshape(-1, lm.CLUSTERS + lm.OTHERS)[:21] for i, e, _ in inputs)
    assert np.allclose(one, two, atol=1e-5)


def test_gradients_equal_differences():
    model, ids, sizes = _model()
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    inputs, exists, at = model.windows(ids, sizes, np.cumsum(sizes) - sizes)
    here = exists[:, lm.WINDOW - lm.SCORED :]
    targets = model.cluster[ids[at[:, lm.WINDOW - lm.SCORED :]]]

    def loss():
        out = model.forward(inputs, exists)["out"]
        out = out - np.log(np.exp(out).sum(1, keepdims=True))
        return -np.take_along_axis(out, targets.reshape(-1, 1), 1)[:, 0][here.ravel()].mean()

    found = lm._gradients(model, inputs, exists, targets, here)
    found["embed"] = np.zeros_like(model.weights["embed"])
    np.add.at(found["embed"], inputs.ravel(), found.pop("inputs"))
    assert set(found) == set(model.weights)
    for name in found:
        weights = model.weights[name]
        at_ = tuple(1 for _ in weights.shape)
        value, ends = float(weights[at_]), []
        for step in (1e-4, -1e-4):
            weights[at_] = value + step
            ends.append(loss())
        weights[at_] = value
        assert found[name][at_] == pytest.approx((ends[0] - ends[1]) / 2e-4, rel=1e-2, abs=1e-6), name


def test_held_out_text_scores_above_word_counts(spark):
    got = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH).filter("held_out").collect()
    tokens_ = sum(r.n_tokens for r in got)
    assert sum(r.score for r in got) / tokens_ > sum(r.base_score for r in got) / tokens_


def test_scores_do_not_depend_on_partitions(documents):
    scores = []
    for n in (1, 4, 11):
        scores.append({r.doc_id: r.score for r in lm.score(documents.repartition(n), PATH).collect()})
    assert scores[1] == pytest.approx(scores[0], rel=1e-6)
    assert scores[2] == pytest.approx(scores[0], rel=1e-6)


def _streams(texts):
    known = lm.segments(PATH)
    return [[i for w in tokens(t) for i in (known.bpe.propose(b" " + w.encode()) if w else [known.end])] for t in texts], known


def _rows(spark, streams, known):
    ids, sizes = np.array([i for x in streams for i in x]), np.array([len(x) for x in streams])
    stored = lm.stored(ids, np.cumsum(sizes) - sizes, known.size).to_pylist()
    return spark.createDataFrame(list(enumerate(stored)), "_id long, ids binary").repartition(3)


def test_streams_are_stored_as_they_are():
    streams, known = _streams(["one two", "", "Three\u00e9 four five"])
    ids, sizes = np.array([i for x in streams for i in x]), np.array([len(x) for x in streams])
    begins = np.cumsum(sizes) - sizes
    for size in (known.size, 1 << 20):
        back = lm.read_streams(lm.stored(ids, begins, size).slice(1), size)
        assert [x.tolist() for x in back] == [ids[sizes[0] :].tolist(), sizes[1:].tolist(), (begins[1:] - begins[1]).tolist()]
    # Words begin where the vocabulary says so.
    assert known.opens[ids].sum() == 2 + 0 + 3 + 3


def test_the_layer_is_fitted_on_whole_texts_of_all_rows(spark):
    """More texts than any sample had, and words that stand only behind 8,000 characters."""
    texts = [f"word{i} other words" for i in range(1300)] + ["filler words " * 800 + "zebra quagga okapi"]
    streams, known = _streams(texts)
    ids = np.array([known.end, *(i for x in streams for i in x)])
    counts = np.bincount(ids[1:], minlength=known.size)
    common = lm.common_ids(counts)
    rows = _rows(spark, streams, known)
    pairs = lm.corpus_following(rows, known.size, common)
    assert (pairs == lm.following(ids, common, known.size)).all()

    cluster = lm.clusters(pairs, common, known.size)
    start = lm.untrained(cluster, counts, None, known.end, np.random.default_rng(5))
    for shard in (1 << 20, 1000):
        lm.SHARD, before = shard, lm.SHARD
        fitted = lm.corpus_fit(rows, start, len(ids))
        lm.SHARD = before
        moved = (fitted.weights["embed"] != start.weights["embed"]).any(1)
        # The last id of a text is an end, which is the id before the first one.
        assert set(np.flatnonzero(moved)) == set(ids.tolist())


def test_score_fits_on_what_stands_late_in_texts(make, monkeypatch):
    fitted = []
    corpus_fit = lm.corpus_fit
    monkeypatch.setattr(lm, "corpus_fit", lambda texts, *a: fitted.extend(texts.collect()) or corpus_fit(texts, *a))
    rows = [(i, "filler words " * 800 + f"end{i}") for i in range(1300) if zlib.crc32(str(i).encode()) % 5 != 1]
    lm.score(make(rows), PATH)
    streams, known = _streams([t for _, t in rows])
    want = {i: np.array(x, np.uint16).tobytes() for (i, _), x in zip(rows, streams, strict=True)}
    assert {r._id: bytes(r.ids) for r in fitted} == want and len(fitted) == len(rows)


def test_words_that_weak_hashes_confuse_are_counted_apart(make):
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = morse.translate(str.maketrans("ab", "ba"))
    rows = [(i, t) for i, t in enumerate([morse, morse, other, morse.upper(), "c " + other, other, "d"] * 2)]
    got = lm.score(make(rows), PATH, sample=5).collect()
    assert {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == brute(rows)


def test_scores_do_not_depend_on_how_many_pairs_are_broadcast(documents, monkeypatch):
    scores = []
    for pairs in (lm.PAIRS, 300, 0):
        monkeypatch.setattr(lm, "PAIRS", pairs)
        scores.append({r.doc_id: r.score for r in lm.score(documents, PATH, sample=50).collect()})
    assert scores[1] == pytest.approx(scores[0], rel=1e-5)
    assert scores[2] == pytest.approx(scores[0], rel=1e-5)


def test_scores_equal_those_of_the_layer_place_by_place():
    """Also where out's weights are so large that they are clipped, and for texts shorter than a window's context."""
    model, ids, sizes = _model()
    for factor in (1, 40):
        model.weights["out"] = model.weights["out"] * np.float32(factor)
        w = {k: v.astype(np.float64) for k, v in model.weights.items()}
        key, value = np.split(w["key_value"], 2, 1)
        keep, mix = np.split(w["keep_mix"], 2)
        begins, want = np.cumsum(sizes) - sizes, []
        for begin, size in zip(begins, sizes, strict=True):
            text, total = ids[begin : begin + size], 0.0
            for i in range(size):
                start = i // lm.SCORED * lm.SCORED - lm.LEAD
                seen = range(max(0, start), i + 1)
                x = {j: w["embed"][text[j - 1] if j else model.start] + w["place"][j - start] for j in seen}
                force = np.exp([np.clip(x[i] @ w["query"] @ (x[j] @ key), -30, 30) for j in seen])
                heard = sum(f * (x[j] @ value) for f, j in zip(force / force.sum(), seen, strict=True))
                out = np.clip(np.tanh(x[i] @ keep + heard @ mix + w["bias"]) @ w["out"] + w["out_bias"], -60, 60)
                total += out[model.cluster[text[i]]] - np.log(np.exp(out).sum())
            want.append(total / np.log(10))
        assert model.score(ids, sizes, begins) == pytest.approx(np.array(want), rel=1e-4)


def test_windows_are_laid_out_once_for_all_steps_of_a_part(monkeypatch):
    """Laying out each step's windows again took 4 % of the fit."""
    laid, steps = [], []
    windows, on = lm.AttentionModel.windows, lm.Adam.on
    monkeypatch.setattr(lm.AttentionModel, "windows", lambda self, *a: laid.append(1) or windows(self, *a))
    monkeypatch.setattr(lm.Adam, "on", lambda self, *a: steps.append(1) or on(self, *a))
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 60, 400)
    ids = rng.integers(0, 50, sizes.sum())
    pairs = np.unique(np.append(50 * 50 + ids, ids[:-1] * 50 + ids[1:]))
    lm.fit(ids, sizes, np.bincount(ids, minlength=50), pairs, np.ones(len(pairs)), 49, epochs=3)
    assert len(laid) == 1 and len(steps) == 3 * -(-int((-(-sizes // lm.SCORED)).sum()) // lm.BATCH)
