import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from servicerank.llm import ngram_join
from servicerank.llm.ngram_join import PointTable, ShingleJoin, bounds, drop_near

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def near_copies(rng, base, count, edits, vocabulary):
    out = []
    for _ in range(count):
        words = base[:]
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append(" ".join(words))
    return out


@pytest.fixture
def rows():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", "  ", "one two", "One TWO", "one two three four five", "x " * 30_000, "Ünï ünï a b c d", "İ a b c d e"]
    for size, count, edits in ((30, 40, 2), (120, 90, 8), (60, 25, 6), (7, 10, 1)):
        texts += near_copies(rng, [rng.choice(vocabulary) for _ in range(size)], count, edits, vocabulary)
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 80))) for _ in range(60)]
    rng.shuffle(texts)
    return list(enumerate(texts, start=10))


@pytest.mark.parametrize("crowd", [16, 1_000_000])
def test_components_equal_brute_force(make, rows, crowd, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ShingleJoin(make(rows)).groups().collect()}
    assert got == brute(rows)


def test_hot_shingles_and_small_leaves(make, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", -1)
    monkeypatch.setattr(ngram_join, "LEAF", 3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ShingleJoin(make(rows)).groups().collect()}
    assert got == brute(rows)


def test_the_text_that_all_share_most_with_is_compared_first(spark):
    """Node 500 stands below 30 shingles, all others below one; node 1 below one that only two share."""
    rows = [(s, n, 21) for s in range(30) for n in (500, *range(1000 + 20 * s, 1020 + 20 * s))]
    rows += [(99, 1, 2), (99, 500, 2)]
    got = {tuple(r) for r in ngram_join._star(spark.createDataFrame(rows, "shingle long, node long, k long")).collect()}
    # With it, and with the smallest of each group, which it is here.
    assert got == {(n, 500) for n in range(1000, 1600)} | {(500, 1)}


def test_repeated_rows_null_ids_and_empty_table(make):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (1, "A B c d e f"), (None, "a b c d e f"), (4, None)]
    got = sorted((r.doc_id or 0, r.component_id) for r in ShingleJoin(make(rows)).groups().collect())
    assert got == [(0, 1), (1, 1), (3, 1), (3, 1), (4, 4)]
    assert ShingleJoin(make([])).groups().collect() == []


def test_drop_near_keeps_one_of_each_group(make, rows):
    docs = make(rows)
    kept = drop_near(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute(rows).values()})


@pytest.mark.parametrize("leaf, columns", [(ngram_join.LEAF, ngram_join.COLUMNS), (3, 7)])
def test_n_links_counts_all_rows_that_reach_the_similarity(make, rows, leaf, columns, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    monkeypatch.setattr(ngram_join, "COLUMNS", columns)
    rows = rows + [(i + 1000, text) for i, text in rows[::7]]
    sets = {i: shingles(t) for i, t in rows}
    wanted = dict.fromkeys(sets, 0)
    for a, b in itertools.combinations(sets, 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
            wanted[a] += 1
            wanted[b] += 1
    got = ShingleJoin(make(rows)).groups().collect()
    assert {r.doc_id: r.n_links for r in got} == wanted
    assert max(wanted.values()) > 30


def test_n_links_of_ids_with_several_texts(make):
    texts = ["a b c d e f g h i j k l", "a b c d e f g h i j k l m", "p q r s t u v w"]
    rows = [(1, texts[0]), (2, texts[1]), (2, texts[2]), (3, texts[0]), (None, texts[2]), (4, None)]
    got = sorted((r.doc_id or 0, r.n_shingles, r.n_links) for r in ShingleJoin(make(rows)).groups().collect())
    assert got == [(0, 4, 1), (1, 8, 2), (2, 4, 1), (2, 9, 2), (3, 8, 2), (4, 0, 0)]


#: A Thue-Morse word and the one with its letters exchanged: polynomials modulo 2**64 can't tell them apart.
MORSE = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
OTHER = MORSE.translate(str.maketrans("ab", "ba"))


def test_words_that_weak_hashes_confuse_are_told_apart(make):
    spaced, other = " ".join(MORSE), " ".join(OTHER)
    rows = [(1, MORSE), (2, OTHER), (3, MORSE.upper()), (4, "p q r s " + MORSE), (5, "p q r s " + OTHER), (6, spaced), (7, other)]
    got = {r.doc_id: r.component_id for r in ShingleJoin(make(rows)).groups().collect()}
    assert got == {i: c for i, (_, c) in brute(rows).items()}
    assert got[2] == 2 and got[3] == 1 and got[5] == 5


def test_bounds_hold_and_rule_out_unrelated_sets_of_every_size():
    draw = np.random.default_rng(3)
    for n in (3, 40, 500, 5_000, 60_000):
        base = draw.integers(0, 2**64, n, dtype=np.uint64)
        near = np.unique(np.concatenate([base[: n - n // 20], draw.integers(0, 2**64, n // 15 + 1, dtype=np.uint64)]))
        sets = [np.unique(base), near, np.unique(draw.integers(0, 2**64, max(2, int(n * 0.85)), dtype=np.uint64))]
        sizes = np.array([len(s) for s in sets])
        table = PointTable(ngram_join._points(np.concatenate(sets), np.repeat(np.arange(3), sizes), sizes)[0], sizes)
        one, two = np.array([0, 0, 1]), np.array([1, 2, 2])
        shared = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(one, two, strict=True)])
        most = bounds(table, one, table, two)
        assert (most >= shared).all() and (most <= np.minimum(sizes[one], sizes[two])).all()
        if n >= 500:
            assert most[1] < ngram_join._needed(sizes[0] + sizes[2], 80)


def test_points_of_different_width_are_compared(monkeypatch):
    sizes = np.array([760, 780])
    hashes = np.random.default_rng(1).integers(0, 2**64, 780, dtype=np.uint64)
    both = np.concatenate([hashes[:760], hashes])
    points, _ = ngram_join._points(both, np.repeat([0, 1], sizes), sizes)
    assert [len(p) for p in points.to_pylist()] == [128, 256]
    table = PointTable(pa.array(points), sizes)
    assert bounds(table, np.array([0, 1]), table, np.array([1, 0])).tolist() == [760, 760]
    for most in (1, 5, 9):
        monkeypatch.setattr(ngram_join, "MOST", most)
        table = PointTable(ngram_join._points(both, np.repeat([0, 1], sizes), sizes)[0], sizes)
        assert bounds(table, np.array([0]), table, np.array([1]))[0] >= 760


def test_leaves_rule_out_texts_that_nearly_link():
    """Versions of one text: links must stay, and few of the many pairs a little short of linking may."""
    draw = np.random.default_rng(5)
    base = draw.integers(0, 2**64, 340, dtype=np.uint64)
    sets = []
    for kept in [0.88] * 60 + [0.96] * 20:
        fresh = draw.integers(0, 2**64, len(base), dtype=np.uint64)
        sets.append(np.unique(np.where(draw.random(len(base)) < kept, base, fresh)))
    n = np.array([len(s) for s in sets])
    held = ngram_join._points(np.concatenate(sets), np.repeat(np.arange(len(sets)), n), n)[1]
    rows = [{"doc": i, "n": int(n[i]), "component": i, "held": h} for i, h in enumerate(held.to_pylist())]
    kind = pa.list_(pa.struct([("doc", pa.int64()), ("n", pa.int64()), ("component", pa.int64()), ("held", pa.binary())]))
    leaf = ngram_join.Leaves(pa.array([rows], kind))
    got = set(zip(*(x.tolist() for x in ngram_join.leaf_pairs(leaf, leaf, 80)), strict=True))
    near, linked = 0, set()
    for b, a in itertools.combinations(range(len(sets)), 2):
        shared = len(np.intersect1d(sets[a], sets[b], True))
        if 100 * shared >= 80 * (n[a] + n[b] - shared):
            linked.add((a, b))
        near += 100 * shared >= 70 * (n[a] + n[b] - shared)
    assert len(linked) > 150 and linked <= got
    assert near > 900 and len(got - linked) < near / 5


def test_bits_that_differ_are_members_of_one_set():
    draw = np.random.default_rng(6)
    sets = [np.empty(0, np.uint64)]
    for size in (1, 7, 250, 500, 530, 4_000, 40_000, 60_000):
        sets.append(np.unique(draw.integers(0, 2**64, size, dtype=np.uint64)))
        sets.append(np.append(sets[-1][size // 9 :], draw.integers(0, 2**64, size // 5, dtype=np.uint64)))
    n = np.array([len(s) for s in sets])
    table = ngram_join.ParityTable(ngram_join._points(np.concatenate(sets), np.repeat(np.arange(len(sets)), n), n)[1])
    assert len(set(table.width.tolist())) > 3
    one, two = (np.array(x) for x in zip(*itertools.product(range(len(sets)), repeat=2), strict=True))
    least = ngram_join.apart(table, one, table, two)
    differ = np.array([len(np.setxor1d(sets[i], sets[j])) for i, j in zip(one, two, strict=True)])
    assert (least <= differ).all() and (least[one == two] == 0).all()
    # Of each set and its version most differences show.
    version = (one % 2 == 1) & (two == one + 1) & (n[one] < 10_000)
    assert (least[version] >= 0.6 * differ[version]).all()
