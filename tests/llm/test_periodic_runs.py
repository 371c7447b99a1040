import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from servicerank.llm.periodic_runs import WaveletTree, find_runs, periodic_runs
from servicerank.llm.queries import op13_periodic_runs


def cut(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(words):
    """Every period, every maximal stretch that has it and no smaller one."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            part = words[i : i + size]
            smaller = any(all(x == y for x, y in zip(part, part[p:], strict=False)) for p in range(1, q))
            if size >= max(6, 4 * q) and not smaller:
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    draw = random.Random(5)
    out = [None, "", " \t\n", "a", "a b c", "x " * 5, "x " * 6, "a b " * 4, "\x0ba b\x0cc " * 9, "a a b " * 7 + "c " * 30 + "a a b " * 7]
    for _ in range(150):
        words = [draw.choice("abc"[: draw.randint(1, 3)]) for _ in range(draw.randint(0, 40))]
        for _ in range(draw.randint(0, 3)):
            at, period = draw.randint(0, len(words)), [draw.choice("abcd") for _ in range(draw.randint(1, 9))]
            words[at:at] = (period * 9)[: draw.randint(len(period) * 3, len(period) * 8)]
        out.append(" ".join(words))
    return out


# Thue-Morse words have no run of exponent 4, however long.
MORSE = " ".join("ab"[bin(i).count("1") % 2] for i in range(4096))


def test_runs_equal_brute_force(make):
    docs = make(list(enumerate([*texts(), MORSE])))
    got = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert len(got) == docs.count()
    for i, text in enumerate(texts()):
        words = cut(text)
        want = brute_runs(words)
        assert [tuple(r) for r in got[i].runs] == want, text
        assert (got[i].n_words, got[i].collapsed) == (len(words), collapsed(words, want))
    assert got[len(texts())].runs == [] and got[len(texts())].collapsed == MORSE


def test_sequences_do_not_run_into_each_other():
    symbols = np.array([1, 2] * 6)
    assert [x.tolist() for x in find_runs(symbols, np.array([0, 7, 7, 12]))] == [[], [], []]
    assert [x.tolist() for x in find_runs(symbols, np.array([0, 12]))] == [[0], [12], [2]]


def test_wavelet_tree_counts_and_ranks():
    draw = np.random.default_rng(2)
    values = draw.permutation(300)
    tree = WaveletTree(values)
    low = draw.integers(0, 299, 400)
    high = np.array([draw.integers(a + 1, 301) for a in low])
    at = draw.integers(0, high - low)
    bound = values[draw.integers(0, 300, 400)]
    for k in range(400):
        part = np.sort(values[low[k] : high[k]])
        assert tree.ranked(low[k : k + 1], high[k : k + 1], at[k : k + 1])[0] == part[at[k]]
        assert tree.below(low[k : k + 1], high[k : k + 1], bound[k : k + 1])[0] == (part < bound[k]).sum()


def test_long_text_and_repeated_rows(make):
    long = "w0 " + "a b c " * 60_000 + "end"
    rows = periodic_runs(make([(1, long), (1, long), (None, "z " * 8)])).collect()
    assert sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in rows) == [
        (0, [(0, 8, 1)], "z"), (1, [(1, 180_000, 3)], "w0 a b c end"), (1, [(1, 180_000, 3)], "w0 a b c end")
    ]
    assert periodic_runs(make([])).collect() == []


@pytest.mark.parametrize("extra", [False, True])
def test_query_equals_brute_force(spark, tmp_path, make, extra, documents):
    if extra:
        docs = make([(i, t) for i, t in enumerate(texts())] + [(None, "q " * 7)])
    else:
        docs = documents.filter(F.length("text") < 2500)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op13_periodic_runs(spark, str(tmp_path)).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        words = cut(text)
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        assert tuple(got[doc_id])[1:] == (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(collapsed(words, runs)),
        )
