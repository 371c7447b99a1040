import hashlib
import random

import numpy as np
import pytest

from servicerank.llm import arrays, repeats, suffix_dedup
from servicerank.llm.suffix_dedup import Suffixes, remove_repeats


def brute(rows, window):
    seen, out = set(), {}
    for i, text in sorted(dict(rows).items()):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - window + 1):
            if data[s : s + window] in seen:
                gone[s : s + window] = b"\1" * window
            seen.add(data[s : s + window])
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out[i] = len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()
    return out


@pytest.fixture
def rows():
    rng = random.Random(7)
    passages = ["".join(rng.choice("abcdé \n") for _ in range(n)) for n in (99, 100, 101, 150, 400)]
    texts = [None, "", "a" * 700, "ab" * 300, passages[4], passages[4], passages[2] * 3, "é" * 120, "x" * 99]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 6)):
            passage = rng.choice(passages)
            cut = rng.randint(0, 30)
            parts += ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 60))), passage[cut:]]
        texts.append("".join(parts))
    rng.shuffle(texts)
    return list(enumerate(texts, start=-3))


@pytest.mark.parametrize("together", [512, 1])
def test_removal_equals_brute_force(make, rows, together, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(make(rows)).collect()}
    assert got == brute(rows, 100)


def test_short_windows_and_chunk_borders(make, rows, monkeypatch):
    monkeypatch.setattr(repeats, "PLACES", 64)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(make(rows), window=20).collect()}
    assert got == brute(rows, 20)


def test_kept_bytes_are_returned(make):
    text = "".join(chr(97 + i * i % 23) + str(i) for i in range(80))
    got = {r.doc_id: r.kept for r in remove_repeats(make([(1, text), (2, "new" + text)])).collect()}
    assert got == {1: None, 2: b"new"}


def test_repeated_ids_null_ids_and_empty_table(make):
    text = "".join(str(i) for i in range(100))
    got = sorted((r.doc_id or 0, r.n_removed) for r in remove_repeats(make([(1, text), (1, text), (None, text)])).collect())
    assert got == [(0, 0), (1, 0), (1, 0)]
    assert remove_repeats(make([])).collect() == []


def test_mergesort_sorts_suffixes_stably():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 2, 600).astype(np.uint8)
    starts = rng.permutation(500)
    group = np.sort(rng.integers(0, 7, 500))
    order = Suffixes(data, 40).sort(starts, group)
    content = lambda i: data[starts[i] : starts[i] + 40].tobytes()
    assert order.tolist() == sorted(range(500), key=lambda i: (group[i], content(i), i))


def test_extension_survives_equal_hashes(monkeypatch):
    monkeypatch.setattr(arrays, "prefix_hashes", lambda s: np.zeros(len(s) + 1, np.uint64))
    data = np.frombuffer(b"abcdabceabcd", np.uint8)
    assert Suffixes(data, 4).extension(np.array([0, 0]), np.array([4, 8])).tolist() == [3, 4]


def test_texts_that_weak_hashes_confuse_are_told_apart(make):
    """Thue-Morse sequences of bytes and their complements between equal passages."""
    morse = [bin(i).count("1") % 2 for i in range(4096)]
    rng = random.Random(3)
    around = ["".join(rng.choice("cdefgh") for _ in range(150)) for _ in range(2)]
    rows = [(k, around[0] + "".join("ab"[m ^ k] for m in morse) + around[1]) for k in (0, 1)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(make(rows)).collect()}
    assert got == brute(rows, 100)
