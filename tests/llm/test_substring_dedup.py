import hashlib
import random

import pytest

from servicerank.llm import substring_dedup
from servicerank.llm.substring_dedup import remove_repeated_words


def brute(rows, window):
    first, out = {}, {}
    for i, text in sorted(dict(rows).items()):
        words = (text or "").encode().split()
        gone = bytearray(len(words))
        for s in range(len(words) - window + 1):
            if first.setdefault(tuple(words[s : s + window]), i) < i:
                gone[s : s + window] = b"\1" * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = len(words), sum(gone), hashlib.sha256(kept).hexdigest()
    return out


@pytest.fixture
def rows():
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "B", "ç", "dd,", "e f", "g"]) + str(rng.randint(0, 3))
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 75, 260)]
    texts = [None, "", " \t\n", "w " * 200, "w " * 200, " ".join(passages[4]), "\n".join(passages[4]), "one"]
    for _ in range(70):
        parts = []
        for _ in range(rng.randint(1, 5)):
            passage = rng.choice(passages)
            parts += [word() for _ in range(rng.randint(0, 25))] + passage[rng.randint(0, 10) :]
        texts.append(rng.choice([" ", "  ", "\n"]).join(parts))
    rng.shuffle(texts)
    return list(enumerate(texts, start=-3))


@pytest.mark.parametrize("together, hits", [(512, 1 << 18), (512, 5), (1, 1 << 18)])
def test_removal_equals_brute_force(make, rows, together, hits, monkeypatch):
    monkeypatch.setattr(substring_dedup, "TOGETHER", together)
    monkeypatch.setattr(substring_dedup, "HITS", hits)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeated_words(make(rows)).collect()}
    assert got == brute(rows, 50)


def test_other_window(make, rows):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeated_words(make(rows), window=13).collect()}
    assert got == brute(rows, 13)


def test_repeats_within_a_document_stay(make):
    passage = " ".join(f"w{i}" for i in range(60))
    got = sorted((r.doc_id, r.n_removed, r.kept) for r in remove_repeated_words(make([(1, f"{passage} {passage}"), (2, f"x {passage} y")])).collect())
    assert got == [(1, 0, None), (2, 60, "x y")]


def test_repeated_ids_null_ids_and_empty_table(make):
    text = " ".join(map(str, range(100)))
    got = sorted((r.doc_id or 0, r.n_removed) for r in remove_repeated_words(make([(1, text), (1, text), (None, text)])).collect())
    assert got == [(0, 0), (1, 0), (1, 0)]
    assert remove_repeated_words(make([])).collect() == []


def test_sequences_that_weak_hashes_confuse_are_told_apart(make):
    """Thue-Morse sequences of words, and of letters in a word, with their complements."""
    morse = [bin(i).count("1") % 2 for i in range(2048)]
    pair = ("".join("ab"[m] for m in morse), "".join("ba"[m] for m in morse))
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(pair[0] if i == 30 else w for i, w in enumerate(words)), " ".join(pair[1] if i == 30 else w for i, w in enumerate(words))]
    for order in ((0, 1), (1, 0)):
        texts.append("start " * 60 + " ".join(("x", "y")[order[m]] for m in morse) + " end" * 60)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeated_words(make(rows)).collect()}
    assert got == brute(rows, 50)
    assert got[1][1] == 0
