import random
import re
import time
from collections import Counter

import pytest

from servicerank.llm import decontaminate
from servicerank.llm.decontaminate import drop_contaminated, report


def shingles(text, size=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    if len(words) < size:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def brute(rows, items):
    out = {}
    for i, text in rows:
        found = {}
        for item, item_text in items:
            s = shingles(item_text)
            # An item with fewer words than a shingle is one of its own size.
            doc = shingles(text, min(5, len(s[0]))) if s else []
            best = 0
            for start in range(max(len(doc) - len(s), 0) + 1) if s else ():
                window, wanted = Counter(doc[start : start + len(s)]), Counter(s)
                best = max(best, (window & wanted).total() / max(1, (window | wanted).total()))
            if best >= 0.8:
                found[item] = max(best, found.get(item, 0))
        out[i] = bool(found), len(found), ",".join(map(str, sorted(found))), max(found.values(), default=0.0)
    return out


@pytest.fixture
def tables_of(spark, make):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(60)]
    said = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [said(n) for n in (12, 15, 20, 40, 59)]
    items = list(enumerate([" ".join(t) for t in texts] + [None, "", "too few words", "na na na na na na na na"], start=1))
    items += [(3, " ".join(said(18))), (50, "one more"), (50, "na"), (50, "One more")]
    texts.append(items[-4][1].split())
    rows = [(200, "a b too FEW\nwords here c d"), (201, "one  more"), (202, "too few"), (203, "more one naa"), (204, "o one more na")]
    rows += [(100, None), (101, ""), (102, "Too FEW words"), (103, "na " * 50), (104, "v1 " * 40_000), (105, "\n".join(texts[3]))]
    for i in range(80):
        leak = rng.choice(texts)[:]
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            leak[rng.randrange(len(leak))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            leak.insert(rng.randrange(len(leak)), "extra")
        rows.append((i, " ".join(said(rng.randint(0, 40)) + leak[rng.choice([0, 0, 1, 4]) :] + said(rng.randint(0, 40)))))
    listed = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc string")
    return make(rows), listed, rows, items


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_report_equals_brute_force(tables_of, broadcast_rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast_rows)
    docs, items, rows, listed = tables_of
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_ids, r.similarity) for r in report(docs, items).collect()}
    assert got == brute(rows, listed)


def test_drop_keeps_clean_documents(tables_of):
    docs, items, rows, listed = tables_of
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, v in brute(rows, listed).items() if not v[0]}


def test_empty_tables_and_repeated_rows(tables_of, make):
    docs, items, _, listed = tables_of
    assert report(make([]), items).collect() == []
    assert not any(r.contaminated for r in report(docs, items.limit(0)).collect())
    text = listed[3][1]
    got = report(make([(1, text), (1, text), (None, text)]), items.unionAll(items)).collect()
    assert sorted((r.doc_id or 0, r.contaminated, r.n_items) for r in got) == [(0, False, 0), (1, True, 1), (1, True, 1)]


def test_main_path_runs_no_python(tables_of):
    docs, items, _, _ = tables_of
    plan = report(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_runs_of_equal_words_do_not_hide_leaks(spark, make):
    """Windows that share 178 of 200 shingles with the item, and repeat one of their own 18 times."""
    rng = random.Random(7)
    texts = [[f"v{rng.randrange(10**6)}" for _ in range(204)] for _ in range(12)]
    items = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows = [(i, " ".join(["before", *t[:182], *["--"] * 22, "after"])) for i, t in enumerate(texts)]
    listed = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_ids, r.similarity) for r in report(make(rows), listed).collect()}
    assert got == brute(rows, items)
    assert all(found for found, *_ in got.values())


def test_long_items_in_long_documents_take_seconds(spark, make):
    rng = random.Random(9)
    item = [f"v{rng.randrange(4000)}" for _ in range(1000)]
    text = [f"u{rng.randrange(9000)}" for _ in range(20_000)]
    for _ in range(120):
        at, piece = rng.randrange(len(text)), rng.randrange(900)
        text[at:at] = item[piece : piece + 100]
    leak = [*item[:400], "x", *item[400:]]
    listed = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    began = time.perf_counter()
    rows = [(1, " ".join(text + leak + text)), (2, " ".join(text * 2)), (3, " ".join(item[:70] * 30))]
    got = report(make(rows), listed).collect()
    assert {r.doc_id: r.contaminated for r in got} == {1: True, 2: False, 3: False}
    assert max(r.similarity for r in got) > 0.95
    assert time.perf_counter() - began < 60


def test_items_that_repeat_without_end(make, spark):
    rng = random.Random(4)
    item = [f"v{rng.randrange(50)}" for _ in range(60)]
    rows, items = [(1, " ".join(item * 30)), (2, " ".join(item[5:] * 2))], [(1, " ".join(item))]
    got = report(make(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: (r.contaminated, r.n_items, r.item_ids, r.similarity) for r in got} == brute(rows, items)


def test_texts_that_hold_nothing_are_not_shuffled(spark, tables_of, monkeypatch):
    """Also where Spark doesn't broadcast by itself."""
    docs, items, rows, listed = tables_of
    plans, store = {}, decontaminate.materialize

    def kept(df, label, **options):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, label, **options)

    monkeypatch.setattr(decontaminate, "materialize", kept)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = report(docs, items).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.doc_id: (r.contaminated, r.n_items, r.item_ids, r.similarity) for r in found} == brute(rows, listed)
    assert re.search(r"Join LeftSemi, .*rightHint=\(strategy=broadcast\)", plans["item-documents"])
