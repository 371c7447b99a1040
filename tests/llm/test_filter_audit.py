import re
from itertools import permutations

import duckdb
import pytest

from servicerank.llm.filter_audit import OUTCOMES, audit, packed, unpacked
from servicerank.llm.queries import ORACLE_SQL

SCHEMA = "doc_id long, text string, source string, mask int, part string, n long, _id string"
GOOD = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (1, GOOD, "a"), (2, GOOD, "b"), (3, GOOD, None), (4, None, "a"), (5, "", "a"), (6, "x " * 80, "b"), (7, "A" * 9, ""),
    (8, "50% of $", "b"), (9, GOOD + " | " + "X" * 99, "a"), (10, GOOD.upper(), "a"), (11, GOOD.upper(), "a"), (0, GOOD + " ", "c"),
    (None, GOOD, "a"), (None, GOOD, "a"), (1, GOOD, "a"), (12, "é" * 30_000 + " b" * 70, "c"), (13, "\x1f\xa0" * 60, "c"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, 0, 1), (8, 1, 0), (10, None, 1), (None, 1, 1), (99, 1, 1), (11, 1, None)]


def tables_of(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, s, 1, "p", 2, "z") for i, t, s in rows], SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def brute(rows, labels):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    seen = []
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t],
        }
        of = [x for x in labels if i is not None and x[0] == i]
        seen.append((s or "", fails, any(x[1] == 1 for x in of), any(x[2] == 1 for x in of)))
    out = {}
    for part in {s for s, *_ in seen}:
        mine = [x[1:] for x in seen if x[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = list(mine), []
            for step, letter in enumerate(order, 1):
                out_now = [x for x in left if x[0][letter]]
                shapley[letter] += len(out_now)
                left = [x for x in left if not x[0][letter]]
                out[part, "".join(order), step] = [
                    len(left), len(out_now), sum(x[0][letter] for x in gone),
                    sum(x[0][letter] and sum(x[0].values()) == 1 for x in mine),
                    sum(x[1] for x in out_now), sum(x[2] for x in out_now),
                ]
                gone += out_now
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("labels", [LABELS, []])
def test_counts_equal_brute_force(spark, labels):
    got = audit(*tables_of(spark, ROWS, labels)).collect()
    assert len(got) == 4 * 600
    assert {(r[0], r[1], r[2]): tuple(r)[3:] for r in got} == brute(ROWS, labels)


def test_hot_text_and_empty_table(spark):
    rows = [(i, GOOD, "ab"[i % 2]) for i in range(3000)]
    got = audit(*tables_of(spark, rows, LABELS)).filter("filter_order = 'EABCD' AND step = 1").orderBy("part").collect()
    assert [(r.part, r.kept, r.removed) for r in got] == [("a", 1, 1499), ("b", 0, 1500)]
    assert audit(*tables_of(spark, [], LABELS)).collect() == []


def test_packed_counters_do_not_overflow():
    huge = 2**62
    total = packed("ABCDE", 0, False, False) * huge + packed("ABCDE", 31, True, True) * (huge - 1) + packed("ABCDE", 4, False, True)
    counts = unpacked("ABCDE", total)
    first = dict(zip(OUTCOMES, counts[0, 0].tolist(), strict=True))
    assert first == {
        "kept": huge + 1, "removed": huge - 1, "redundant": 0, "unique_fails": 0, "good_lost": huge - 1, "toxic_lost": huge - 1
    }
    assert counts[:, :, OUTCOMES.index("kept")].min() == huge


def test_twin_on_odd_rows(spark, tmp_path):
    docs, labels = tables_of(spark, [r for r in ROWS if r[0] is not None], LABELS)
    docs.write.parquet(f"{tmp_path}/documents")
    labels.write.parquet(f"{tmp_path}/labels")
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    got = audit(docs, labels)
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op12_filter_audit']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
