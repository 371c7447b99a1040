import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from servicerank.llm.exact_dedup import drop_exact, exact_groups

ROWS = [
    (1, "a b"), (2, "ab"), (3, " a\tb \n"), (4, None), (5, ""), (6, " \x0b\x0c"), (7, "a\xa0b"), (8, "ab" * 60_000), (9, "a b"),
    (10, "A b"), (-5, "\x0bab\x1f"),
]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    return sorted(
        (i, min(g)[1], len(g), i == min(g)[1], hashlib.sha256(k.encode()).hexdigest())
        for k, g in groups.items()
        for _, i in g
    )


def test_groups_equal_brute_force(make):
    assert sorted(map(tuple, exact_groups(make(ROWS)).collect())) == brute(ROWS)


def test_equal_digests_of_unequal_texts_are_told_apart(make):
    got = exact_groups(make(ROWS), digest=lambda c: F.lit("same"))
    assert sorted(map(tuple, got.collect())) == brute(ROWS)


def test_hot_group_is_one_group_for_any_salt(make):
    rows = [(i, "hot" + " " * (i % 7)) for i in range(3000)] + [(5000, "cold")]
    assert sorted(map(tuple, exact_groups(make(rows), salts=3).collect())) == brute(rows)


def test_repeated_rows_and_empty_table(make):
    got = exact_groups(make([(1, "a"), (1, "a"), (2, "a")])).orderBy("doc_id").collect()
    assert [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got] == [(1, 1, 3, True), (1, 1, 3, True), (2, 1, 3, False)]
    assert exact_groups(make([])).collect() == []


def test_drop_keeps_all_columns(make):
    docs = make(ROWS + [(1, "a b")])
    kept = drop_exact(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for i, k, *_ in brute(ROWS)}


def test_an_id_with_several_texts_stands_for_each(make):
    kept = drop_exact(make([(1, "aaa"), (2, "aaa"), (2, "bb"), (2, " b b"), (3, "c"), (3, "c"), (None, "d")]))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "aaa"), (2, " b b"), (3, "c")]


def test_rows_without_an_id_are_never_kept(make):
    got = exact_groups(make([(None, "a"), (None, "a "), (2, "a"), (None, "z")])).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in got) == [
        (0, 0, 1, False), (0, 2, 3, False), (0, 2, 3, False), (2, 2, 3, True)
    ]


def test_main_path_runs_no_python(make):
    plan = exact_groups(make(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
