"""Every registered query against its DuckDB twin, on the smallest tables."""

import importlib
from pathlib import Path

import duckdb
import pytest

from servicerank.plans.catalog import QUERIES
from servicerank.plans.oracle import ORACLE_SQL

entry_module = importlib.import_module("__spark_entry__")
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for file in Path(tables).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(records, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(str(r[i]) for i in order) for r in records))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE_SQL) <= set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_twin(spark, duck, tables, name):
    got = QUERIES[name](spark, tables)
    want = duck.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), columns)


def test_entry_is_ranked(spark):
    scores = [r.performance_score for r in entry_module.entry(spark).collect()]
    assert scores and scores == sorted(scores, reverse=True)


def test_fact_from_text_equals_fact_from_numbers(spark, tables):
    from servicerank.plans import bindings

    a, b = bindings.queue_from_lake(spark, tables), bindings.queue(spark, tables)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
