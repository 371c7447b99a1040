import importlib
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from servicerank.llm.queries import ORACLE_SQL, QUERIES

entry = importlib.import_module("__spark_entry__")
SF = "/root/testdata/sf0.01"


def canonical(records, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(str(r[i]) for i in order) for r in records)


def test_queries_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert len([q for q in QUERIES if q.startswith("op")]) == 13


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_twin(spark, name):
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got, want = QUERIES[name](spark, SF), connection.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), columns)


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs
    removed = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        kept = stage(spark, kept, SF)
        assert kept.columns == columns
        removed[name] = before - {r.doc_id for r in kept.select("doc_id").collect()}
    assert all(removed.values())
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert len(removed["quality_classifier"] & good) <= 0.02 * len(good)
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert last.count() == kept.count() and last.filter(F.size("ids") != F.col("n_tokens")).isEmpty()


def test_run_on_texts_without_words(spark, make, tmp_path):
    docs = spark.createDataFrame(
        [(1, None, None, "s", 0), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x", "en", None, 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[0] == "doc_id"
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
