"""From raw documents to token ids: quality, exact and near duplicates, benchmark leaks, encoding.

Each stage takes what its predecessor kept, and all but the last return the
columns of `documents`. No stage returns a null text's row as contaminated, near
or poor because it is null: it is an empty text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from servicerank.llm import quality
from servicerank.llm.bpe import encode_decode
from servicerank.llm.decontaminate import drop_contaminated
from servicerank.llm.exact_dedup import drop_exact
from servicerank.llm.ngram_join import drop_near
from servicerank.llm.queries import table, tokenizer_path
from servicerank.llm.shipping import ship
from servicerank.session import discard, discarding, new_work_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, doesn't reject."""
    ship(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the smallest id."""
    return drop_exact(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that n-gram links connect."""
    ship(spark)
    return drop_near(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and the digest of the text they decode to."""
    ship(spark)
    return encode_decode(docs, tokenizer_path(), ("n_tokens", "ids", "decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("ngram_jaccard_join", near_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("bpe_encoding", tokens_stage),
]

#: The first and the last stage can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`, each one's result stored before the next.

    A stage's work tables go once its result is stored, and a result once the
    next one is; the last stage reads the one that stays.
    """
    docs = table(spark, sf_dir, "documents")
    stored = None
    for name, stage in STAGES[:-1]:
        path = new_work_path(spark, name)
        with discarding(spark):
            if stored is not None:
                discard(stored)
            stage(spark, docs, sf_dir).write.parquet(path)
        docs, stored = spark.read.schema(docs.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
