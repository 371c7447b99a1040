"""Exact duplicates of texts, grouped in stages that no single hot text can overload.

DataFrame operations only. Texts are equal when they are identical after every
character of `[\\x20\\x09-\\x0D]` is deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicerank.llm.work import materialize

WHITE = "[\\x20\\x09-\\x0D]+"


def squeezed(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = 16,
    digest: Callable[[Column], Column] = lambda content: F.sha2(content, 256),
) -> DataFrame:
    """One row per row of `docs`: the id, `keep_id`, `group_size`, `kept`, `text_sha256`.

    The row with the most code points in its original text stays, then the
    smallest id. Groups are formed by digest and full content: partial
    aggregates deduplicate within each task, one shuffle merges each digest's
    rows within `salts` parts, a second one combines the parts' winners. So a
    text that makes up a third of the table reaches a task as `salts` rows at
    most. Rows then find their group by the digest alone, which is safe where
    the content comparison has found one content for it; the rows of digests
    with several contents are grouped once more by content.

    Null texts are empty texts, and a group of their own with all texts of
    white space only. Repeated rows count as rows: each is returned, and each
    repeat of the row that stays is `kept`. A row without an id never stays while
    another one of its group has one, and is not `kept`; a group without any id
    has a null `keep_id`. Other columns are not looked at, whatever their names.
    An empty table gives an empty result. Runs two jobs when called.
    """
    spark = docs.sparkSession
    original = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("bigint").alias("_id"), original.alias("_text")).select(
        "_id", squeezed(F.col("_text")).alias("_content"), F.length("_text").alias("_length")
    ).withColumn("_digest", digest(F.col("_content")))

    groups = materialize(_winners(rows, salts).drop("_content"), "exact-groups")
    shared = groups.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_digest")

    placed = rows.select("_id", "_digest").join(groups, "_digest")
    result = placed.select("_id", "_keep", "_size", F.col("_digest"))
    if not shared.isEmpty():
        clean = result.join(shared, "_digest", "left_anti")
        doubtful = rows.join(shared, "_digest", "left_semi")
        apart = doubtful.select("_id", "_digest", "_content").join(
            _winners(doubtful, salts), ["_digest", "_content"]
        )
        result = clean.select("_id", "_keep", "_size", "_digest").unionAll(
            apart.select("_id", "_keep", "_size", "_digest")
        )
        texts = rows.select("_id", F.sha2("_content", 256).alias("_sha")).distinct()
        result = result.join(texts, "_id").drop("_digest").withColumnRenamed("_sha", "_digest")
    return result.select(
        F.col("_id").alias(id_column),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.coalesce(F.col("_id") == F.col("_keep"), F.lit(False)).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def _winners(rows: DataFrame, salts: int) -> DataFrame:
    """Digest, content, the id that stays and the number of rows, by way of salted groups."""
    # One number orders by length, then by smaller id; hash aggregation can hold it, unlike a struct.
    order = F.col("_length").cast("decimal(10,0)") * F.lit(Decimal(2**64)) - F.col("_id").cast("decimal(20,0)")
    salted = (
        rows.withColumn("_order", order)
        .withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int"))
        .groupBy("_digest", "_salt", "_content")
        .agg(
            F.max_by("_id", "_order").alias("_keep"),
            F.max("_order").alias("_order"),
            F.count(F.lit(1)).alias("_size"),
        )
    )
    return salted.groupBy("_digest", "_content").agg(
        F.max_by("_keep", "_order").alias("_keep"), F.sum("_size").alias("_size")
    )


def drop_exact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", salts: int = 16) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; of rows that repeat an id with equal texts one.

    An id with several different texts stands for each of them. Rows without an id go.
    """
    keep = exact_groups(docs, id_column, text_column, salts).filter("kept").select(
        F.col(id_column).alias("_kept_id"), F.col("text_sha256").alias("_kept_text")
    )
    original = F.coalesce(F.col(text_column), F.lit(""))
    named = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(id_column).alias("_id"), original.alias("_text")).select(
        "_row", "_id", F.sha2(squeezed(F.col("_text")), 256).alias("_sha"), F.length("_text").alias("_length")
    )
    # The longest of an id's equal texts; any row of those that are as long.
    longest = named.groupBy("_id", "_sha").agg(F.max("_length").alias("_most"))
    stay = keep.distinct().join(
        longest.withColumnsRenamed({"_id": "_kept_id", "_sha": "_kept_text"}), ["_kept_id", "_kept_text"]
    )
    # The length is no join key: id and text deal the rows out as dropDuplicates needs them.
    same = (F.col("_id") == F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_text")) & (F.col("_length") >= F.col("_most"))
    return named.join(stay, same, "left_semi").dropDuplicates(["_id", "_sha"]).select("_row.*")
