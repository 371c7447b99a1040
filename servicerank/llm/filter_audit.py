"""How filters interact: what each removes at every step of every order.

A row is described by its mask: which of the filters it fails. Every mask (with
the row's labels) is mapped to one big integer, a row of packed counters with a
field for each outcome at each step of each order; the integers are added up per
part of the table, and the sums unpacked. A field has 64 bits and no count of
rows reaches 2**63, so nothing flows from one field into the next.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = "[^\\x20\\x09-\\x0D]+"
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Bytes of a counter.
FIELD = 8


@lru_cache(maxsize=4)
def orders(letters: str) -> list[str]:
    return ["".join(p) for p in permutations(letters)]


@lru_cache(maxsize=4096)
def packed(letters: str, mask: int, good: bool, toxic: bool) -> int:
    """What one row of that kind adds to the counters, outcome by outcome, step by step, order by order."""
    fields = np.zeros((len(orders(letters)), len(letters), len(OUTCOMES)), "<u8")
    for i, order in enumerate(orders(letters)):
        gone = False
        for step, letter in enumerate(order):
            bit = 1 << letters.index(letter)
            fails = bool(mask & bit)
            removed = fails and not gone
            fields[i, step] = (
                not (gone or fails), removed, fails and gone, mask == bit, removed and good, removed and toxic
            )
            gone = gone or fails
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(letters: str, total: int) -> np.ndarray:
    """The counters of a sum, by order, step and outcome."""
    shape = (len(orders(letters)), len(letters), len(OUTCOMES))
    return np.frombuffer(total.to_bytes(int(np.prod(shape)) * FIELD, "little"), "<u8").reshape(shape).astype(np.int64)


def text_failures(text: Column) -> list[Column]:
    """A: few words, B: few distinct words, C: many capitals, D: symbols. Give text that is not null."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n, distinct, length = (c.cast("bigint") for c in (F.size(words), F.size(F.array_distinct(words)), F.length(text)))
    capitals = length - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        n < 50,
        100 * distinct < 65 * n,
        100 * capitals > 5 * length,
        text.rlike("[#$%&*|]"),
    ]


def count_kinds(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "source",
) -> DataFrame:
    """Rows of each kind: `part`, `mask`, `good`, `toxic`, `n`.

    The text's own failures are bits 0 to 3; bit 4 says that the text is that of
    a smaller id, too. Equal texts fail alike, so rows are counted per text (its
    SHA-256), part and labels in partial sums before they are shuffled: a text
    that makes up a third of the table is a few rows for each task. Of a text,
    only the rows of its smallest id, and rows without id, don't fail.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(text_failures(F.col("_text")))), F.lit(0))
    rows = (
        docs.select(
            F.col(id_column).alias("_id"),
            F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
            text.alias("_text"),
        )
        .select("_id", "part", F.unhex(F.sha2("_text", 256)).alias("_digest"), mask.cast("int").alias("mask"))
    )
    known = (
        labels.filter(F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("_known"))
        .agg(F.max(F.col("quality") == 1).alias("_good"), F.max(F.col("toxic") == 1).alias("_toxic"))
    )
    flags = [F.coalesce(f, F.lit(False)).alias(f) for f in ("_good", "_toxic")]
    kind = ["_digest", "mask", "part", "_good", "_toxic"]
    joined = rows.join(known, F.col("_id") == F.col("_known"), "left").select("_id", "_digest", "mask", "part", *flags)
    per_id = joined.groupBy("_id", *kind).agg(F.count(F.lit(1)).alias("_rows"))
    per_kind = per_id.groupBy(*kind).agg(
        F.sum("_rows").alias("_n"),
        F.min("_id").alias("_first"),
        F.sum(F.when(F.col("_id").isNull(), F.col("_rows")).otherwise(0)).alias("_no_id"),
        F.min_by(F.when(F.col("_id").isNotNull(), F.col("_rows")), "_id").alias("_of_first"),
    )
    first = F.min("_first").over(Window.partitionBy("_digest"))
    spared = F.col("_no_id") + F.when(F.col("_first") == first, F.col("_of_first")).otherwise(0)
    parted = per_kind.withColumn("_spared", spared).select(
        "part",
        F.col("_good").alias("good"),
        F.col("_toxic").alias("toxic"),
        F.explode(F.array(
            F.struct("mask", F.col("_spared").alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("_n") - F.col("_spared")).alias("n")),
        )).alias("_of"),
    )
    return (
        parted.select("part", "good", "toxic", "_of.mask", "_of.n")
        .filter("n > 0")
        .groupBy("part", "mask", "good", "toxic")
        .agg(F.sum("n").alias("n"))
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "source",
) -> DataFrame:
    """Every part, order of the filters and step: `kept`, `removed`, `redundant`, `unique_fails`, `good_lost`,
    `toxic_lost`, `shapley`.

    Filters: A, fewer than 50 words; B, fewer than 65 distinct words in 100;
    C, more than 5 capitals A-Z in 100 code points; D, one of #$%&*|; E, the text
    of a row with a smaller id. A part is a value of `part_column`, null being
    the empty string. `labels` has (id, `quality`, `toxic`); a row whose id it
    lacks is neither good nor toxic, of an id's several rows any may say so.

    Null texts are empty. Rows without an id never fail E, and have no label.
    Repeated rows count as rows; repeats of the smallest id of a text don't fail
    E. Other columns are not looked at, whatever their names. An empty table
    gives an empty result; without labels nothing good or toxic is lost. The
    integers of a part are added up in one task from at most 128 rows, one for
    each mask and pair of labels.
    """
    letters = "ABCDE"

    def add_up(key: tuple, kinds: pd.DataFrame) -> pd.DataFrame:
        total = 0
        for mask, good, toxic, n in kinds[["mask", "good", "toxic", "n"]].itertuples(index=False):
            total += packed(letters, int(mask), bool(good), bool(toxic)) * int(n)
        counts = unpacked(letters, total)
        removed = counts[:, :, OUTCOMES.index("removed")]
        steps = np.array([[letters.index(c) for c in order] for order in orders(letters)])
        shapley = np.array([removed[steps == i].sum() for i in range(len(letters))])
        table = pd.DataFrame(counts.reshape(-1, len(OUTCOMES)), columns=list(OUTCOMES))
        table.insert(0, "part", key[0])
        table.insert(1, "filter_order", np.repeat(orders(letters), len(letters)))
        table.insert(2, "step", np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(orders(letters))))
        table["shapley"] = shapley[steps.reshape(-1)]
        return table

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in (*OUTCOMES, "shapley"))
    kinds = count_kinds(docs, labels, id_column, text_column, part_column)
    return kinds.groupBy("part").applyInPandas(add_up, schema)
