"""Documents that hold benchmark items, exactly or nearly.

DataFrame operations only. Windows of an item's size get a SimHash of their
word shingles; windows within a Hamming radius of the item's are found by block
equality (with one block more than the radius, two fingerprints within it agree
in a block), and verified by the exact similarity of their shingle multisets.
Windows are made only where they can reach the similarity: in documents that
hold enough of the item's shingles, at shingles with enough others behind them.
Items with fewer words than a shingle are found by their words.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicerank.llm.exact_dedup import WHITE
from servicerank.llm.work import materialize

#: Hamming distance up to which fingerprints count as near. At a similarity of 0.8 a bit differs with
#: probability 0.15 (up to 0.19 in sets of five shingles), whatever repeats; README gives the misses measured.
RADIUS = 26
#: Item shingles up to which they are broadcast; a larger benchmark is joined by a shuffle. So are the documents' texts,
#: once more of them hold enough of an item.
BROADCAST_ROWS = 500_000


def shingles(text: Column, size: int) -> Column:
    """Hashes of the text's runs of `size` lower-case words; all its words if there are fewer, none without words."""
    return F.transform(
        # Binding the words once keeps them from being split again for each shingle.
        F.array(_words(text)),
        lambda w: F.when((F.size(w) > 0) & (F.size(w) < size), F.array(F.xxhash64(w))).otherwise(_word_runs(w, size)),
    )[0]


def _word_runs(words: Column, length: int) -> Column:
    """Hashes of the runs of `length` of the words."""
    return F.when(
        F.size(words) >= length,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (length - 1)), lambda i: F.xxhash64(*(F.element_at(words, i + k) for k in range(length)))
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _runs_of(length: int) -> Callable[[Column], Column]:
    return lambda words: _word_runs(words, length)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WHITE), "")


def _lanes(hash_: Column) -> list[Column]:
    """The hash's 64 bits as 16 numbers with four 16-bit lanes, so that sums count the ones of each bit."""
    out = []
    for j in range(16):
        nibble = F.shiftrightunsigned(hash_, 4 * j).bitwiseAND(F.lit(15))
        out.append(
            reduce(
                Column.bitwiseOR,
                (F.shiftleft(nibble.bitwiseAND(F.lit(1 << b)), 15 * b) for b in range(4)),
            )
        )
    return out


def _votes(counted: DataFrame, keys: list[str], times: str) -> DataFrame:
    """(keys, `vote`): a hash of each shingle and the number of its occurrence, so that one that repeats does not
    outweigh the others."""
    nth = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times).cast("bigint"))).alias("nth")
    return counted.select(*keys, "shingle", nth).select(*keys, F.xxhash64("shingle", "nth").alias("vote"))


def _fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, `length`, `print`) of the votes in column `vote`, grouped by the keys."""
    lanes = _lanes(F.col("vote"))
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("length"), *(F.sum(lane).alias(f"_{j}") for j, lane in enumerate(lanes))
    )
    halves = []
    for half in range(4):
        bits = []
        for bit in range(16 * half, 16 * half + 16):
            ones = F.shiftrightunsigned(F.col(f"_{bit // 4}"), 16 * (bit % 4)).bitwiseAND(F.lit(0xFFFF))
            bits.append(F.shiftleft((ones * 2 > F.col("length")).cast("bigint"), bit))
        halves.append(reduce(Column.bitwiseOR, bits))
    return sums.select(*keys, "length", reduce(Column.bitwiseOR, halves).alias("print"))


def _blocks(fingerprint: Column, radius: int) -> Column:
    """The fingerprint cut into radius + 1 blocks, as an array of (block, bits)."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"),
            )
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
        )
    )


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    size: int = 5,
    percent: int = 80,
    radius: int = RADIUS,
) -> DataFrame:
    """(id, item, `similarity`): documents with a window like an item, and the best window's similarity.

    A window has as many words as the item, or is the whole document if that is
    shorter. Its similarity is the weighted Jaccard similarity of the multisets
    of shingles (sum of the smaller counts over the sum of the larger ones). An
    item of fewer than `size` words has no shingle but itself, so it is found
    where a window's words are the same. Items or documents without words match
    nothing. Of rows that repeat an item each one's text is searched for, and the
    best similarity counts; of rows that repeat an id each one's text is
    searched. Rows without an id or item are dropped. Items may have 32,767
    words. Runs jobs when called.
    """
    rows = docs.select(
        F.struct(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text")).alias("doc"), F.col(text_column).alias("text")
    ).filter("doc.id IS NOT NULL")
    given = items.select(F.col(item_column).alias("item"), F.col(item_text_column).alias("text")).filter("item IS NOT NULL")
    given = given.withColumn("words", F.size(_words(F.col("text"))))
    listed = given.filter(F.col("words") >= size).select("item", shingles(F.col("text"), size).alias("s"))
    listed = listed.distinct().select(F.struct("item", F.xxhash64("s").alias("text")).alias("item"), "s")
    parts = materialize(listed.select("item", F.size("s").alias("m"), F.explode("s").alias("shingle")), "item-shingles")
    counted = parts.groupBy("item", "m", "shingle").agg(F.count(F.lit(1)).alias("in_item"))
    small = parts.count() <= BROADCAST_ROWS
    near: Callable[[DataFrame], DataFrame] = F.broadcast if small else (lambda df: df)

    # Shingles of documents that are also an item's; a window needs percent % of the item's.
    found = rows.select("doc", F.posexplode(shingles(F.col("text"), size)).alias("at", "shingle"))
    hits = found.join(near(counted.select("item", "m", "shingle")), "shingle")
    regions = (
        hits.groupBy("doc", "item", "m")
        .agg(F.sort_array(F.collect_set("at")).alias("places"))
        .filter(F.size("places") * 100 >= F.col("m") * percent)
    )
    per_doc = materialize(regions.groupBy("doc").agg(F.collect_list(F.struct("item", "m", "places")).alias("regions")), "item-regions")
    # Texts that hold nothing of an item are left out before any are shuffled, and few are left.
    held = rows
    if per_doc.count() <= BROADCAST_ROWS:
        key = F.xxhash64("doc").alias("_key")
        held = rows.select("*", key).join(F.broadcast(per_doc.select(key)), "_key", "left_semi").drop("_key")
    held = held.join(per_doc, "doc").dropDuplicates(["doc"]).select("doc", "regions", shingles(F.col("text"), size).alias("s"))
    held = materialize(held.select("doc", "s", F.explode("regions").alias("r")).select("doc", "s", "r.*"), "item-documents")

    # The best window begins with a shingle of the item's, or is the last one: moved up to its first such shingle it
    # loses none and may gain some. To be similar enough it must hold `need` of them.
    last = F.greatest(F.size("s") - F.col("m"), F.lit(0))
    need = F.ceil((F.least("m", F.size("s")) + F.col("m")) * F.lit(percent) / F.lit(100 + percent)).cast("int")
    dense = F.filter(
        "places", lambda p, i: (p <= last) & F.coalesce(F.get("places", i + need - 1) < p + F.col("m"), F.lit(False))
    )
    at_end = F.when(F.size(F.filter("places", lambda p: p >= last)) >= need, F.array(last)).otherwise(F.array().cast("array<int>"))
    starts = F.array_union(dense, at_end)
    windows = held.select("doc", "item", "m", "s", F.explode(starts).alias("start"))
    window = ["doc", "item", "m", "start"]
    in_window = (
        windows.select(*window, F.explode(F.slice("s", F.col("start") + 1, F.col("m"))).alias("shingle"))
        .groupBy(*window, "shingle")
        .agg(F.count(F.lit(1)).alias("in_window"))
    )
    in_window = materialize(in_window, "window-shingles")
    prints = materialize(_fingerprints(_votes(in_window, window, "in_window"), window), "window-prints")
    item_prints = _fingerprints(_votes(counted, ["item"], "in_item"), ["item"]).select("item", F.col("print").alias("item_print"))

    probes = prints.select("*", F.explode(_blocks(F.col("print"), radius)).alias("b")).select("*", "b.block", "b.bits").drop("b")
    index = item_prints.select("*", F.explode(_blocks(F.col("item_print"), radius)).alias("b")).select("*", "b.block", "b.bits").drop("b")
    candidates = (
        probes.join(near(index), ["item", "block", "bits"])
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select(*window)
        .distinct()
    )

    # The exact similarity of what is left.
    shared = (
        in_window.join(candidates, window)
        .join(near(counted.drop("m")), ["item", "shingle"], "left")
        .groupBy(*window)
        .agg(
            F.sum(F.least("in_window", F.coalesce("in_item", F.lit(0)))).alias("shared"),
            F.sum("in_window").alias("length"),
        )
        .withColumn("both", F.col("length") + F.col("m") - F.col("shared"))
        .filter(F.col("shared") * 100 >= F.col("both") * percent)
    )
    best = shared.select("doc.id", "item.item", (F.col("shared") / F.col("both")).alias("similarity"))
    short = _short(rows, given.filter(F.col("words") < size))
    return (
        (best if short is None else best.unionAll(short))
        .groupBy("id", "item")
        .agg(F.max("similarity").alias("similarity"))
        .select(F.col("id").alias(id_column), F.col("item").alias(item_column), "similarity")
    )


def _short(rows: DataFrame, items: DataFrame) -> DataFrame | None:
    """(id, item, `similarity`) of items of a few words, in the documents that hold these words in a row."""
    found = []
    for words in sorted(r.words for r in items.filter("words > 0").select("words").distinct().collect()):
        runs = F.transform(F.array(_words(F.col("text"))), _runs_of(words))[0]
        wanted = items.filter(F.col("words") == words).select("item", F.explode(runs).alias("run")).distinct()
        held = rows.select("doc.id", F.explode(runs).alias("run")).join(wanted, "run")
        found.append(held.select("id", "item", F.lit(1.0).alias("similarity")).distinct())
    return reduce(DataFrame.unionAll, found) if found else None


def report(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", **options: object) -> DataFrame:
    """One row per row of `docs`: the id, `contaminated`, `n_items`, `item_ids` (ascending, by commas), `similarity`.

    `similarity` is the best one, 0 for clean documents. Null and empty texts
    are clean; rows without an id are clean. Other columns are not looked at.
    """
    found = matches(docs, items, id_column, **options)
    item = found.columns[1]
    per_doc = found.groupBy(id_column).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_join(F.array_sort(F.collect_list(item)), ",").alias("item_ids"),
        F.max("similarity").alias("similarity"),
    )
    return docs.select(id_column).join(per_doc, id_column, "left").select(
        id_column,
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", F.lit("")).alias("item_ids"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", **options: object) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns."""
    return docs.join(matches(docs, items, id_column, **options).select(id_column).distinct(), id_column, "left_anti")
