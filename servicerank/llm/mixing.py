"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target of words. What it holds is taken in complete epochs
first; the rest is a weighted sample without replacement: a document's key is an
exponential number divided by the document's weight, and the documents with the
smallest keys are taken until their sizes add up to the rest.

No task sorts a whole source. Keys fall into as many ordered buckets as the
square root of the source's number of documents; sizes are added up per bucket
(partial sums first), and only the bucket in which the budget runs out is
sorted, so both steps of the prefix sum see about that many rows of a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servicerank.llm.work import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
SHARES = (5, 2, 1)


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def exponential(identity: Column, seed: int) -> Column:
    """An exponential number that depends on the id and the seed alone; never zero or infinite."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("null")))
    drawn = F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("bigint")
    return -F.log((drawn + F.lit(0.5)) / F.lit(float(1 << 52)))


def targets(
    rows: DataFrame, shares: Sequence[float] = SHARES, total: float = 1.5, most: int = 2
) -> DataFrame:
    """One row per source of (`_source`, `_size`): how many words to take of it.

    Sources in the order of their code points, null last, weigh `shares` in turn
    and share `total` times all words. A target stops at `most` times what the
    source holds; what is left over goes to the others by weight until none is
    above. In the order of capacity over weight the sources that stop come
    first, so the level that the others share is the largest of the levels that
    remain after each of them; no iteration is needed. Holds one row per source,
    which one task orders.
    """
    sources = rows.groupBy("_source").agg(F.sum("_size").alias("_held"), F.count(F.lit(1)).alias("_docs"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("_source"))) - 1
    share = F.element_at(F.array(*map(F.lit, map(float, shares))), (place % len(shares) + 1).cast("int"))
    weighed = sources.withColumn("_share", share)
    order = Window.orderBy((F.col("_held") / F.col("_share")).asc(), F.asc_nulls_last("_source"))
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(total) * F.sum("_held").over(everything) - most * F.coalesce(F.sum("_held").over(before), F.lit(0))
    levels = weighed.withColumn("_level", left / F.sum("_share").over(onward))
    capacity = (most * F.col("_held")).cast("double")
    target = F.least(capacity, F.col("_share") * F.max("_level").over(everything))
    epochs = F.coalesce(F.floor(target / F.nullif(F.col("_held"), F.lit(0))), F.lit(0)).cast("bigint")
    return (
        levels.withColumn("_target", target)
        .withColumn("_epochs", epochs)
        .withColumn("_budget", F.col("_target") - F.col("_epochs") * F.col("_held"))
        .withColumn("_buckets", F.ceil(F.sqrt("_docs")).cast("bigint"))
        .select("_source", "_held", "_target", "_epochs", "_budget", "_buckets")
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    shares: Sequence[float] = SHARES,
    total: float = 1.5,
    most: int = 2,
    seed: int = 11,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """One row per row of `docs`: id, source, `size`, `source_size`, `target`, `copies`, `taken`.

    `size` counts the words of the whole text, `target` is the source's, `copies`
    says how often the mix takes the document, and `taken` is `copies * size`.
    `weights` has (id, `weight`), positive numbers; documents that it lacks, or
    gives null, zero or less, weigh 1, and of several rows of an id the largest
    weight counts. The document at which a source's budget runs out is taken if
    that comes nearer to the target than leaving it out.

    Draws depend on ids and `seed` only, so reruns agree, whatever the partitions.
    Null texts are empty, a document without words is taken as none; a null
    source is a source of its own, the last; a null id draws like any other id.
    Repeated rows are drawn with the same key, one after the other. Other columns
    are not looked at, whatever their names. An empty table gives an empty
    result. Stores a narrow table (id, source, size, key) and one row per source
    when called.
    """
    rows = docs.select(
        F.col(id_column).alias("_id"), F.col(source_column).alias("_source"), n_words(F.col(text_column)).alias("_size")
    )
    weight = F.lit(1.0)
    if weights is not None:
        known = weights.select(F.col(id_column).alias("_known"), F.col("weight").cast("double").alias("_weight"))
        known = known.filter("_known IS NOT NULL AND _weight > 0").groupBy("_known").agg(F.max("_weight").alias("_weight"))
        rows = rows.join(known, F.col("_id") == F.col("_known"), "left")
        weight = F.coalesce("_weight", F.lit(1.0))
    key = exponential(F.col("_id"), seed) / weight
    drawn = materialize(rows.select("_id", "_source", "_size", key.alias("_key")), "mix-keys")
    plan = materialize(targets(drawn, shares, total, most).coalesce(1), "mix-targets")

    # 1 - exp(-key) spreads keys over (0, 1) and keeps their order.
    bucket = F.least(F.floor((1 - F.exp(-F.col("_key"))) * F.col("_buckets")), F.col("_buckets") - 1)
    planned = plan.withColumnRenamed("_source", "_of")
    placed = drawn.join(planned, F.col("_source").eqNullSafe(F.col("_of"))).withColumn("_bucket", bucket)
    sums = placed.groupBy("_of", "_bucket", "_budget").agg(F.sum("_size").alias("_sum"))
    so_far = F.sum("_sum").over(Window.partitionBy("_of").orderBy("_bucket"))
    # The first bucket in which the budget is reached, and what the ones before it hold.
    last = (
        sums.withColumn("_so_far", so_far)
        .filter(F.col("_so_far") >= F.col("_budget"))
        .groupBy(F.col("_of").alias("_at"))
        .agg(F.min("_bucket").alias("_last"), F.min_by(F.col("_so_far") - F.col("_sum"), "_bucket").alias("_before"))
    )
    cut = placed.join(last, F.col("_source").eqNullSafe(F.col("_at")), "left")
    kept = ["_id", "_source", "_size", "_held", "_target", "_epochs"]
    # A budget that rounding puts above all buckets takes them all.
    whole = cut.filter("_last IS NULL OR _bucket <> _last").select(
        *kept, F.when(F.col("_bucket") < F.coalesce("_last", F.col("_buckets")), 1).otherwise(0).alias("_drawn")
    )
    order = Window.partitionBy("_source").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.col("_before") + F.sum("_size").over(order)
    sorted_part = cut.filter("_bucket = _last").withColumn("_reached", reached)
    over, short = F.col("_reached") - F.col("_budget"), F.col("_budget") - (F.col("_reached") - F.col("_size"))
    split = sorted_part.select(*kept, F.when((over <= 0) | ((short > 0) & (over < short)), 1).otherwise(0).alias("_drawn"))
    copies = F.when(F.col("_size") > 0, F.col("_epochs") + F.col("_drawn")).otherwise(0).cast("bigint")
    return whole.unionAll(split).select(
        F.col("_id").alias(id_column),
        F.col("_source").alias(source_column),
        F.col("_size").alias("size"),
        F.col("_held").alias("source_size"),
        F.col("_target").alias("target"),
        copies.alias("copies"),
        (copies * F.col("_size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken. Ids must be unique."""
    taken = mix(docs, id_column=id_column, **options).filter("copies > 0")
    copies = taken.select(F.col(id_column).alias("_taken"), F.sequence(F.lit(1).cast("bigint"), "copies").alias("_copies"))
    joined = docs.join(copies, docs[id_column] == F.col("_taken"))
    return joined.select(*docs.columns, F.explode("_copies").alias("_copy")).drop("_copy")
