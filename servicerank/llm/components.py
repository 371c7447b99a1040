"""Connected components of a table of links, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicerank.llm.work import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b): the smallest node it can reach.

    Each round gives a node the smallest of itself and its neighbours and
    contracts the links to the labels, dropping those within one label; labels
    and links are written out between rounds. A hub with many links is
    aggregated on the map side. Nulls and self-links are dropped.
    """
    links = links.select(F.greatest("a", "b").cast("bigint").alias("a"), F.least("a", "b").cast("bigint").alias("b"))
    links = materialize(links.dropna().filter("a != b").distinct(), "links")
    steps = []
    while not links.isEmpty():
        ends = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = ends.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"))
        step = materialize(step, "labels")
        steps.append(step)
        one = step.select(F.col("node").alias("a"), F.col("label").alias("one"))
        two = step.select(F.col("node").alias("b"), F.col("label").alias("two"))
        links = links.join(one, "a").join(two, "b").filter("one != two")
        links = materialize(links.select(F.greatest("one", "two").alias("a"), F.least("one", "two").alias("b")).distinct(), "links")
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps[0].withColumnRenamed("label", "component")
    for step in steps[1:]:
        onward = step.select(F.col("node").alias("component"), F.col("label").alias("onward"))
        found = found.join(onward, "component", "left").select("node", F.coalesce("onward", "component").alias("component"))
    return found
