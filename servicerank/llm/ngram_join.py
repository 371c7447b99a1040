"""Join of texts whose sets of word shingles are nearly equal (Jaccard similarity).

A text's shingles are hashed into groups; the counts per group make the text a
point. Two sets share at most the sum of the coordinates' minima, so a box of
points can be passed over when that bound, taken at the box's upper corner, is
too small. Boxes are the leaves of a tree packed by size below each rare
shingle, since texts that link share one of their rarest. In a leaf a text has
a bit for each of many more groups: whether it holds an odd number of the
group's shingles. Where the bits of two texts differ, only one of them holds
some shingle. What the bounds let through is verified on the shingles
themselves.

A point has about as many coordinates for each shingle whatever the size of the
set, since counts that are large everywhere have large minima and rule nothing
out. Groups of a coarse point are unions of those of a finer one, so points of
different sizes are compared by adding up neighbouring coordinates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servicerank.llm import arrays
from servicerank.llm.components import components
from servicerank.llm.work import materialize, settle

#: Shingles for each coordinate of a point, at most, and coordinates at least and at most.
PER_GROUP, FEWEST_GROUPS, MOST_GROUPS = 6, 128, 1 << 16
#: Groups whose counts order shingles from rare to common.
RARITY_BITS = 16
#: Bits in a leaf for each shingle at least, and for a text at least and at most. Chance hides about D * D / (2 * bits)
#: pairs of the D shingles that only one text holds, so only texts a few hundredths short of linking are let through.
BITS, FEWEST_BITS, MOST_BITS = 1, 1 << 9, 1 << 15
#: Largest coordinate of a point; the bounds add what a set holds beyond it.
MOST = 255
#: Points in a leaf of the tree, fewer if its sets are large; pairs of points that are laid out at a time, and leaves.
LEAF, SMALL_LEAF, LEAF_SHINGLES = 64, 4, 1 << 15
PAIRS, LEAVES = 1 << 20, 256
#: Shingle groups this many times as full as the mean may hold a hot shingle, which is looked up by partial aggregates.
HOT, SALTS = 4, 64
#: Texts below one shingle from which two of them, not one, are compared with all first.
CROWD = 3
#: Shingles whose columns are laid out at a time when the overlaps of two blocks of sets are counted.
COLUMNS = 1 << 13


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and where each set begins.

    A-Z count as a-z. A text with fewer words than `size` has its whole
    sequence as one shingle; one without words has none.
    """
    texts = len(offsets) - 1
    starts, ends, owner = arrays.words(data, offsets)
    hashes = arrays.word_hashes(data, starts, ends, lower=True)
    prefix = arrays.prefix_hashes(hashes)
    found = arrays.window_hashes(prefix, size)
    whole = owner[size - 1 :] == owner[: len(found)] if len(found) else np.empty(0, bool)
    counts = np.bincount(owner, minlength=texts)
    first = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    few = arrays.span_hashes(prefix, first[short], first[short] + counts[short]) + counts[short].astype(np.uint64)
    of = np.concatenate([owner[: len(found)][whole], short])
    all_hashes = np.concatenate([found[whole], few])
    order = np.lexsort((all_hashes, of))
    of, all_hashes = of[order], all_hashes[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (all_hashes[1:] != all_hashes[:-1])
    of, all_hashes = of[new], all_hashes[new]
    return all_hashes, np.searchsorted(of, np.arange(texts + 1))


def _needed(total: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of two sets with `total` members together that reach the similarity."""
    return -(-percent * total // (100 + percent))


def _sets(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches (id, text) with the shingle sets of their texts."""
    for batch in batches:
        data, offsets = arrays.utf8(batch.column(1))
        for first, last in arrays.chunks(offsets):
            part = data[offsets[first] : offsets[last]]
            yield batch.slice(first, last - first), *shingle_sets(part, offsets[first : last + 1] - offsets[first], size)


class ShingleJoin:
    """The join of one table of texts with itself."""

    def __init__(
        self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, percent: int = 80
    ) -> None:
        self.size, self.percent = size, percent
        self.docs = docs.select(F.col(id_column).cast("bigint").alias("doc"), F.col(text_column).alias("text"))
        self.id_column = id_column

    def rarity(self) -> np.ndarray:
        """How many shingles of all texts fall into each of 2**RARITY_BITS groups.

        An order only: it decides which shingles are looked up, not which texts
        link. Its size does not depend on the data.
        """
        size = self.size

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counted = np.zeros(1 << RARITY_BITS, np.int64)
            for _, hashes, _ in _sets(batches, size):
                counted += np.bincount((hashes >> np.uint64(64 - RARITY_BITS)).astype(np.int64), minlength=len(counted))
            parts = counted.reshape(64, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(64)), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"]
            )

        def add(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(b, np.int64) for b in table["counts"].to_pylist())
            return pa.table({"part": table["part"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

        schema = "part long, counts binary"
        parts = self.docs.mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
        out = np.zeros((64, (1 << RARITY_BITS) // 64), np.int64)
        for part in parts:
            out[part.part] = np.frombuffer(part.counts, np.int64)
        return out.ravel()

    def points(self) -> DataFrame:
        """(doc, n, digest, node, point, odd): set size, digest of the set, its short form, the counts per group, and
        the bits that tell odd groups."""
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, hashes, begins in _sets(batches, size):
                texts = batch.num_rows
                sizes = np.diff(begins)
                of = np.repeat(np.arange(texts), sizes)
                points, odd = _points(hashes, of, sizes)
                digests = [_digest(hashes[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes),
                        pa.array(digests, pa.binary()),
                        pa.array(np.frombuffer(b"".join(d[:8] for d in digests), np.int64)),
                        points,
                        odd,
                    ],
                    ["doc", "n", "digest", "node", "point", "odd"],
                )

        return self.docs.mapInArrow(run, "doc long, n long, digest binary, node long, point binary, odd binary")

    def signatures(self, rarity: np.ndarray) -> DataFrame:
        """(shingle, node, salt): the rarest shingles of each set, so many that linked sets share one.

        The salt is 0 for a shingle that isn't hot, which stands in at most HOT
        times as many texts as a group of shingles has members on average.
        """
        size, percent = self.size, self.percent
        limit = HOT * rarity.mean()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, hashes, begins in _sets(batches, size):
                sizes = np.diff(begins)
                of = np.repeat(np.arange(len(sizes)), sizes)
                nodes = np.frombuffer(
                    b"".join(_digest(hashes[a:b])[:8] for a, b in zip(begins[:-1], begins[1:], strict=True)), np.int64
                )
                order = np.lexsort((hashes, rarity[(hashes >> np.uint64(64 - RARITY_BITS)).astype(np.int64)], of))
                # Of n shingles a partner holds percent % at least, so it can't miss one more than the rest.
                kept = sizes + 1 + (-percent * sizes // 100)
                place = np.arange(len(hashes)) - begins[:-1][of]
                rare = order[place < kept[of]]
                hot = rarity[(hashes[rare] >> np.uint64(64 - RARITY_BITS)).astype(np.int64)] > limit
                node = nodes[of[rare]]
                salt = np.where(hot, 1 + node % SALTS, 0).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[rare].view(np.int64)), pa.array(node), pa.array(salt)], ["shingle", "node", "salt"]
                )

        return self.docs.mapInArrow(run, "shingle long, node long, salt int")

    def links(self, points: DataFrame) -> DataFrame:
        """(a, b, shared): pairs of classes, by smallest document, that link; enough of them to connect all that do."""
        return self._connecting(points)[0]

    def _connecting(self, points: DataFrame) -> tuple[DataFrame, DataFrame]:
        """`links`, and (doc, text) of all documents in them."""
        spark = self.docs.sparkSession
        links = settle(spark, "shingle-links", lambda: self._found(points))
        linked = links.select(F.col("a").alias("doc")).unionAll(links.select(F.col("b").alias("doc"))).distinct()
        return links, materialize(self.docs.join(linked, "doc"), "shingle-texts", compression="zstd")

    def _found(self, points: DataFrame) -> DataFrame:
        """`links`, by work tables that the caller removes."""
        members = settle(self.docs.sparkSession, "shingle-members", lambda: self._members(self.signatures(self.rarity())))
        # One point for each set; the document with the smallest id stands for its copies.
        classes = materialize(
            points.filter("n > 0")
            .groupBy("digest", "node")
            .agg(F.min("doc").alias("doc"), *(F.first(c).alias(c) for c in ("n", "point", "odd")))
            .drop("digest"),
            "shingle-classes",
        )
        star = materialize(self._bounded(_star(members), classes, "node"), "shingle-star")

        crowded = members.filter("k > 2")
        wanted = star.select(F.col("a").alias("doc")).unionAll(star.select(F.col("b").alias("doc")))
        in_crowds = crowded.select("node").distinct().join(classes.select("node", "doc"), "node").select("doc")
        wanted = wanted.unionAll(in_crowds).distinct()
        texts = materialize(self.docs.join(wanted, "doc"), "shingle-texts", compression="zstd")

        first = materialize(self._verified(star, texts), "shingle-links")
        joined = components(first.select("a", "b"))
        second = self._tree(crowded, classes, joined)
        second = second.join(star.select("a", "b"), ["a", "b"], "left_anti")
        second = materialize(self._bounded(second, classes, "doc"), "shingle-pairs")
        return first.unionAll(self._verified(second, texts))

    @staticmethod
    def _members(rare: DataFrame) -> DataFrame:
        """(shingle, node, k) of the shingles that k > 1 nodes share.

        Hot shingles are spread over salts in the one large shuffle; what is
        left after it is small, and there they are counted by partial aggregates.
        """
        below = Window.partitionBy("shingle", "salt")
        kept = (
            rare.select("shingle", "node", "salt", F.min("node").over(below).alias("low"), F.max("node").over(below).alias("high"), F.count("node").over(below).alias("k"))
            .filter("salt > 0 OR low != high")
            .select("shingle", "node", (F.col("salt") > 0).alias("hot"), "k")
            .distinct()
        )
        kept = materialize(kept, "shingle-kept")
        hot = kept.filter("hot").select("shingle", "node").distinct()
        counted = hot.groupBy("shingle").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
        return kept.filter("NOT hot").select("shingle", "node", "k").unionAll(hot.join(counted, "shingle"))

    def _bounded(self, pairs: DataFrame, classes: DataFrame, key: str) -> DataFrame:
        """Of pairs of nodes or documents, the documents of those whose sizes and then points allow the similarity."""
        percent = self.percent

        def of(side: str, to: str, *columns: str) -> DataFrame:
            return classes.select(F.col(key).alias(to), *(F.col(c).alias(f"{side}_{c}") for c in columns))

        names = ["class", "n"]
        classes = classes.withColumn("class", F.col("doc"))
        sized = pairs.join(of("a", "a", *names), "a").join(of("b", "b", *names), "b").filter(
            (F.col("a_n") * 100 >= F.col("b_n") * percent) & (F.col("b_n") * 100 >= F.col("a_n") * percent)
        )
        sized = sized.withColumnsRenamed({"a": "left", "b": "right"})
        sized = sized.join(of("a", "left", "point"), "left").join(of("b", "right", "point"), "right")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                a, b, a_n, b_n = (np.asarray(batch.column(i)) for i in range(4))
                one, two = PointTable(batch.column(4), a_n), PointTable(batch.column(5), b_n)
                rows = np.arange(len(a))
                fits = (bounds(one, rows, two, rows) >= _needed(a_n + b_n, percent)) & (a != b)
                a, b = np.maximum(a, b)[fits], np.minimum(a, b)[fits]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        columns = ["a_class", "b_class", "a_n", "b_n", "a_point", "b_point"]
        return sized.select(columns).mapInArrow(run, "a long, b long").distinct()

    def _tree(self, crowded: DataFrame, classes: DataFrame, joined: DataFrame) -> DataFrame:
        """Pairs below one shingle that aren't connected yet and that the bits of the leaves let through."""
        percent = self.percent
        at = (
            crowded.select("shingle", "node", "k")
            .join(classes, "node")
            .join(joined.withColumnRenamed("node", "doc"), "doc", "left")
            .withColumn("component", F.coalesce("component", "doc"))
        )
        apart = at.groupBy("shingle").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).filter("_low != _high")
        at = at.join(apart.select("shingle"), "shingle")
        # Leaves hold sets of nearly one size, spread by hash where there are many.
        grade = F.floor(F.log("n") / F.log(F.lit(1.1))).cast("int")
        held = F.least(F.lit(LEAF), F.greatest(F.lit(SMALL_LEAF), F.floor(F.lit(LEAF_SHINGLES) / F.col("n"))))
        leaves = (
            at.withColumn("grade", grade)
            .withColumn("salt", F.pmod(F.xxhash64("doc"), F.ceil(F.col("k") / held)))
            .groupBy("shingle", "grade", "salt")
            .agg(
                F.min("n").alias("low"),
                F.max("n").alias("high"),
                F.min("component").alias("c_low"),
                F.max("component").alias("c_high"),
                F.collect_list(F.struct("doc", "n", "component", "odd")).alias("points"),
            )
            .withColumn("leaf", F.struct("grade", "salt"))
        )
        # The bits of a text stand in many leaves, which packs well if those of a component lie together.
        leaves = materialize(leaves.sortWithinPartitions("c_low", "c_high"), "shingle-leaves", compression="zstd")
        one = leaves.select("shingle", *(F.col(c).alias(f"{c}_1") for c in ("low", "high", "c_low", "c_high", "leaf", "points")))
        two = leaves.select("shingle", *(F.col(c).alias(f"{c}_2") for c in ("low", "high", "c_low", "c_high", "leaf", "points")))
        boxes = one.join(two, "shingle").filter(
            (F.col("leaf_1") <= F.col("leaf_2"))
            & (F.col("low_1") * percent <= F.col("high_2") * 100)
            & (F.col("low_2") * percent <= F.col("high_1") * 100)
            & ~((F.col("c_low_1") == F.col("c_high_1")) & (F.col("c_low_2") == F.col("c_high_2")) & (F.col("c_low_1") == F.col("c_low_2")))
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, LEAVES):
                    part = batch.slice(at, LEAVES)
                    a, b = leaf_pairs(Leaves(part.column(0)), Leaves(part.column(1)), percent)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        return boxes.select("points_1", "points_2").mapInArrow(run, "a long, b long").distinct()

    def _verified(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The pairs that reach the similarity, with the number of shingles shared."""
        size, percent = self.size, self.percent
        pairs = pairs.withColumnsRenamed({"a": "one", "b": "two"})
        rows = pairs.join(texts.select(F.col("doc").alias("one"), F.col("text").alias("a_text")), "one").join(
            texts.select(F.col("doc").alias("two"), F.col("text").alias("b_text")), "two"
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    part = batch.slice(at, 64)
                    sets = []
                    for column in (2, 3):
                        hashes, begins = shingle_sets(*arrays.utf8(part.column(column)), size)
                        sets.append([hashes[i:j] for i, j in zip(begins[:-1], begins[1:], strict=True)])
                    shared = np.array([len(np.intersect1d(x, y, True)) for x, y in zip(*sets, strict=True)])
                    both = np.array([len(x) + len(y) for x, y in zip(*sets, strict=True)])
                    links = 100 * shared >= percent * (both - shared)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).filter(pa.array(links)), part.column(1).filter(pa.array(links)), pa.array(shared[links])],
                        ["a", "b", "shared"],
                    )

        return rows.select("one", "two", "a_text", "b_text").mapInArrow(run, "a long, b long, shared long")

    def _near(self, classes: DataFrame, linked: DataFrame, texts: DataFrame) -> DataFrame:
        """(digest, n_near): how many rows of other classes each class links with.

        All links lie within components, so there every two sets whose sizes
        allow it are compared, in blocks of about LEAF sets of nearly one size.
        A pair of blocks gives a partial sum for each class; copies only weigh.
        """
        size, percent = self.size, self.percent
        at = classes.join(linked.withColumnRenamed("node", "class_id"), "class_id")
        at = at.withColumn("grade", F.floor(F.log("n") / F.log(F.lit(1.1))).cast("int"))
        counted = at.groupBy("component", "grade").agg(F.count(F.lit(1)).alias("k"))
        salt = F.pmod(F.xxhash64("digest"), F.ceil(F.col("k") / LEAF)).alias("salt")
        at = at.join(counted, ["component", "grade"]).withColumn("block", F.struct("grade", salt))
        held = at.join(texts.withColumnRenamed("doc", "class_id"), "class_id").select("component", "block", "digest", "n", "n_class", "text")
        held = materialize(held, "shingle-blocks", compression="zstd")
        blocks = held.groupBy("component", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
        one, two = (blocks.select("component", *(F.col(c).alias(f"{c}_{i}") for c in ("block", "low", "high"))) for i in (1, 2))
        pairs = one.join(two, "component").filter(
            (F.col("block_1") <= F.col("block_2"))
            & (F.col("low_1") * percent <= F.col("high_2") * 100)
            & (F.col("low_2") * percent <= F.col("high_1") * 100)
        )

        def side(i: int) -> DataFrame:
            of = pairs.select("component", F.col(f"block_{i}").alias("block"), "block_1", "block_2")
            return held.join(of, ["component", "block"]).select(
                "component", "block_1", "block_2", F.lit(i).alias("side"), "digest", "n_class", "text"
            )

        def run(table: pa.Table) -> pa.Table:
            hashes, begins = shingle_sets(*arrays.utf8(pa.concat_arrays(table["text"].chunks)), size)
            sides, weights, found = np.asarray(table["side"]), np.asarray(table["n_class"]), {}
            for i, digest in enumerate(table["digest"].to_pylist()):
                members = hashes[begins[i] : begins[i + 1]]
                # A repeated id may have several texts, of which one is the class's.
                if _digest(members) == digest:
                    found[digest] = sides[i], members, weights[i]
            one, two = ([d for d, f in found.items() if f[0] == i] for i in (1, 2))
            same = not (sides == 2).any()
            two = one if same else two
            shared = overlaps([found[d][1] for d in one], [found[d][1] for d in two])
            n_one, n_two = (np.array([len(found[d][1]) for d in ds], np.int64) for ds in (one, two))
            w_one, w_two = (np.array([found[d][2] for d in ds], np.int64) for ds in (one, two))
            links = (100 * shared >= percent * (n_one[:, None] + n_two - shared)).astype(np.int64)
            if same:
                np.fill_diagonal(links, 0)
            near = [links @ w_two] if same else [links @ w_two, w_one @ links]
            digests = one if same else one + two
            return pa.table({"digest": pa.array(digests, pa.binary()), "near": pa.array(np.concatenate(near), pa.int64())})

        compared = side(1).unionAll(side(2).filter("block_1 != block_2")).groupBy("component", "block_1", "block_2")
        return compared.applyInArrow(run, "digest binary, near long").groupBy("digest").agg(F.sum("near").alias("n_near"))

    def groups(self, count_links: bool = True) -> DataFrame:
        """The id, `n_shingles`, `class_id`, `component_id`, `n_class` and `n_links` of every row of the table.

        `class_id` is the smallest id with an equal set, `component_id` the
        smallest that links reach, `n_class` the number of rows in the class,
        `n_links` that of all other rows that reach the similarity with this
        one, in its class or not; without `count_links` it is left out.
        Null texts and texts without words have no shingles and link with
        nothing. Repeated rows are classed together; rows without an id link
        with nothing and keep a null. Other columns are not looked at. An empty
        table gives an empty result. Runs jobs when called.
        """
        points = materialize(self.points(), "shingle-points")
        links, texts = self._connecting(points)
        linked = components(links.select("a", "b"))
        classes = points.filter("n > 0").groupBy("digest").agg(F.min("doc").alias("class_id"), F.count(F.lit(1)).alias("n_class"), F.first("n").alias("n"))
        classed = points.join(classes.drop("n"), "digest").join(linked.withColumnRenamed("node", "class_id"), "class_id", "left")
        empty = points.filter("n = 0").select("doc", "n", F.col("doc").alias("class_id"), F.col("doc").alias("component"), F.lit(1).cast("long").alias("n_class"))
        counted = []
        if count_links:
            classed = classed.join(self._near(classes, linked, texts), "digest", "left")
            classed = classed.withColumn("n_links", F.col("n_class") - 1 + F.coalesce("n_near", F.lit(0)))
            empty = empty.withColumn("n_links", F.lit(0).cast("long"))
            counted = ["n_links"]
        return classed.select("doc", "n", "class_id", F.coalesce("component", "class_id").alias("component"), "n_class", *counted).unionAll(empty).select(
            F.col("doc").alias(self.id_column),
            F.col("n").alias("n_shingles"),
            F.col("component").alias("component_id"),
            "class_id",
            "n_class",
            *counted,
        )


def drop_near(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options: int) -> DataFrame:
    """The rows of `docs` with the smallest id of their component, with all their columns. Rows without an id go."""
    groups = ShingleJoin(docs, id_column, text_column, **options).groups(count_links=False)
    keep = groups.filter(F.col(id_column) == F.col("component_id")).select(id_column).distinct()
    return docs.join(keep, id_column, "left_semi")


def _star(members: DataFrame) -> DataFrame:
    """Pairs (a, b) that compare every node with one below the same shingle, or with two in a crowd."""
    # Near copies of one text may link with it and not with each other. It shares the most with all of them, as they
    # share what they kept of it. The smallest node is the same below most shingles of a group, too.
    reach = members.withColumn("reach", F.sum("k").over(Window.partitionBy("node")))
    pivots = reach.groupBy("shingle").agg(F.max_by("node", F.struct("reach", "node")).alias("hub"), F.min("node").alias("low"))
    hub, low = F.col("hub"), F.col("low")
    return (
        members.join(pivots, "shingle")
        .select(F.col("node").alias("a"), F.explode(F.when(F.col("k") < CROWD, F.array(hub)).otherwise(F.array(hub, low))).alias("b"))
        .filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many members each set of `one` shares with each of `two`; members are distinct within a set."""
    out = np.zeros((len(one), len(two)), np.int64)
    if not one or not two:
        return out
    both = np.intersect1d(np.concatenate(one), np.concatenate(two))
    laid = []
    for sets in (one, two):
        values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = np.searchsorted(both, values)
        shared = column < len(both)
        shared[shared] = both[column[shared]] == values[shared]
        laid.append((row[shared], column[shared]))
    for at in range(0, len(both), COLUMNS):
        width = min(COLUMNS, len(both) - at)
        parts = []
        for sets, (row, column) in zip((one, two), laid, strict=True):
            here = (column >= at) & (column < at + width)
            part = np.zeros((len(sets), width), np.float32)
            part[row[here], column[here] - at] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _coordinates(sizes: np.ndarray) -> np.ndarray:
    """Coordinates of the points of sets, by their sizes: a power of two."""
    wanted = np.ceil(np.log2(np.maximum(sizes, 1) / PER_GROUP))
    return 1 << np.clip(wanted, np.log2(FEWEST_GROUPS), np.log2(MOST_GROUPS)).astype(np.int64)


def _parities(sizes: np.ndarray) -> np.ndarray:
    """Bits that tell odd groups of the sets, by their sizes: a power of two."""
    wanted = np.ceil(np.log2(np.maximum(sizes, 1) * BITS))
    return 1 << np.clip(wanted, np.log2(FEWEST_BITS), np.log2(MOST_BITS)).astype(np.int64)


def _points(hashes: np.ndarray, of: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Counts per group of each set's shingles, a byte each, and which of more groups hold an odd number, a bit each."""

    def column(flat: np.ndarray, begins: np.ndarray) -> pa.Array:
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(begins), pa.py_buffer(flat)]
        ).cast(pa.binary())

    wide = _coordinates(sizes)
    begins = np.append(0, np.cumsum(wide))
    # The upper of these bits tell the groups, so halving their number joins neighbours.
    bits = np.log2(wide).astype(np.uint64)[of]
    group = ((hashes << np.uint64(24)) >> (np.uint64(64) - bits)).astype(np.int64)
    counts = np.bincount(begins[of] + group, minlength=begins[-1])
    points = column(np.minimum(counts, MOST).astype(np.uint8), begins)

    # The lowest bits tell these groups, so halving their number lays the second half on the first.
    wide = _parities(sizes)
    begins = np.append(0, np.cumsum(wide))
    group = hashes.astype(np.int64) & (wide[of] - 1)
    odd = np.bincount(begins[of] + group, minlength=begins[-1]) & 1
    return points, column(np.packbits(odd.astype(bool), bitorder="little"), begins // 8)


class PointTable:
    """Points of one column as matrices, one for each number of coordinates, and the sizes of their sets."""

    def __init__(self, points: pa.Array, sizes: np.ndarray) -> None:
        data, begins = arrays.flat(points)
        self.width = np.diff(begins)
        self.row = np.empty(len(sizes), np.int64)
        self.matrix = {}
        total = np.zeros(len(sizes), np.int64)
        for width in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == width)
            self.matrix[width] = data[arrays.ragged(begins[rows], self.width[rows])].reshape(len(rows), width)
            self.row[rows] = np.arange(len(rows))
            total[rows] = self.matrix[width].sum(1, dtype=np.int64)
        #: What the sets hold beyond the largest coordinates.
        self.beyond = sizes - total

    def take(self, rows: np.ndarray, width: int, coarse: int) -> np.ndarray:
        """Points of `width` coordinates, as `coarse` ones."""
        found = self.matrix[width][self.row[rows]]
        return found if coarse == width else found.reshape(len(rows), coarse, -1).sum(2, dtype=np.uint16)


def bounds(one: PointTable, i: np.ndarray, two: PointTable, j: np.ndarray) -> np.ndarray:
    """The most that set i[k] of one table and j[k] of the other share, by the minima of their points' coordinates."""
    # Coordinates that were cut are the same ones on both sides only if the points are alike.
    beyond = one.beyond[i], two.beyond[j]
    out = np.where(one.width[i] == two.width[j], np.minimum(*beyond), np.add(*beyond))
    widths = one.width[i] << 32 | two.width[j]
    for both in np.unique(widths).tolist():
        w1, w2 = both >> 32, both & 0xFFFFFFFF
        coarse = min(w1, w2)
        rows, step = np.flatnonzero(widths == both), max(1, PAIRS // coarse)
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            least = np.minimum(one.take(i[part], w1, coarse), two.take(j[part], w2, coarse))
            out[part] += least.sum(1, dtype=np.int64)
    return out


class ParityTable:
    """Bits of one column as matrices of 64 bits a word, one for each number of words."""

    def __init__(self, odd: pa.Array) -> None:
        data, begins = arrays.flat(odd)
        wide = np.diff(begins)
        self.width, self.row, self.matrix = wide // 8, np.empty(len(wide), np.int64), {}
        for width in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == width)
            self.matrix[width] = data[arrays.ragged(begins[rows], wide[rows])].view(np.uint64).reshape(len(rows), width)
            self.row[rows] = np.arange(len(rows))

    def take(self, rows: np.ndarray, width: int, coarse: int) -> np.ndarray:
        """Bits of `width` words, as those of `coarse` words."""
        found = self.matrix[width][self.row[rows]]
        return found if coarse == width else np.bitwise_xor.reduce(found.reshape(len(rows), -1, coarse), axis=1)


def apart(one: ParityTable, i: np.ndarray, two: ParityTable, j: np.ndarray) -> np.ndarray:
    """The least members that only one of the sets i[k] of one table and j[k] of the other holds."""
    out = np.zeros(len(i), np.int64)
    widths = one.width[i] << 32 | two.width[j]
    for both in np.unique(widths).tolist():
        w1, w2 = both >> 32, both & 0xFFFFFFFF
        coarse = min(w1, w2)
        rows, step = np.flatnonzero(widths == both), max(1, PAIRS // max(w1, w2))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            differ = one.take(i[part], w1, coarse) ^ two.take(j[part], w2, coarse)
            out[part] = np.bitwise_count(differ).sum(1, dtype=np.int64)
    return out


class Leaves:
    """A column of leaves: lists of points."""

    def __init__(self, column: pa.ListArray) -> None:
        points = column.flatten()
        self.sizes = np.asarray(pc.list_value_length(column)).astype(np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.doc, self.n, self.component = (np.asarray(points.field(k)) for k in (0, 1, 2))
        self.odd = ParityTable(points.field(3))


def leaf_pairs(one: Leaves, two: Leaves, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of documents of the k-th leaves of each side, for all k, that the sizes and the bits let through.

    Texts that stand below several common shingles come once.
    """
    # Every point of one side with the leaf that faces it.
    leaf = np.repeat(np.arange(len(one.sizes)), one.sizes)
    facing = two.sizes[leaf]
    found, nothing = [], np.empty(0, np.int64)
    ends = np.cumsum(facing)
    first = 0
    while first < len(leaf):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
        i = np.repeat(np.arange(first, last), facing[first:last])
        j = arrays.ragged(two.begins[leaf[first:last]], facing[first:last])
        first = last
        small, large = np.minimum(one.n[i], two.n[j]), np.maximum(one.n[i], two.n[j])
        fits = (one.component[i] != two.component[j]) & (small * 100 >= large * percent)
        i, j = i[fits], j[fits]
        pairs = np.stack([np.maximum(one.doc[i], two.doc[j]), np.minimum(one.doc[i], two.doc[j])])
        _, new = np.unique(pairs, axis=1, return_index=True)
        i, j = i[new], j[new]
        both = one.n[i] + two.n[j]
        near = both - apart(one.odd, i, two.odd, j) >= 2 * _needed(both, percent)
        found.append(pairs[:, new[near]])
    a, b = np.unique(np.concatenate(found, axis=1), axis=1) if found else (nothing, nothing)
    return a, b
