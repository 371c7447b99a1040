"""Where windows of a fixed length stand a second time: the part common to bytes and words.

Every window is assigned to the least hashed gram inside it, its anchor, so
equal windows have equal anchors at equal places. Consecutive windows with one
anchor form a stretch. Stretches whose anchor stands nowhere else are dropped;
equal stretches are settled by who comes first; what is left, unequal
stretches with a common anchor, is compared window by window by the operator.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servicerank.llm import arrays
from servicerank.llm.work import materialize

#: Window starts handled at a time; their places fit the low bits of a rank.
PLACES = 1 << 18


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each `size` consecutive values."""
    n = len(values) - size + 1
    padded = np.full(-(-len(values) // size) * size, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, size)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[size - 1 : size - 1 + n])


def stretches(symbols: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchor hash, content hash, text, start, windows and the anchor's distance from the start, of all stretches."""
    n = len(symbols)
    if n < window:
        return
    prefix = arrays.prefix_hashes(symbols)
    grams = arrays.window_hashes(prefix, gram)
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    span = window - gram + 1
    low = np.uint64((1 << 20) - 1)
    for first in range(0, n - window + 1, PLACES):
        last = min(first + PLACES, n - window + 1)
        ranks = (grams[first : last + span - 1] & ~low) | np.arange(last + span - 1 - first, dtype=np.uint64)
        places = first + (sliding_minimum(ranks, span) & low).astype(np.int64)
        starts = np.arange(first, last)
        whole = text_of[first:last] == text_of[first + window - 1 : last + window - 1]
        places, starts = places[whole], starts[whole]
        if not len(starts):
            continue
        new = np.ones(len(starts), bool)
        new[1:] = (places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1)
        at = np.flatnonzero(new)
        windows = np.diff(np.append(at, len(starts)))
        begin, place = starts[at], places[at]
        text = text_of[begin]
        content = arrays.span_hashes(prefix, begin, begin + windows + window - 1) ^ windows.astype(np.uint64)
        yield grams[place], content, text, begin - offsets[text], windows, place - begin


#: Gives symbols and where each text begins among them, of a chunk of texts.
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
#: The comparison of stretches with common anchors: arrays and contexts in, spans (doc, begin, end) out.
Compare = Callable[[dict[str, np.ndarray], list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass
class Plan:
    """What an operator on bytes or words brings: its units, their contexts, the comparison, and the result of a text.

    `contexts` cuts spans of units out of a text, `hashed` gives the symbols of
    such a cut; `finish` makes a row of the `fields` (name, SQL type, Arrow
    type) from a text and the disjoint spans that go.
    """

    units: Units
    contexts: Callable[[bytes, np.ndarray, np.ndarray], list[bytes]]
    hashed: Callable[[bytes], np.ndarray]
    compare: Compare
    finish: Callable[[bytes, np.ndarray, np.ndarray], tuple]
    fields: list[tuple[str, str, pa.DataType]]
    window: int
    gram: int
    #: Stretches with one anchor up to which a task compares the unequal ones itself; windows of larger groups are
    #: dealt out by hash.
    together: int
    #: Whether an earlier start in the same document counts as earlier.
    within: bool


def packed(start: np.ndarray, windows: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return start << 24 | windows << 12 | offset


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 24, place >> 12 & 4095, place & 4095


def _local_firsts(anchor: np.ndarray, content: np.ndarray, doc: np.ndarray, place: np.ndarray, within: bool) -> np.ndarray:
    """Rows that no other row of the batch with the same anchor and content comes before."""
    order = np.lexsort((place, doc, content, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[order[1:]] != anchor[order[:-1]]) | (content[order[1:]] != content[order[:-1]])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    keep = doc[order] == doc[first]
    if within:
        keep &= place[order] >> 24 == place[first] >> 24
    out = np.empty(len(order), bool)
    out[order] = keep
    return out


def find(docs: DataFrame, plan: Plan) -> DataFrame:
    """(doc, *fields) of the `docs` (doc, text) that share a window with an earlier place, or are shared with.

    Earlier is a smaller doc, and with `within` also an earlier start in the
    same one. Stretches that come again within a batch are settled before the
    shuffle, so a passage of a third of all documents reaches a task as a few
    rows a batch; the window functions after it hold rows of numbers only and
    can spill. Runs jobs when called.
    """
    window, within = plan.window, plan.within
    if window > 4095:
        raise ValueError("windows hold 4095 units at most")
    units, gram = plan.units, plan.gram

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.utf8(batch.column(1))
            ids = np.asarray(batch.column(0))
            found = []
            for first, last in arrays.chunks(offsets):
                part = data[offsets[first] : offsets[last]]
                symbols, begins = units(part, offsets[first : last + 1] - offsets[first])
                for anchor, content, text, start, count, offset in stretches(symbols, begins, window, gram):
                    found.append((anchor, content, ids[first + text], packed(start, count, offset)))
            if not found:
                continue
            anchor, content, doc, place = (np.concatenate(c) for c in zip(*found, strict=True))
            again = ~_local_firsts(anchor, content, doc, place, within)
            # Settled rows only pass through the shuffle: spread evenly, they meet no other row.
            anchor[again] = arrays.mixed(doc[again].astype(np.uint64) ^ arrays.mixed(place[again].astype(np.uint64)))
            columns = (anchor.view(np.int64), content.view(np.int64), doc, place)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, mask=again if i == 1 else None) for i, c in enumerate(columns)],
                ["anchor", "content", "doc", "place"],
            )

    docs = docs.filter("doc IS NOT NULL")
    rows = docs.mapInArrow(scan, "anchor long, content long, doc long, place long")
    below = Window.partitionBy("anchor")
    same = Window.partitionBy("anchor", "content").orderBy("doc", *([F.shiftright("place", 24)] if within else []))
    shared = rows.select(
        "*",
        F.count("content").over(below).alias("members"),
        F.min("content").over(below).alias("low"),
        F.max("content").over(below).alias("high"),
    ).filter("content IS NULL OR members > 1")
    ranked = shared.select("*", F.rank().over(same).alias("rank")).select(
        "doc",
        "place",
        "anchor",
        "members",
        F.when(F.col("content").isNull() | (F.col("rank") > 1), "settled")
        .when(F.col("low") != F.col("high"), "open")
        .alias("state"),
    )
    per_doc = (
        ranked.filter("state IS NOT NULL")
        .select(
            "doc",
            F.struct(
                "place",
                F.when(F.col("state") == "open", F.col("anchor")).alias("anchor"),
                F.when(F.col("state") == "open", F.col("members")).alias("members"),
            ).alias("stretch"),
        )
        .groupBy("doc")
        .agg(F.collect_list("stretch").alias("stretches"))
    )
    names = ["doc", "text", "stretches", *(n for n, _, _ in plan.fields)]
    kinds = [pa.int64(), pa.string(), STRETCHES, *(k for _, _, k in plan.fields)]
    finish = plan.finish

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of texts without open stretches, the others as they are."""
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text, found = (batch.column(c)[i] for c in range(3))
                fields = found.values
                start, count, _ = unpacked(np.asarray(fields.field("place")))
                if fields.field("anchor").null_count == len(start):
                    spans = merged(start, start + count + window - 1)
                    row = [doc.as_py(), None, None, *finish((text.as_py() or "").encode(), *spans)]
                else:
                    row = [doc.as_py(), text.as_py(), found.as_py(), *(None for _ in plan_fields)]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    plan_fields = plan.fields
    schema = "doc long, text string, stretches array<struct<place:long,anchor:long,members:long>>, " + ", ".join(
        f"{n} {k}" for n, k, _ in plan.fields
    )
    # One row per id: a repeated id is one document.
    joined = docs.join(per_doc, "doc").dropDuplicates(["doc"])
    half = materialize(joined.select("doc", "text", "stretches").mapInArrow(divide, schema), "repeat-texts", compression="zstd")
    results = [n for n, _, _ in plan.fields]
    done = half.filter("stretches IS NULL").select("doc", *results)

    open_texts = half.filter("stretches IS NOT NULL").select("doc", "text", "stretches")
    spans = _compared(open_texts, plan).groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text, found, more = (batch.column(c)[i] for c in range(4))
                start, count, _ = unpacked(np.asarray(found.values.field("place")))
                known = np.asarray(found.values.field("anchor").is_null())
                begin, end = start[known], (start + count + window - 1)[known]
                if more.is_valid:
                    begin = np.append(begin, np.asarray(more.values.field("begin")))
                    end = np.append(end, np.asarray(more.values.field("end")))
                row = [doc.as_py(), *finish((text.as_py() or "").encode(), *merged(begin, end))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(row, [kinds[0], *kinds[3:]], strict=True)], ["doc", *results]
                )

    rest = open_texts.join(spans, "doc", "left").mapInArrow(
        complete, "doc long, " + ", ".join(f"{n} {k}" for n, k, _ in plan.fields)
    )
    return done.unionAll(rest)


STRETCHES = pa.list_(pa.struct([("place", pa.int64()), ("anchor", pa.int64()), ("members", pa.int64())]))
CONTEXT = "anchor long, doc long, place long, members long, context binary"


def _compared(open_texts: DataFrame, plan: Plan) -> DataFrame:
    """Spans (doc, begin, end) settled by comparing unequal stretches around one anchor."""
    names = [c.split()[0] for c in CONTEXT.split(", ")]
    window, contexts, hashed, compare = plan.window, plan.contexts, plan.hashed, plan.compare

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text, found = (batch.column(c)[i] for c in range(3))
                fields = found.values.filter(found.values.field("anchor").is_valid())
                anchor, place, members = (np.asarray(fields.field(k)) for k in ("anchor", "place", "members"))
                start, count, _ = unpacked(place)
                cuts = contexts((text.as_py() or "").encode(), start, start + count + window - 1)
                out = [anchor, np.full(len(anchor), doc.as_py()), place, members]
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in out), pa.array(cuts, pa.binary())], names)

    cuts = materialize(open_texts.mapInArrow(cut, CONTEXT), "repeat-contexts", compression="zstd")

    def opened(batch: pa.RecordBatch | pa.Table) -> dict[str, np.ndarray]:
        fields = {k: np.asarray(batch[k]) for k in ("anchor", "doc", "place")}
        fields["start"], fields["windows"], fields["offset"] = unpacked(fields["place"])
        return fields

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "anchor", 4096):
            spans = compare(opened(table), table["context"].to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(s) for s in spans], ["doc", "begin", "end"])

    few = cuts.filter(F.col("members") <= plan.together)
    near = few.repartition("anchor").sortWithinPartitions("anchor", "doc", "place").mapInArrow(settle, "doc long, begin long, end long")

    # Of a large group, only stretches that share more than the anchor: a window reaches `half` units before its
    # anchor, or far enough behind it, so it holds the longer left core or the longer right core.
    half = (window - plan.gram) // 2 + 1
    cores_of = [(-half, plan.gram), (0, window - half + 1)]

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                fields = opened(part)
                out = []
                for i, context in enumerate(part["context"].to_pylist()):
                    prefix = arrays.prefix_hashes(hashed(context))
                    anchor, count = int(fields["offset"][i]), int(fields["windows"][i])
                    for side, (before, behind) in enumerate(cores_of):
                        if (anchor >= half) if side == 0 else (anchor - count + 1 < half):
                            span = np.array([anchor + before]), np.array([anchor + behind])
                            out.append((i, side, arrays.span_hashes(prefix, *span).view(np.int64)[0]))
                rows = pa.array([r for r, _, _ in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part[k].take(rows) for k in names),
                        pa.array([side for _, side, _ in out], pa.int32()),
                        pa.array([core for _, _, core in out], pa.int64()),
                    ],
                    [*names, "side", "core"],
                )

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                fields, left = opened(part), np.asarray(part["side"]) == 0
                hashes = [arrays.window_hashes(arrays.prefix_hashes(hashed(c)), window) for c in part["context"].to_pylist()]
                cut = np.clip(fields["offset"] - half + 1, 0, fields["windows"])
                first, last = np.where(left, 0, cut), np.where(left, cut, fields["windows"])
                sizes = last - first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(fields["anchor"], sizes)),
                        pa.array(np.concatenate([h[a:b] for h, a, b in zip(hashes, first, last, strict=True)]).view(np.int64)),
                        pa.array(np.repeat(fields["doc"], sizes)),
                        pa.array(arrays.ragged(fields["start"] + first, sizes)),
                    ],
                    ["anchor", "hash", "doc", "start"],
                )

    cores = cuts.filter(F.col("members") > plan.together).mapInArrow(sides, CONTEXT + ", side int, core long")
    common = cores.groupBy("anchor", "side", "core").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    alike = cores.join(common, ["anchor", "side", "core"]).select(*names, "side")
    many = alike.mapInArrow(single, "anchor long, hash long, doc long, start long")
    order: Column = F.struct("doc", "start") if plan.within else F.struct("doc")
    earliest = many.groupBy("anchor", "hash").agg(F.min(order).alias("first"))
    far = many.join(earliest, ["anchor", "hash"]).filter(order != F.col("first"))
    return near.unionAll(far.select("doc", F.col("start").alias("begin"), (F.col("start") + window).alias("end")))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of about `rows` rows, or more, that hold all rows of each key; the input is sorted by key."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            count += held[-1].num_rows
            if count < rows:
                continue
            table = pa.Table.from_batches(held)
            keys = np.asarray(table[key])
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
                count -= cut
    if count:
        yield pa.Table.from_batches(held)


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans, as disjoint spans in order that don't touch."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    at = np.flatnonzero(new)
    return begin[at], end[np.append(at[1:], len(begin)) - 1]
