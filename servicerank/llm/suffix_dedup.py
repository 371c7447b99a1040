"""Repeated byte strings, found by sorting suffixes that are compared through hashes.

Suffixes that begin with a repeated window are sorted by merging. Two suffixes
are compared by a binary search for their common extension on polynomial prefix
hashes, so a comparison takes a logarithmic number of steps; suffixes that the
hashes call equal are checked byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicerank.llm import arrays, repeats

#: Bytes in a gram that anchors a window, and stretches around one that a task sorts itself.
GRAM, TOGETHER = 44, 8192


class Suffixes:
    """Suffixes of a byte array, compared on their first `depth` bytes."""

    def __init__(self, data: np.ndarray, depth: int) -> None:
        self.data, self.depth = data, depth
        self.prefix = arrays.prefix_hashes(arrays.symbols(data))

    def _same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return arrays.same_spans(self.prefix, a, b, size)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of each pair of suffixes, up to the depth."""
        low = np.zeros(len(a), np.int64)
        high = np.full(len(a), self.depth)
        equal = self._same(a, b, self.depth)
        low[equal] = self.depth
        rows = np.flatnonzero(~equal)
        high[rows] -= 1
        while len(rows := rows[low[rows] < high[rows]]):
            middle = (low[rows] + high[rows] + 1) // 2
            same = self._same(a[rows], b[rows], middle)
            low[rows[same]] = middle[same]
            high[rows[~same]] = middle[~same] - 1
        # Two strings with one hash: the byte comparison decides.
        doubtful = np.flatnonzero(low == self.depth)
        for at in range(0, len(doubtful), 1 << 14):
            part = doubtful[at : at + (1 << 14)]
            span = np.arange(self.depth)
            unequal = self.data[a[part][:, None] + span] != self.data[b[part][:, None] + span]
            wrong = unequal.any(1)
            low[part[wrong]] = unequal[wrong].argmax(1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix a sorts before b; equal ones do if `ties`."""
        common = self.extension(a, b)
        out = np.full(len(a), ties)
        apart = common < self.depth
        out[apart] = self.data[a[apart] + common[apart]] < self.data[b[apart] + common[apart]]
        return out

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Stable order of the suffixes within each group (groups are contiguous): a bottom-up mergesort.

        All merges of a level run at once: an element's place is its own place
        plus the number of elements of the other run before it, found by binary search.
        """
        order = np.arange(len(starts))
        if not len(starts):
            return order
        new = np.ones(len(group), bool)
        new[1:] = group[1:] != group[:-1]
        first_of = np.flatnonzero(new)
        sizes = np.diff(np.append(first_of, len(group)))
        first = np.repeat(first_of, sizes)
        size = np.repeat(sizes, sizes)
        place = np.arange(len(group)) - first
        width = 1
        while width < sizes.max():
            rows = np.flatnonzero(size > width)
            at, base, total = place[rows], first[rows], size[rows]
            run = at // width
            left = run % 2 == 0
            other = (run ^ 1) * width
            low = np.zeros(len(rows), np.int64)
            high = np.clip(total - other, 0, width)
            own = starts[order[rows]]
            while len(active := np.flatnonzero(low < high)):
                middle = (low[active] + high[active]) // 2
                there = starts[order[base[active] + other[active] + middle]]
                mine = own[active]
                is_left = left[active]
                # Elements of the left run go before equal ones of the right run.
                counts = np.empty(len(active), bool)
                counts[is_left] = self.before(there[is_left], mine[is_left], False)
                counts[~is_left] = self.before(there[~is_left], mine[~is_left], True)
                low[active[counts]] = middle[counts] + 1
                high[active[~counts]] = middle[~counts]
            merged = order.copy()
            merged[base + np.minimum(run, run ^ 1) * width + at % width + low] = order[rows]
            order = merged
            width *= 2
        return order


def _compare(window: int):
    def compare(fields: dict[str, np.ndarray], contexts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Windows that stand earlier as well, of stretches around common anchors."""
        data = np.frombuffer(b"".join(contexts), np.uint8)
        sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
        begins = np.cumsum(sizes) - sizes
        count = fields["windows"]
        owner = np.repeat(np.arange(len(count)), count)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        # Equal windows have their anchor at the same distance.
        distance = fields["offset"][owner] - step
        new_anchor = np.ones(len(count), bool)
        new_anchor[1:] = fields["anchor"][1:] != fields["anchor"][:-1]
        group = np.cumsum(new_anchor)[owner] * (window + 1) + distance
        by_group = np.argsort(group, kind="stable")
        group = group[by_group]
        _, inverse, counts = np.unique(group, return_inverse=True, return_counts=True)
        alone = counts[inverse] == 1
        by_group, group = by_group[~alone], group[~alone]
        starts = (begins[owner] + step)[by_group]
        suffixes = Suffixes(data, window)
        order = suffixes.sort(starts, group)
        one, two = order[:-1], order[1:]
        again = np.zeros(len(order), bool)
        if len(order):
            again[1:] = (group[one] == group[two]) & (suffixes.extension(starts[one], starts[two]) == window)
        # The order is stable and stretches come by document and start, so the first of equals is the earliest.
        rows = by_group[order[again]]
        begin = fields["start"][owner[rows]] + step[rows]
        return fields["doc"][owner[rows]], begin, begin + window

    return compare


def _bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return arrays.symbols(data), offsets


def _cut(text: bytes, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
    return [text[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def _hashed(context: bytes) -> np.ndarray:
    return arrays.symbols(np.frombuffer(context, np.uint8))


def _finish(text: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[int, int, str, bytes | None]:
    edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(text)]
    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    return len(text) - len(kept), len(begin), hashlib.sha256(kept).hexdigest(), kept if len(begin) else None


FIELDS = [
    ("n_removed", "long", pa.int64()),
    ("n_spans", "long", pa.int64()),
    ("kept_sha256", "string", pa.string()),
    ("kept", "binary", pa.binary()),
]


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 100, texts: bool = True
) -> DataFrame:
    """Texts as UTF-8 bytes without those covered by a `window`-byte string that starts earlier as well.

    Earlier is in a document with a smaller id, or earlier in the same one;
    overlaps count, and all strings are judged on the input. One row per row of
    `docs`: the id, `n_bytes`, `n_removed`, `n_spans` (maximal removed runs),
    `kept_sha256`, and with `texts` also `kept` (binary; null where nothing
    was removed).

    Null texts are empty; texts shorter than the window lose nothing. Ids are
    taken to be unique: of rows that repeat an id one text is judged. Rows
    without an id lose nothing. Other columns are not looked at. An empty table
    gives an empty result. Runs jobs when called.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc"), F.col(text_column).alias("text"))
    fields = FIELDS if texts else FIELDS[:3]
    width = len(fields)
    plan = repeats.Plan(
        units=_bytes,
        contexts=_cut,
        hashed=_hashed,
        compare=_compare(window),
        finish=lambda text, begin, end: _finish(text, begin, end)[:width],
        fields=fields,
        window=window,
        gram=min(GRAM, window),
        together=TOGETHER,
        within=True,
    )
    cut = repeats.find(rows, plan)
    text = F.coalesce("text", F.lit(""))
    whole = rows.select("doc", F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("whole_sha256"))
    return whole.join(cut, "doc", "left").select(
        F.col("doc").alias(id_column),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        *(["kept"] if texts else []),
    )
