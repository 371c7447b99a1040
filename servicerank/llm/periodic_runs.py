"""Periodic runs of words: stretches that repeat themselves at a short distance.

A run with period q and at least 4 * q words holds a whole dyadic block: one that
begins at a multiple of its length L, a power of two, with q < L <= 2 * q. The
block covers a full period, so inside the run its occurrences form the
progression ..., b - q, b, b + q, ... with nothing in between, and one of the two
neighbours lies inside the run. So the nearest occurrence before and after each
block, if nearer than L, gives every candidate period. Equal blocks are an
interval of the suffix array; its nearest larger and smaller entries are found
by a wavelet tree over the array. Candidates are extended to both sides as far as
they go, by the ranks of dyadic substrings that the suffix sort leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicerank.llm import arrays

#: A run has this many words at least, and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SuffixOrder:
    """Suffixes of several sequences in order, and the ranks of their dyadic substrings.

    `levels[k][i]` ranks the 2**k symbols from i on: equal ranks are equal
    substrings of one sequence (those that reach past its end are never equal).
    """

    def __init__(self, symbols: np.ndarray, begins: np.ndarray) -> None:
        n = len(symbols)
        sizes = np.diff(begins)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.begin, self.end = begins[:-1][self.owner], begins[1:][self.owner]
        key = self.owner * (int(symbols.max(initial=0)) + 1) + symbols
        self.order = np.argsort(key, kind="stable")
        self.levels: list[np.ndarray] = []
        # Per level from the second on: positions whose rank isn't theirs alone, and how many share it.
        self.shared: list[tuple[np.ndarray, np.ndarray]] = []
        rank, slots, length, longest = np.empty(n + 1, np.int64), np.arange(n), 1, int(sizes.max(initial=0))
        rank[n] = -1
        key = key[self.order]
        while True:
            first = np.ones(len(slots), bool)
            first[1:] = key[1:] != key[:-1]
            heads = np.flatnonzero(first)
            counts = np.diff(np.append(heads, len(slots)))
            position = self.order[slots]
            # Slots of one rank follow each other, so the first slot names the rank.
            rank[position] = np.repeat(slots[heads], counts)
            self.levels.append(rank.astype(np.int32 if n < 2**31 - 1 else np.int64))
            several = np.repeat(counts, counts)
            alike = several > 1
            self.shared.append((position[alike], several[alike]))
            slots = slots[alike]
            if not len(slots) or length >= longest:
                break
            position = self.order[slots]
            follower = np.minimum(position + length, n)
            inside = position + length < self.end[position]
            key = rank[position] * (n + 2) + np.where(inside, rank[follower], -1) + 1
            by = np.argsort(key, kind="stable")
            self.order[slots] = position[by]
            key = key[by]
            length *= 2

    def extend(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols agree from a and b on, or before them; a and b are of one sequence."""
        out = np.zeros(len(a), np.int64)
        last = len(self.levels[0]) - 1
        begin = self.begin[a]
        for k in range(len(self.levels) - 1, -1, -1):
            step, ranks = 1 << k, self.levels[k]
            if forward:
                same = ranks[np.minimum(a + out, last)] == ranks[np.minimum(b + out, last)]
            else:
                x, y = a - out - step, b - out - step
                same = (x >= begin) & (ranks[np.maximum(x, 0)] == ranks[np.maximum(y, 0)])
            out[same] += step
        return out


class WaveletTree:
    """Counts and order statistics of intervals of an array of small numbers; each level is kept as zeros before ones."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit) & 1 == 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~ones, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[~ones], values[ones]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values in [low, high) are smaller than `bound`, one of the values."""
        found = np.zeros(len(low), np.int64)
        for level, before in enumerate(self.zeros):
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            a, b = before[low].astype(np.int64), before[high].astype(np.int64)
            found += np.where(one, b - a, 0)
            low, high = np.where(one, before[-1] + low - a, a), np.where(one, before[-1] + high - b, b)
        return found

    def ranked(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The values in [low, high) that have `rank` smaller ones there."""
        out, rank = np.zeros(len(low), np.int64), rank.copy()
        for before in self.zeros:
            a, b = before[low].astype(np.int64), before[high].astype(np.int64)
            one = rank >= b - a
            rank -= np.where(one, b - a, 0)
            out = 2 * out + one
            low, high = np.where(one, before[-1] + low - a, a), np.where(one, before[-1] + high - b, b)
        return out


def find_runs(symbols: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run, by start, then period.

    Sequence i is symbols[begins[i]:begins[i + 1]], of numbers from 0 on; starts count from the first symbol of all.
    """
    none = np.empty(0, np.int64)
    if not len(symbols):
        return none, none, none
    suffixes = SuffixOrder(symbols, begins)
    blocks, lengths, counts = [], [], []
    for k, (position, several) in enumerate(suffixes.shared):
        if k:
            aligned = (position - suffixes.begin[position]) % (1 << k) == 0
            blocks.append(position[aligned])
            counts.append(several[aligned])
            lengths.append(np.full(int(aligned.sum()), 1 << k))
    if not sum(map(len, blocks)):
        return none, none, none
    block, length, count = map(np.concatenate, (blocks, lengths, counts))

    # Only entries that share two symbols with another one can be in a block's interval.
    kept = np.zeros(len(symbols), bool)
    kept[suffixes.shared[1][0]] = True
    kept = kept[suffixes.order]
    slot = np.append(0, np.cumsum(kept))
    tree = WaveletTree(suffixes.order[kept])
    low = np.concatenate([slot[suffixes.levels[k + 1][b]] for k, b in enumerate(blocks)])
    high = low + count
    at = tree.below(low, high, block)
    near = []
    for step in (1, -1):
        there = np.flatnonzero((at + step >= 0) & (at + step < count))
        other = tree.ranked(low[there], high[there], at[there] + step)
        close = np.abs(other - block[there]) < length[there]
        near.append(np.stack([np.minimum(other, block[there]), np.maximum(other, block[there])])[:, close])
    a, b = np.unique(np.concatenate(near, axis=1), axis=1)
    period = b - a
    start = a - suffixes.extend(a, b, False)
    size = b + suffixes.extend(a, b, True) - start
    long = size >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    if not long.any():
        return none, none, none
    start, period, size = np.unique(np.stack([start[long], period[long], size[long]]), axis=1)
    return start, size, period


def _repeated(start: np.ndarray, size: np.ndarray, period: np.ndarray, n: int) -> np.ndarray:
    """Which words belong to a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + size, -1)
    return np.cumsum(change[:-1]) > 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """The words [starts, ends) of each of `n` texts, joined by one space."""
    sizes = ends - starts
    last = np.ones(len(owner), bool)
    last[:-1] = owner[1:] != owner[:-1]
    spaced = sizes + ~last
    out = np.append(data, np.uint8(32))[np.minimum(arrays.ragged(starts, spaced), len(data))]
    out[(np.cumsum(spaced) - 1)[~last]] = 32
    lengths = np.bincount(owner, weights=spaced, minlength=n).astype(np.int64)
    offsets = np.append(0, np.cumsum(lengths))
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())


def _codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word; equal words, byte by byte, have equal numbers."""
    sizes = ends - starts
    letters = data[arrays.ragged(starts, sizes)]
    offsets = np.append(0, np.cumsum(sizes))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    )
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _runs_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [pa.field(c, pa.int64()) for c in ("start", "length", "period")]
    for batch in batches:
        data, offsets = arrays.utf8(batch.column("_text"))
        for first, last in arrays.chunks(offsets):
            n = last - first
            part, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            starts, ends, owner = arrays.words(part, bounds)
            begins = np.append(0, np.cumsum(np.bincount(owner, minlength=n)))
            start, size, period = find_runs(_codes(part, starts, ends), begins)
            text = owner[start]
            kept = ~_repeated(start, size, period, len(starts))
            structs = pa.StructArray.from_arrays(list(map(pa.array, (start - begins[text], size, period))), fields=fields)
            where = np.append(0, np.cumsum(np.bincount(text, minlength=n))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").slice(first, n),
                    pa.array(np.diff(begins)),
                    pa.ListArray.from_arrays(pa.array(where), structs),
                    _joined(part, starts[kept], ends[kept], owner[kept], n),
                ],
                names=["_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `n_words`, `runs`, `collapsed`.

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text, compared byte by byte. A run
    is a stretch with smallest period q (words q apart are identical) of at least
    6 words and 4 * q words that can't be made longer with that period; `runs`
    lists start (word number from 0), length and period by start, then period.
    `collapsed` are the words that are in no run beyond its first period, joined
    by one space.

    No shuffle: every text is looked at by itself, some thousands of words of
    short texts at a time. Null and empty texts have no words, no runs and an
    empty `collapsed`. Ids may be null or repeat; rows are not told apart by
    them. Other columns are not looked at, whatever their names; an empty table
    gives an empty result. A text needs about 150 bytes of memory a word, and
    4 more for each doubling of the longest stretch that repeats.
    """
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    kind = docs.schema[id_column].dataType.simpleString()
    found = rows.mapInArrow(_runs_of_texts, f"_id {kind}, n_words bigint, runs {RUNS}, collapsed string")
    return found.withColumnRenamed("_id", id_column)
