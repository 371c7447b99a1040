"""Token counts that follow edits without encoding the whole text again.

Each document keeps a tree over blocks of pre-tokens: leaves hold a block's
length and token count, inner nodes the sums. An edit re-encodes the blocks it
touches, with enough text before them for the patterns' look-ahead, until a
pre-token ends where an untouched block begins; sums change on the paths above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicerank.llm.bpe import PRE_TOKENS, PRE_TOKENS_RECENT, ByteBpe, load, recent, slices

#: Pre-tokens in a block.
BLOCK = 32
EDITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("stop", T.LongType()),
            T.StructField("replacement", T.StringType()),
        ]
    )
)


class CountedText:
    """A text and the tree that keeps its token count right under edits.

    Counts of re-encoded blocks are looked up by `settle`, for many texts at once.
    """

    def __init__(self, bpe: ByteBpe, text: str, pieces: list[str]) -> None:
        """`pieces`: the pre-tokens of `text`, learned already."""
        self.bpe, self.text = bpe, text
        self.encoded = 0
        self.recent = recent(text)
        # A pre-token depends on the text behind it: the end of a special token, or of a contraction.
        self.context = max([3, *map(len, bpe.special)])
        self.pending: dict[int, list[str]] = {}
        cuts = range(0, len(pieces), BLOCK)
        counts = np.add.reduceat(bpe.counts(pieces), [*cuts]).tolist() if pieces else []
        self._build([sum(map(len, pieces[i : i + BLOCK])) for i in cuts], counts)

    @property
    def n_tokens(self) -> int:
        assert not self.pending, "settle first"
        return self.tokens[1]

    def _build(self, lengths: list[int], tokens: list[int]) -> None:
        """Heap-ordered trees: node i has children 2i and 2i + 1, leaves come last."""
        self.leaves = 1 << max(0, len(lengths) - 1).bit_length()
        self.lengths, self.tokens = ([0] * self.leaves + v + [0] * (self.leaves - len(v)) for v in (lengths, tokens))
        for tree in (self.lengths, self.tokens):
            for node in range(self.leaves - 1, 0, -1):
                tree[node] = tree[2 * node] + tree[2 * node + 1]

    def _leaf_at(self, position: int) -> tuple[int, int]:
        """The block that holds a position, and where the block starts."""
        node, start, lengths = 1, 0, self.lengths
        while node < self.leaves:
            node *= 2
            if position >= start + lengths[node]:
                start += lengths[node]
                node += 1
        return node - self.leaves, start

    def _set(self, tree: list[int], leaf: int, value: int) -> None:
        node = leaf + self.leaves
        change = value - tree[node]
        while change and node:
            tree[node] += change
            node //= 2

    def edit(self, start: int, stop: int, replacement: str) -> None:
        """Replace text[start:stop]; positions beyond the text mean its end."""
        size = len(self.text)
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        if start == stop and not replacement:
            return
        first, begin = self._leaf_at(max(0, min(start, size - 1) - self.context)) if size else (0, 0)
        # The first block behind the edit, by where it starts in the old text.
        leaf, at = self._leaf_at(min(stop, size - 1)) if size else (0, 0)
        at += self.lengths[self.leaves + leaf]
        leaf += 1
        self.text = self.text[:start] + replacement + self.text[stop:]
        shift = len(self.text) - size
        self.recent = self.recent or recent(replacement)

        position, gathered = begin, []
        for piece, end in self._pieces(begin):
            while at + shift < end and leaf < self.leaves:
                at += self.lengths[self.leaves + leaf]
                leaf += 1
            gathered.append(piece)
            position = end
            if end == at + shift and leaf < self.leaves and at < size:
                break
        else:
            leaf = self.leaves
        self.encoded += position - begin
        for other in range(first + 1, leaf):
            self.pending.pop(other, None)
            self._set(self.lengths, other, 0)
            self._set(self.tokens, other, 0)
        self._set(self.lengths, first, position - begin)
        self.pending[first] = gathered

    def settle(self) -> None:
        """Count the tokens of re-encoded blocks; their pre-tokens are learned already.

        A block that edits made long is cut up, so that later edits stay local.
        """
        for leaf, pieces in self.pending.items():
            self._set(self.tokens, leaf, int(self.bpe.counts(pieces).sum()) if pieces else 0)
        long = {i: p for i, p in self.pending.items() if len(p) > 8 * BLOCK}
        self.pending = {}
        if long:
            lengths, tokens = [], []
            for i in range(self.leaves):
                pieces = long.get(i)
                if pieces is None:
                    lengths.append(self.lengths[self.leaves + i])
                    tokens.append(self.tokens[self.leaves + i])
                    continue
                for at in range(0, len(pieces), BLOCK):
                    lengths.append(sum(map(len, pieces[at : at + BLOCK])))
                    tokens.append(int(self.bpe.counts(pieces[at : at + BLOCK]).sum()))
            used = [i for i, n in enumerate(lengths) if n]
            self._build([lengths[i] for i in used], [tokens[i] for i in used])

    def _pieces(self, begin: int) -> Iterator[tuple[str, int]]:
        """Pre-tokens of the text from a border on, and where each ends."""
        text = self.text
        pattern = PRE_TOKENS_RECENT if self.recent else PRE_TOKENS
        while begin < len(text):
            stop, special = len(text), ""
            for token in self.bpe.special:
                found = text.find(token, begin, stop + len(token))
                if 0 <= found < stop:
                    stop, special = found, token
            # Matching is lazy, so only what the caller takes is looked at.
            for piece in pattern.finditer(text, begin, stop):
                begin = piece.end()
                yield piece.group(), begin
            if begin == stop and special:
                begin = stop + len(special)
                yield special, begin


def count_tokens(
    docs: DataFrame,
    path: str,
    edits: DataFrame | Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Token counts of whole texts before and after a list of edits.

    `edits` is a column of `docs` of type EDITS, or a table (id, seq, start,
    stop, replacement) whose edits of a document apply in the order of `seq`;
    positions are code points in the text as the edits before left it. Result:
    the id, `n_tokens`, `n_tokens_edited`, `n_edits`, `edited` (the new text)
    and `n_encoded_again` (code points that the edits had encoded again).

    A null text is empty; null edits or replacements change nothing and insert
    nothing; positions beyond the text mean its end; edits of unknown ids are
    dropped. A column of edits needs no shuffle; a table is joined by id. Other
    columns are not looked at. An empty table gives an empty result.
    """
    key, text = F.col(id_column).alias("_id"), F.col(text_column).alias("_text")
    if isinstance(edits, DataFrame):
        listed = edits.groupBy(F.col(id_column).alias("_id")).agg(
            F.array_sort(F.collect_list(F.struct("seq", "start", "stop", "replacement"))).alias("_edits")
        ).select(
            "_id",
            F.transform("_edits", lambda e: F.struct(e.start.alias("start"), e.stop.alias("stop"), e.replacement.alias("replacement"))).cast(EDITS).alias("_edits"),
        )
        rows = docs.select(key, text).join(listed, "_id", "left")
    else:
        changes = F.lit(None) if edits is None else edits
        rows = docs.select(key, text, changes.cast(EDITS).alias("_edits"))
    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema[id_column].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_tokens_edited", T.LongType()),
            T.StructField("n_edits", T.IntegerType()),
            T.StructField("n_encoded_again", T.LongType()),
            T.StructField("edited", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for first, last in slices([t or "" for t in batch.column(1).to_pylist()]):
                part = batch.slice(first, last - first)
                texts = [t or "" for t in part.column(1).to_pylist()]
                changes = [[c for c in e or [] if c is not None] for e in part.column(2).to_pylist()]
                pieces = [bpe.cut(t) for t in texts]
                bpe.learn(pieces)
                trees = [CountedText(bpe, t, p) for t, p in zip(texts, pieces, strict=True)]
                before = [t.n_tokens for t in trees]
                for tree, edits in zip(trees, changes, strict=True):
                    for c in edits:
                        tree.edit(c["start"] or 0, c["stop"] or 0, c["replacement"] or "")
                bpe.learn(p for t in trees for p in t.pending.values())
                for tree in trees:
                    tree.settle()
                columns = (
                    (before, pa.int64()),
                    ([t.n_tokens for t in trees], pa.int64()),
                    ([len(c) for c in changes], pa.int32()),
                    ([t.encoded for t in trees], pa.int64()),
                    ([t.text for t in trees], pa.string()),
                )
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in columns)], schema.names)

    return rows.mapInArrow(run, schema)
