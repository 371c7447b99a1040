"""Byte-level BPE: greedy proposals, verified pair by pair, exact merging where that fails.

A greedy longest match cuts each pre-token into tokens. The cut is the BPE
encoding exactly when every token encodes to itself and no merge would have
crossed the border of two neighbours; both are looked up in arrays, for all
new pre-tokens of a batch at once. Pre-tokens that fail are merged step by step.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from servicerank.llm import arrays

#: Fixed value: the published pattern that cuts text before byte-level merges.
PRE_TOKENS = regex.compile(
    r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Code points (hexadecimal) that newer Unicode tables count as letters or
#: numbers and the tables the published tokenizers were built with don't.
UNASSIGNED = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf "
    "10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f "
    "12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 "
    "18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff "
    "1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e "
    "2cea2-2cead 323b0-33479 3d000-3fc3f "
).split()
_RECENT = "".join("-".join(f"\\U{int(c, 16):08x}" for c in span.split("-")) for span in UNASSIGNED)
RECENT = re.compile(f"[{_RECENT}]")


def recent(text: str) -> bool:
    """Whether a text holds one of them; none is in Latin-1, which is quick to tell."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return RECENT.search(text) is not None
    return False


#: The same pattern for texts that hold such code points.
PRE_TOKENS_RECENT = regex.compile(
    PRE_TOKENS.pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{_RECENT}])")
    .replace(r"\p{L}+", rf"(?:(?![{_RECENT}])\p{{L}})+")
    .replace(r"\p{N}+", rf"(?:(?![{_RECENT}])\p{{N}})+")
)
#: Pre-tokens remembered by a worker; beyond it the memory starts anew.
REMEMBERED = 500_000
OUTPUTS = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType()),
    "decoded": T.StringType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Encoder and decoder of a tokenizer file with byte-level BPE."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, letters = content["model"], byte_letters()
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self._specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "$^")
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for token, number in model["vocab"].items():
            self.bytes_of[number] = bytes(letters[c] for c in token)
        for token, number in self.special.items():
            self.bytes_of[number] = token.encode()
        vocabulary = model["vocab"]
        self.byte_id = [0] * 256
        for letter, byte in letters.items():
            self.byte_id[byte] = vocabulary[letter]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((vocabulary[left], vocabulary[right]), (rank, vocabulary[left + right]))
        self._size, self._no_rank = size, len(model["merges"])
        self._rank_of = {pair: rank for pair, (rank, _) in self.merges.items()}
        self._made_by = {rank: whole for rank, whole in self.merges.values()}
        self._tables()
        self.pieces = Spelling(self.bytes_of)
        self.numerals = Spelling([b"%d," % i for i in range(size)])
        self.forget()

    def _tables(self) -> None:
        """Arrays for the border checks, and the tokens that greedy matching may propose.

        A token's right spine holds the symbols that stand at its right end while
        it is merged together, each with the rank at which it is swallowed; the
        left spine likewise.
        """
        never = 1 << 30
        made: dict[int, tuple[int, int, int]] = {}
        for (left, right), (rank, whole) in self.merges.items():
            if whole not in made or rank < made[whole][0]:
                made[whole] = (rank, left, right)
        keys = np.array([a * self._size + b for a, b in self.merges], np.int64)
        ranks = np.array([r for r, _ in self.merges.values()], np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], ranks[order]

        def spine(number: int, side: int) -> list[tuple[int, int]]:
            out, swallowed = [(number, never)], number
            while swallowed in made:
                rank = made[swallowed][0]
                swallowed = made[swallowed][side]
                out.append((swallowed, rank))
            return out

        tokens = sorted({*self.byte_id, *made})
        depth = 1
        spines = {}
        for side in (1, 2):
            spines[side] = {t: spine(t, side) for t in tokens}
            depth = max(depth, *(len(s) for s in spines[side].values()))
        self._spine, self._until = {}, {}
        for side, by_token in spines.items():
            symbols = np.full((self._size, depth), -1, np.int32)
            until = np.full((self._size, depth), -1, np.int32)
            for token, steps in by_token.items():
                symbols[token, : len(steps)] = [s for s, _ in steps]
                until[token, : len(steps)] = [r for _, r in steps]
            self._spine[side], self._until[side] = symbols, until
        # A token that its own bytes do not merge to can't be proposed.
        own = [t for t in made if self.merge(self.bytes_of[t]) != [t]] if len(made) else []
        self._proposed = {self.bytes_of[t]: t for t in tokens if t not in set(own)}
        # All beginnings of proposable tokens: the token, or -1 where only longer ones go on.
        self._begins = {t[:n]: -1 for t in self._proposed for n in range(1, len(t))} | self._proposed

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the lowest-ranked pair first, leftmost first."""
        symbols = [self.byte_id[b] for b in word]
        rank_of, none = self._rank_of.get, self._no_rank
        ranks = [rank_of(pair, none) for pair in pairwise(symbols)]
        while ranks and (best := min(ranks)) != none:
            at = ranks.index(best)
            symbols[at : at + 2] = [self._made_by[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((symbols[at - 1], symbols[at]), none)
            if at < len(ranks):
                ranks[at] = rank_of((symbols[at], symbols[at + 1]), none)
        return symbols

    def merge_long(self, word: bytes) -> list[int]:
        """Exact merging of a long word, in time n log n: a heap of pairs over a linked list."""
        import heapq

        symbols = [self.byte_id[b] for b in word]
        n = len(symbols)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [
            (found[0], i, symbols[i], symbols[i + 1])
            for i in range(n - 1)
            if (found := self.merges.get((symbols[i], symbols[i + 1])))
        ]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue
            symbols[i], symbols[j] = self.merges[left, right][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (found := self.merges.get((symbols[a], symbols[b]))):
                    heapq.heappush(heap, (found[0], a, symbols[a], symbols[b]))
        return [s for s in symbols if s >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, end = [], 0, len(word)
        find = self._begins.get
        while at < end:
            token, size, tried = self.byte_id[word[at]], 1, 2
            while at + tried <= end and (found := find(word[at : at + tried])) is not None:
                if found >= 0:
                    token, size = found, tried
                tried += 1
            out.append(token)
            at += size
        return out

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether no merge would have crossed their border.

        A merge of a (at the border's left while its token forms) and b (at its
        right) happens if it ranks before the merges that swallow a and b; of
        equal ranks the one further left is first.
        """
        fine = np.ones(len(left), bool)
        if not len(self._keys):
            return fine
        right_spine, right_until = self._spine[2][left], self._until[2][left]
        left_spine, left_until = self._spine[1][right], self._until[1][right]
        for i in range(right_spine.shape[1]):
            rows_i = np.flatnonzero(fine & (right_spine[:, i] >= 0))
            for j in range(left_spine.shape[1]):
                rows = rows_i[(left_spine[rows_i, j] >= 0) & fine[rows_i]]
                if not len(rows):
                    break
                wanted = right_spine[rows, i].astype(np.int64) * self._size + left_spine[rows, j]
                at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
                rank = np.where(self._keys[at] == wanted, self._ranks[at], 1 << 31)
                fine[rows] &= ~((rank < right_until[rows, i]) & (rank <= left_until[rows, j]))
        return fine

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each pre-token."""
        proposals = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        border = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.empty(0, np.int64)
        pairs, which = np.unique(flat[border] * self._size + flat[border + 1], return_inverse=True)
        fine = np.empty(len(pairs), bool)
        for at in range(0, len(pairs), 65_536):
            part = pairs[at : at + 65_536]
            fine[at : at + 65_536] = self.compatible(part // self._size, part % self._size)
        for i in np.unique(owner[border[~fine[which]]]):
            word = words[i]
            proposals[i] = self.merge(word) if len(word) < 64 else self.merge_long(word)
        return proposals

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def forget(self) -> None:
        """Drop the remembered pre-tokens; only special tokens stay."""
        self.index = {t: i for i, t in enumerate(self.special)}
        numbers = [*self.special.values()]
        self._ids, self._used = np.zeros(1 << 12, np.int32), len(numbers)
        self._ids[: len(numbers)] = numbers
        self._begin, self._count = np.zeros(1 << 12, np.int64), np.ones(1 << 12, np.int32)
        self._begin[: len(numbers)] = np.arange(len(numbers))

    def cut(self, text: str) -> list[str]:
        """Pre-tokens of a text; special tokens are cut out first."""
        pattern = PRE_TOKENS_RECENT if recent(text) else PRE_TOKENS
        if not any(s in text for s in self.special):
            return pattern.findall(text)
        out, at = [], 0
        for found in self._specials.finditer(text):
            out += pattern.findall(text, at, found.start())
            out.append(found.group())
            at = found.end()
        return out + pattern.findall(text, at)

    def learn(self, words: Iterable[list[str]]) -> None:
        """Encode the pre-tokens that aren't remembered yet."""
        if len(self.index) > REMEMBERED:
            self.forget()
        new = list(set().union(*words).difference(self.index))
        if not new:
            return
        found = self.encode_words([w.encode() for w in new])
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        first, total = len(self.index), int(sizes.sum())
        self._ids = _grown(self._ids, self._used + total)
        self._begin, self._count = _grown(self._begin, first + len(new)), _grown(self._count, first + len(new))
        self._ids[self._used : self._used + total] = np.fromiter(chain.from_iterable(found), np.int32, total)
        self._count[first : first + len(new)] = sizes
        self._begin[first : first + len(new)] = self._used + np.cumsum(sizes) - sizes
        self._used += total
        self.index.update(zip(new, range(first, first + len(new)), strict=True))

    def _places(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def counts(self, words: list[str]) -> np.ndarray:
        """Number of tokens of each learned pre-token."""
        return self._count[self._places(words)]

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of learned pre-tokens, one after the other, and how many each has."""
        places = self._places(words)
        sizes = self._count[places].astype(np.int64)
        return self._ids[arrays.ragged(self._begin[places], sizes)], sizes


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


class Spelling:
    """Byte strings of all ids, joined for whole arrays of ids at once."""

    def __init__(self, strings: list[bytes]) -> None:
        self.size = np.fromiter(map(len, strings), np.int64, len(strings))
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The strings of `ids` one after the other, and where each begins and the last ends."""
        sizes = self.size[ids]
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        return self.data[arrays.ragged(self.begin[ids], sizes)].tobytes(), ends


@lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """The tokenizer of a file, once per worker."""
    return ByteBpe(path)


def slices(texts: list[str], limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` characters."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def encode_decode(
    docs: DataFrame,
    path: str,
    outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of `docs`: the id and the wanted outputs (names in OUTPUTS).

    `ids` are the tokens of the whole text, `decoded` the text they decode to,
    the digests are SHA-256 of the ids in decimal joined by commas and of the
    decoded bytes. No shuffle. A null text is an empty one, with no tokens;
    repeated rows give repeated results; other columns are not looked at; an
    empty table gives an empty result. The file at `path` must be readable on
    every executor.
    """
    schema = T.StructType(
        [T.StructField(id_column, docs.schema[id_column].dataType)] + [T.StructField(o, OUTPUTS[o]) for o in outputs]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, last in slices(texts):
                words = [bpe.cut(t) for t in texts[first:last]]
                bpe.learn(words)
                ids, sizes = bpe.ids(list(chain.from_iterable(words)))
                word_ends = np.cumsum([0, *map(len, words)])
                ends = np.append(0, np.cumsum(sizes))[word_ends]
                spans = list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
                columns = [_output(o, bpe, ids, spans) for o in outputs]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *columns], [id_column, *outputs]
                )

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def _output(name: str, bpe: ByteBpe, ids: np.ndarray, spans: list[tuple[int, int]]) -> pa.Array:
    if name == "n_tokens":
        return pa.array([b - a for a, b in spans], pa.int64())
    if name == "ids":
        return pa.array([ids[a:b] for a, b in spans], pa.list_(pa.int32()))
    joined, ends = (bpe.numerals if name == "ids_sha256" else bpe.pieces).join(ids)
    cut = [joined[ends[a] : ends[b]] for a, b in spans]
    if name == "ids_sha256":
        return pa.array([hashlib.sha256(c[:-1]).hexdigest() for c in cut], pa.string())
    texts = [c.decode("utf-8", "replace") for c in cut]
    if name == "decoded":
        return pa.array(texts, pa.string())
    return pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
