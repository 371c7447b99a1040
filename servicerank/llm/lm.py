"""Log probabilities of texts from a small causal self-attention model, beside word counts.

The model reads subword ids. One attention layer turns a window of ids into a
distribution over clusters of ids; within its cluster an id has its share behind
the id before it in the word, from counts of the whole training corpus. Windows
overlap, so that every id is scored once and sees ids before it; all windows of
many texts go through the layer together.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicerank.llm import arrays
from servicerank.llm.bpe import ByteBpe, load
from servicerank.llm.work import materialize

#: Ids in a window, those it scores, and the width of their vectors.
WINDOW, SCORED, WIDTH = 16, 12, 16
#: Ids of a window that are its context only.
LEAD = WINDOW - SCORED
#: Clusters of the commonest ids, of the other ones, and how many ids count as common.
CLUSTERS, OTHERS, COMMON = 56, 8, 1024
#: Rounds of the fit, each over its own share of the training texts, and windows in a step.
ROUNDS, BATCH = 4, 96
#: Ids of a shard, which one task steps through in a round, and the steps in which its moves are told.
SHARD, FIXED_POINT = 1 << 20, 2.0**20
#: Ids below which a corpus is gone through more than once, and how often at most.
STEADY, PASSES = 1 << 22, 8
#: Commonest pairs of ids inside words, whose counts are broadcast; the others' are joined by a shuffle. What shares
#: get from single ids.
PAIRS, BACK_OFF = 1 << 20, 2.0
#: Commonest words, whose counts are broadcast; the others' are joined by a shuffle.
FREQUENT = 1 << 18
#: Stands for the end of a text among the hashes of words.
END = np.array([0x5E17_0F7E_97C0_FFEE], np.uint64)
#: Words whose ids a worker remembers.
REMEMBERED = 800_000


class Shares:
    """log10 of an id's share of its cluster, given the id before it in the word, or that there is none."""

    def __init__(
        self, cluster: np.ndarray, counts: np.ndarray, pairs: np.ndarray, times: np.ndarray, below: np.ndarray | None = None
    ) -> None:
        """`pairs` are before * size + id in ascending order, where before is size at the start of a word.

        They are all pairs, unless the sums of all pairs' counts before * total +
        cluster are given as `below`; then `of` counts the others as none.
        """
        self.size, self.cluster, self.total = len(cluster), cluster, int(cluster.max(initial=0)) + 1
        self.back_off, weight = BACK_OFF, counts + 0.5
        self.alone = weight / np.bincount(cluster, weight)[cluster]
        self.pairs, self.times = pairs, times
        self.whole = below is None
        if below is None:
            below = np.zeros((self.size + 1) * self.total)
            np.add.at(below, pairs // self.size * self.total + cluster[pairs % self.size], times)
        self.below = below.astype(np.float32)

    def held(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pair of each id, `first` telling which begin a word, and its count, 0 for a pair that is not held."""
        ids = ids.astype(np.int64)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[first] = self.size
        wanted = before * self.size + ids
        if not len(self.pairs):
            return wanted, np.zeros(len(ids))
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return wanted, np.where(self.pairs[at] == wanted, self.times[at], 0)

    def logs(self, wanted: np.ndarray, times: np.ndarray) -> np.ndarray:
        """log10 of the shares of pairs that were counted so often."""
        ids = wanted % self.size
        below = self.below[wanted // self.size * self.total + self.cluster[ids]]
        return np.log10((times + self.back_off * self.alone[ids]) / (below + self.back_off))

    def of(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sums over words, each of `sizes` ids."""
        begins = np.cumsum(sizes) - sizes
        first = np.zeros(len(ids), bool)
        first[begins] = True
        return np.add.reduceat(self.logs(*self.held(ids, first)), begins)

    def of_texts(self, ids: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """Sums over texts of `sizes` ids each, and their pairs that are not held: text, pair, how often, and what the
        pair's id has by itself."""
        ids = ids.astype(np.int64)
        before = np.where(first, self.size, np.append(self.size, ids[:-1]))
        distinct, inverse = np.unique(before * self.size + ids, return_inverse=True)
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, distinct), len(self.pairs) - 1)
            times = np.where(self.pairs[at] == distinct, self.times[at], 0)
        else:
            times = np.zeros(len(distinct))
        text = np.repeat(np.arange(len(sizes)), sizes)
        sums = np.bincount(text, self.logs(distinct, times)[inverse], len(sizes))
        none = np.empty(0, np.int64)
        if self.whole:
            return sums, (none, none, none, np.empty(0))
        lost = np.flatnonzero((times == 0)[inverse])
        found, n = np.unique(text[lost] * len(distinct) + inverse[lost], return_counts=True)
        pair = distinct[found % len(distinct)]
        return sums, (found // len(distinct), pair, n, self.back_off * self.alone[pair % self.size])


class Segments:
    """Subword ids of words, by the words' hashes: the longest tokens first, from the left."""

    def __init__(self, bpe: ByteBpe) -> None:
        self.bpe, self.end = bpe, max(bpe.special.values(), default=len(bpe.bytes_of))
        self.size = max(len(bpe.bytes_of), self.end + 1)
        #: Ids with which a word begins, as no other id of a word holds a space, and the end.
        self.opens = np.zeros(self.size, bool)
        self.opens[[i for i, token in enumerate(bpe.bytes_of) if token[:1] == b" "]] = True
        self.opens[self.end] = True
        self.forget()

    def forget(self) -> None:
        self.places: dict[int, int] = {}
        self.ids, self.used = np.zeros(1 << 12, np.int32), 0
        self.begin, self.count = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def of(self, hashes: np.ndarray, first: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of distinct words: word i has the ids from begin[place], count[place] of them."""
        if len(self.places) > REMEMBERED:
            self.forget()
        listed = hashes.tolist()
        new = [i for i, h in enumerate(listed) if h not in self.places]
        if new:
            found = []
            for i in new:
                at = first[i]
                found.append(self.bpe.propose(b" " + data[starts[at] : ends[at]].lower()))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            have, total = len(self.places), int(sizes.sum())
            for name, need in (("ids", self.used + total), *((n, have + len(new)) for n in ("begin", "count"))):
                old = getattr(self, name)
                if need > len(old):
                    grown = np.zeros(max(need, 2 * len(old)), old.dtype)
                    grown[: len(old)] = old
                    setattr(self, name, grown)
            self.ids[self.used : self.used + total] = [x for ids in found for x in ids]
            self.begin[have : have + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.count[have : have + len(new)] = sizes
            self.used += total
            self.places.update((listed[i], have + j) for j, i in enumerate(new))
        return np.fromiter(map(self.places.__getitem__, listed), np.int64, len(listed))


_segments: dict[str, Segments] = {}


def segments(path: str) -> Segments:
    """One memory of words for each worker and vocabulary."""
    if path not in _segments:
        _segments.clear()
        _segments[path] = Segments(load(path))
    return _segments[path]


@dataclass
class Chunk:
    """Words of some texts: distinct hashes, each word's place among them, its text, and subword ids of the distinct."""

    hashes: np.ndarray
    inverse: np.ndarray
    owner: np.ndarray
    places: np.ndarray
    texts: int


def chunks(batch: pa.RecordBatch, column: int, known: Segments) -> Iterator[tuple[pa.RecordBatch, Chunk]]:
    data, offsets = arrays.utf8(batch.column(column))
    for first, last in arrays.chunks(offsets):
        part, begins = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        starts, ends, owner = arrays.words(part, begins)
        hashes = arrays.word_hashes(part, starts, ends, lower=True)
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        places = known.of(distinct, where, part.tobytes(), starts, ends)
        yield batch.slice(first, last - first), Chunk(distinct, inverse, owner, places, last - first)


def stored(ids: np.ndarray, begins: np.ndarray, size: int) -> pa.Array:
    """Streams as one binary value for each text, of two bytes an id if they fit."""
    kind = np.uint16 if size <= 1 << 16 else np.uint32
    width = np.dtype(kind).itemsize
    offsets = np.append(begins, len(ids)) * width
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(kind))]
    ).cast(pa.binary())


def read_streams(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What `streams` gives, from a column of `stored`."""
    data, offsets = arrays.flat(column)
    kind = np.uint16 if size <= 1 << 16 else np.uint32
    ids = np.frombuffer(data.tobytes(), kind).astype(np.int64)
    begins = offsets // np.dtype(kind).itemsize
    return ids, np.diff(begins), begins[:-1]


def parts_of(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about arrays.CHUNK bytes of a column."""
    _, offsets = arrays.flat(batch.column(column))
    for first, last in arrays.chunks(offsets):
        yield batch.slice(first, last - first)


def streams(chunk: Chunk, known: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' ids, each text ended by the end id, how many each has, and where each begins."""
    per_word = known.count[chunk.places][chunk.inverse]
    ids = known.ids[arrays.ragged(known.begin[chunk.places][chunk.inverse], per_word)]
    sizes = np.bincount(chunk.owner, per_word, chunk.texts).astype(np.int64) + 1
    begins = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), known.end, np.int64)
    keep = np.ones(len(out), bool)
    keep[begins + sizes - 1] = False
    out[keep] = ids
    return out, sizes, begins


@dataclass
class AttentionModel:
    """Weights of the layer, the cluster of each id, and the ids' shares of their clusters."""

    weights: dict[str, np.ndarray]
    cluster: np.ndarray
    shares: Shares | None
    start: int
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def windows(self, ids: np.ndarray, sizes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
        """Input ids of all windows (the id before each scored one, and its context), which of them exist, and the scored places.

        Windows are laid out from each text's own beginning, so a score does not
        depend on the texts around. Row by row, the scored places that exist are
        the ids in their order.
        """
        count = -(-sizes // SCORED)
        text = np.repeat(np.arange(len(sizes)), count)
        number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        exists = np.empty((len(text), WINDOW), bool)
        exists[:, :LEAD] = (number > 0)[:, None]
        here = exists[:, LEAD:]
        np.less(np.arange(SCORED), (sizes[text] - number * SCORED)[:, None], out=here)
        before = np.append(self.start, ids[:-1])
        before[begins[sizes > 0]] = self.start
        inputs = np.full(exists.shape, self.start, np.int32)
        inputs[:, LEAD:][here] = before[: len(ids)]
        inputs[1:, :LEAD] = np.where((number > 0)[1:, None], inputs[:-1, SCORED:], self.start)
        at = np.zeros(exists.shape, np.int32 if len(ids) < 1 << 31 else np.int64)
        at[:, LEAD:][here] = np.arange(len(ids))
        return inputs, exists, at

    def forward(self, inputs: np.ndarray, exists: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.weights, len(inputs)
        x = np.take(w["embed"], inputs, axis=0)
        x += w["place"]
        # What scored places hold, and beside it what they see.
        scored = np.empty((n, SCORED, 2 * WIDTH), x.dtype)
        scored[..., :WIDTH] = x[:, LEAD:]
        # Flat matrices: one large product each instead of one for each window.
        flat = scored.reshape(-1, 2 * WIDTH)
        query = (flat[:, :WIDTH] @ w["query"]).reshape(n, SCORED, WIDTH)
        key_value = (x.reshape(-1, WIDTH) @ w["key_value"]).reshape(n, WINDOW, 2 * WIDTH)
        logits = query @ key_value[..., :WIDTH].transpose(0, 2, 1)
        np.clip(logits, -30, 30, out=logits)
        np.exp(logits, out=logits)
        # Places behind a text's end are seen by none that exist, those before its beginning by its first window.
        logits *= CAUSAL
        logits[~exists[:, 0], :, :LEAD] = 0
        logits *= (1 / (logits.reshape(-1, WINDOW) @ ONES[:WINDOW])).reshape(n, SCORED, 1)
        np.matmul(logits, key_value[..., WIDTH:], out=scored[..., WIDTH:])
        hidden = flat @ w["keep_mix"]
        hidden += w["bias"]
        np.tanh(hidden, out=hidden)
        out = hidden @ w["out"]
        out += w["out_bias"]
        # As hidden numbers are below 1, the weights bound what comes out.
        if (np.abs(w["out"]).sum(0) + np.abs(w["out_bias"])).max() > 60:
            np.clip(out, -60, 60, out=out)
        return dict(x=x, scored=flat, query=query, key_value=key_value, attention=logits, hidden=hidden, out=out)

    def score(self, ids: np.ndarray, sizes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """log10 of the probability of the clusters of each text's ids."""
        inputs, exists, at = self.windows(ids, sizes, begins)
        targets, here = self.cluster[ids][at[:, LEAD:]], exists[:, LEAD:]
        found = np.empty(here.shape, np.float32)
        # Until a process has multiplied by more than 32 rows, OpenBLAS took 3.7 times as long for those of 32 by 64.
        _SQUARE @ _SQUARE
        for first in range(0, len(found), 256):
            part = slice(first, first + 256)
            out = self.forward(inputs[part], exists[part])["out"]
            chosen = out[np.arange(len(out)), targets[part].ravel()]
            np.exp(out, out=out)
            found[part] = (chosen - np.log(out @ ONES[: out.shape[1]])).reshape(-1, SCORED)
        sums = np.add.reduceat(found[here].astype(np.float64), begins) if len(begins) else np.zeros(0)
        return sums / np.log(10)


#: Scored place i of a window sees its places up to WINDOW - SCORED + i.
CAUSAL = np.where(
    np.arange(WINDOW)[None, :] <= np.arange(LEAD, WINDOW)[:, None], np.float32(1), np.float32(0)
)
#: Products with these are sums over rows' numbers.
ONES = np.ones(max(WINDOW, CLUSTERS + OTHERS), np.float32)
_SQUARE = np.ones((64, 64), np.float32)


def common_ids(counts: np.ndarray) -> np.ndarray:
    """The COMMON commonest ids that occur."""
    common = np.argsort(-counts, kind="stable")[:COMMON]
    return common[counts[common] > 0]


def following(ids: np.ndarray, common: np.ndarray, size: int) -> np.ndarray:
    """How often each common id follows each; the last row and column are those of all other ids."""
    rank, n = np.full(size, len(common)), len(common) + 1
    rank[common] = np.arange(len(common))
    return np.bincount(rank[ids[:-1]] * n + rank[ids[1:]], minlength=n * n).reshape(n, n)


def corpus_following(texts: DataFrame, size: int, common: np.ndarray) -> np.ndarray:
    """`following` over all ids of the texts (column `ids`), whose first ids follow an end.

    Tasks add up, then groups of a row each.
    """
    n = len(common) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n), np.int64)
        for batch in batches:
            for part in parts_of(batch, 0):
                ids, _, _ = read_streams(part.column(0), size)
                # Every text ends with the end.
                total += following(np.append(ids[-1:], ids), common, size)
        rows = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array([total[i].tobytes() for i in rows], pa.binary())], ["rank", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.int64) for b in table["counts"].to_pylist())
        return pa.table({"rank": table["rank"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    out, schema = np.zeros((n, n), np.int64), "rank long, counts binary"
    for row in texts.select("ids").mapInArrow(count, schema).groupBy("rank").applyInArrow(add, schema).collect():
        out[row["rank"]] = np.frombuffer(row["counts"], np.int64)
    return out


def clusters(pairs: np.ndarray, common: np.ndarray, size: int, seed: int = 3) -> np.ndarray:
    """A cluster for every id: common ids by what stands before and after them, the others by their number."""
    rng = np.random.default_rng(seed)
    out = CLUSTERS + np.arange(size) % OTHERS
    if not len(common):
        return out
    pairs = pairs.astype(np.float32)
    near = np.concatenate([pairs[:-1], pairs.T[:-1]], 1)
    near = np.sqrt(near / np.maximum(near.sum(1, keepdims=True), 1))
    vectors = near @ rng.normal(0, 1, (near.shape[1], 96)).astype(np.float32)
    vectors = near @ np.linalg.qr(near.T @ np.linalg.qr(vectors)[0])[0][:, :48]
    centres = vectors[np.arange(min(CLUSTERS, len(vectors)))]
    nearest = np.zeros(len(vectors), np.int64)
    for _ in range(15):
        nearest = (((vectors**2).sum(1)[:, None] - 2 * vectors @ centres.T) + (centres**2).sum(1)).argmin(1)
        for c in np.unique(nearest):
            centres[c] = vectors[nearest == c].mean(0)
    out[common] = nearest
    return out


def untrained(cluster: np.ndarray, counts: np.ndarray, shares: Shares | None, start: int, rng: np.random.Generator) -> AttentionModel:
    """A model with random weights, whose clusters have their shares of the counts."""
    size, total = len(counts), CLUSTERS + OTHERS
    weight = counts + 0.5

    def normal(*shape: int, scale: float = 1.0) -> np.ndarray:
        return rng.normal(0, scale / np.sqrt(shape[0]), shape).astype(np.float32)

    drawn = {
        "embed": rng.normal(0, 0.3, (size, WIDTH)).astype(np.float32), "place": rng.normal(0, 0.1, (WINDOW, WIDTH)).astype(np.float32),
        "query": normal(WIDTH, WIDTH), "key": normal(WIDTH, WIDTH), "value": normal(WIDTH, WIDTH),
        "keep": normal(WIDTH, 2 * WIDTH), "mix": normal(WIDTH, 2 * WIDTH), "bias": np.zeros(2 * WIDTH, np.float32),
        "out": normal(2 * WIDTH, total), "out_bias": np.log(np.bincount(cluster, weight, total) / weight.sum() + 1e-9).astype(np.float32),
    }
    # What is multiplied with the same vectors, or added up, is one matrix.
    weights = {k: drawn[k] for k in ("embed", "place", "query", "bias", "out", "out_bias")}
    weights["key_value"] = np.concatenate([drawn["key"], drawn["value"]], 1)
    weights["keep_mix"] = np.concatenate([drawn["keep"], drawn["mix"]])
    return AttentionModel(weights, cluster, shares, start)


class Adam:
    """Steps on a model's weights in place; how many windows it has seen, and how often each id in them."""

    def __init__(self, model: AttentionModel) -> None:
        self.model, self.step, self.windows = model, 0, 0
        size = len(model.weights["embed"])
        self.seen = np.zeros(size, np.int64)
        #: Ids as they are sorted fastest: by their digits, if there are two.
        self.digits = np.uint16 if size <= 1 << 16 else np.int64
        # All but the embeddings are parts of one array, which takes a step at once.
        self.names = [k for k in model.weights if k != "embed"]
        self.rest = np.concatenate([model.weights[k].ravel() for k in self.names])
        ends = np.cumsum([model.weights[k].size for k in self.names])
        for k, part in zip(self.names, np.split(self.rest, ends[:-1]), strict=True):
            model.weights[k] = part.reshape(model.weights[k].shape)
        self.moments = np.zeros((2, size, WIDTH), np.float32)
        self.rest_moments = np.zeros((2, len(self.rest)), np.float32)

    def on(self, inputs: np.ndarray, exists: np.ndarray, targets: np.ndarray, rate: float) -> None:
        """One step on the given windows and the clusters of their scored places."""
        gradients = _gradients(self.model, inputs, exists, targets, exists[:, LEAD:])
        # Gradients of the embeddings are added up for the ids of the windows only.
        flat = inputs.ravel().astype(self.digits)
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        begins = np.ones(len(flat), bool)
        np.not_equal(ordered[1:], ordered[:-1], out=begins[1:])
        first = np.flatnonzero(begins)
        touched = ordered[first].astype(np.int64)
        moved = np.add.reduceat(np.take(gradients["inputs"], order, axis=0), first, axis=0)
        self.step += 1
        self.windows += len(inputs)
        self.seen[touched] += np.diff(np.append(first, len(flat)))
        held = [np.take(m, touched, axis=0) for m in self.moments]
        embed = self.model.weights["embed"]
        embed[touched] = np.take(embed, touched, axis=0) - self.moves(moved, *held, rate)
        for m, now in zip(self.moments, held, strict=True):
            m[touched] = now
        rest = np.concatenate([gradients[k].ravel() for k in self.names])
        self.rest -= self.moves(rest, *self.rest_moments, rate)

    def moves(self, gradient: np.ndarray, mean: np.ndarray, square: np.ndarray, rate: float) -> np.ndarray:
        """How far weights go against their gradient, whose moments are kept up in place."""
        fast, slow = 1 - 0.9**self.step, 1 - 0.99**self.step
        mean += np.float32(0.1) * (gradient - mean)
        gradient *= gradient
        gradient -= square
        gradient *= np.float32(0.01)
        square += gradient
        scale = np.sqrt(square)
        scale *= np.float32(slow**-0.5)
        scale += np.float32(1e-8)
        out = mean * np.float32(rate / fast)
        out /= scale
        return out


def fit(
    ids: np.ndarray,
    sizes: np.ndarray,
    counts: np.ndarray,
    pairs: np.ndarray,
    times: np.ndarray,
    start: int,
    epochs: int = 1,
    batch: int = BATCH,
    seed: int = 5,
) -> AttentionModel:
    """Fit the layer on texts' ids in this process; counts of ids and pairs are those of the whole training corpus."""
    rng = np.random.default_rng(seed)
    common = common_ids(np.bincount(ids, minlength=len(counts)))
    cluster = clusters(following(ids, common, len(counts)), common, len(counts))
    model = untrained(cluster, counts, Shares(cluster, counts, pairs, times), start, rng)
    begins = np.cumsum(sizes) - sizes
    inputs, exists, at = model.windows(ids, sizes, begins)
    targets = cluster[ids][at[:, LEAD:]]
    adam, steps = Adam(model), epochs * -(-len(inputs) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(inputs))
        for first in range(0, len(order), batch):
            rows = order[first : first + batch]
            adam.on(inputs[rows], exists[rows], targets[rows], 4e-3 * (1 - 0.95 * (adam.step + 1) / steps))
    return model


def corpus_fit(texts: DataFrame, model: AttentionModel, total: int, rounds: int = ROUNDS) -> AttentionModel:
    """The model fitted on all of the texts (_id, ids), `total` ids, each read whole in one of the rounds.

    The texts of a round are dealt into shards of about SHARD ids by the hash of
    what they hold, and each shard steps through its texts, in the order of
    another hash, from the same weights; then each row of weights moves by the
    shards' mean, weighted by the windows they saw, or for an embedding by how
    often they saw the id. So the weights follow from the texts, not from how
    the table is cut into partitions, and what comes back to the driver has the
    size of the weights, whatever the corpus.
    """
    names = list(model.weights)
    size = len(model.weights["embed"])
    # All weights as rows of WIDTH numbers: the embeddings, then the others.
    ends = np.cumsum([model.weights[k].size // WIDTH for k in names])
    columns = [f"_{j}" for j in range(WIDTH)]
    sc = texts.sparkSession.sparkContext
    shards = max(1, -(-total // (rounds * SHARD)))
    content = [F.col("_id").cast("string"), F.col("ids")]
    dealt = texts.select(
        F.pmod(F.xxhash64(*content), F.lit(rounds)).alias("_round"),
        F.pmod(F.xxhash64(*content, F.lit(1)), F.lit(shards)).alias("_shard"),
        F.xxhash64(*content, F.lit(2)).alias("_order"),
        "ids",
    )

    def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([weights[k].reshape(-1, WIDTH) for k in names])

    def stepping(shared: Broadcast, rate: float) -> Callable[[pa.Table], pa.Table]:
        def run(table: pa.Table) -> pa.Table:
            start = shared.value
            adam = Adam(replace(start, weights={k: v.copy() for k, v in start.weights.items()}))
            rng = np.random.default_rng(5)
            ordered = table.select(["_order", "ids"]).sort_by([("_order", "ascending"), ("ids", "ascending")])
            for batch in ordered.select(["ids"]).combine_chunks().to_batches():
                for part in parts_of(batch, 0):
                    ids, sizes, begins = read_streams(part.column(0), size)
                    inputs, exists, at = start.windows(ids, sizes, begins)
                    targets = start.cluster[ids][at[:, LEAD:]]
                    order = rng.permutation(len(inputs))
                    for first in range(0, len(order), BATCH):
                        rows = order[first : first + BATCH]
                        adam.on(inputs[rows], exists[rows], targets[rows], rate)
            weight = np.append(adam.seen, np.full(ends[-1] - size, adam.windows)).astype(np.float64)
            rows = np.flatnonzero(weight)
            moved = (flat(adam.model.weights)[rows] - flat(start.weights)[rows]) * weight[rows][:, None]
            # Whole numbers add up to the same sum in any order.
            moved = np.rint(moved * FIXED_POINT)
            return pa.table({"row": rows, "weight": weight[rows], **{c: np.ascontiguousarray(m) for c, m in zip(columns, moved.T, strict=True)}})

        return run

    # A small corpus is gone through several times, so that the layer makes some thousand steps.
    steps = rounds * int(np.clip(STEADY // max(1, total), 1, PASSES))
    for number in range(steps):
        shared, rate = sc.broadcast(model), 4e-3 * (1 - 0.95 * (number + 0.5) / steps)
        moves = dealt.filter(F.col("_round") == number % rounds).groupBy("_shard").applyInArrow(
            stepping(shared, rate), f"row long, weight double, {', '.join(f'{c} double' for c in columns)}"
        )
        sums = moves.groupBy("row").agg(F.sum("weight").alias("weight"), *(F.sum(c).alias(c) for c in columns)).toArrow()
        weights = flat(model.weights)
        mean = np.stack([np.asarray(sums[c], np.float64) for c in columns], 1) / (FIXED_POINT * np.asarray(sums["weight"], np.float64)[:, None])
        weights[np.asarray(sums["row"], np.int64)] += mean.astype(np.float32)
        parts = np.split(weights, ends[:-1])
        model = replace(model, weights={k: p.reshape(model.weights[k].shape) for k, p in zip(names, parts, strict=True)})
        shared.unpersist()
    return model


def _gradients(
    model: AttentionModel, inputs: np.ndarray, exists: np.ndarray, targets: np.ndarray, here: np.ndarray
) -> dict[str, np.ndarray]:
    """Gradients of the mean negative log probability of the targets' clusters; `inputs` are those of the places' vectors."""
    w, f = model.weights, model.forward(inputs, exists)
    n, scored = len(inputs), f["scored"]
    error, weight = f["out"], here.ravel() / np.float32(max(1, here.sum()))
    np.exp(error, out=error)
    error *= (weight / (error @ ONES[: error.shape[1]]))[:, None]
    error[np.arange(len(error)), targets.ravel()] -= weight
    hidden = error @ w["out"].T
    hidden *= 1 - f["hidden"] ** 2
    moved_scored = hidden @ w["keep_mix"].T
    to_seen = moved_scored[:, WIDTH:].reshape(n, SCORED, WIDTH)
    attention = to_seen @ f["key_value"][..., WIDTH:].transpose(0, 2, 1)
    attention -= ((f["attention"] * attention).reshape(-1, WINDOW) @ ONES[:WINDOW]).reshape(n, SCORED, 1)
    attention *= f["attention"]
    query = (attention @ f["key_value"][..., :WIDTH]).reshape(-1, WIDTH)
    key_value = np.empty((n, WINDOW, 2 * WIDTH), query.dtype)
    np.matmul(attention.transpose(0, 2, 1), f["query"], out=key_value[..., :WIDTH])
    np.matmul(f["attention"].transpose(0, 2, 1), to_seen, out=key_value[..., WIDTH:])
    key_value = key_value.reshape(-1, 2 * WIDTH)
    moved_scored[:, :WIDTH] += query @ w["query"].T
    moved = (key_value @ w["key_value"].T).reshape(n, WINDOW, WIDTH)
    moved[:, LEAD:] += moved_scored[:, :WIDTH].reshape(n, SCORED, WIDTH)
    return {
        "inputs": moved.reshape(-1, WIDTH), "place": moved.sum(0), "query": scored[:, :WIDTH].T @ query,
        "key_value": f["x"].reshape(-1, WIDTH).T @ key_value, "keep_mix": scored.T @ hidden, "bias": hidden.sum(0),
        "out": f["hidden"].T @ error, "out_bias": error.sum(0),
    }


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that nothing is learned from: the CRC-32 of the id as text leaves 1 modulo 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(5)) == 1, F.lit(False))


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(word, spelled, c): hash, bytes and count of all words of the texts, and of their ends.

    Tasks add up their own words before the shuffle, in parts of bounded size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def added() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            hashes, times, spelled = (np.concatenate(parts) for parts in zip(*held, strict=True))
            keys, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            return keys, np.bincount(inverse, times).astype(np.int64), spelled[where]

        def rows(part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
            keys, times, spelled = part
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(spelled, pa.binary()), pa.array(times)], ["word", "spelled", "c"]
            )

        for batch in batches:
            data, offsets = arrays.utf8(batch.column(0))
            for first, last in arrays.chunks(offsets):
                part = data[offsets[first] : offsets[last]]
                starts, ends, _ = arrays.words(part, offsets[first : last + 1] - offsets[first])
                hashes = arrays.word_hashes(part, starts, ends, lower=True)
                keys, where, times = np.unique(hashes, return_index=True, return_counts=True)
                text = part.tobytes().lower()
                spelled = np.empty(len(keys) + 1, object)
                spelled[:-1] = [text[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
                spelled[-1] = b""
                held.append((np.append(keys, END), np.append(times, last - first), spelled))
                if sum(len(h[0]) for h in held) > 1 << 19:
                    held = [added()]
                    if len(held[0][0]) > 1 << 18:
                        yield rows(held.pop())
        if held:
            yield rows(added())

    parts = texts.mapInArrow(count, "word long, spelled binary, c long")
    return materialize(parts.groupBy("word", "spelled").agg(F.sum("c").alias("c")), "word-counts")


def pair_counts(words: DataFrame, path: str) -> DataFrame:
    """(pair, c) of the ids inside words, each with the id before it, over the whole training corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        known = Segments(bpe)
        for batch in batches:
            found = [bpe.propose(b" " + w) if w else [known.end] for w in batch.column(0).to_pylist()]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            if not len(sizes):
                continue
            ids = np.array([i for w in found for i in w], np.int64)
            before = np.empty_like(ids)
            before[1:] = ids[:-1]
            before[np.cumsum(sizes) - sizes] = known.size
            pairs, inverse = np.unique(before * known.size + ids, return_inverse=True)
            times = np.bincount(inverse, np.repeat(np.asarray(batch.column(1)), sizes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "c"])

    rows = words.select("spelled", "c").mapInArrow(count, "pair long, c long")
    return materialize(rows.groupBy("pair").agg(F.sum("c").alias("c")), "pair-counts")


def sums_below(pairs: DataFrame, cluster: np.ndarray) -> np.ndarray:
    """The pairs' counts by the id before and the cluster: as many numbers as the vocabulary and the clusters give."""
    size, total = len(cluster), int(cluster.max(initial=0)) + 1

    def at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = np.asarray(batch.column(0), np.int64)
            place = pair // size * total + cluster[pair % size]
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1)], ["place", "c"])

    sums = pairs.select("pair", "c").mapInArrow(at, "place long, c long").groupBy("place").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros((size + 1) * total)
    out[np.asarray(sums["place"], np.int64)] = np.asarray(sums["c"])
    return out


def commonest(counts: DataFrame, limit: int) -> DataFrame:
    """Rows with the largest `c`, at most `limit`: all above a bound that a histogram of at most some 1,000 bins gives."""
    grade = F.floor(F.log2("c") * 16)
    rows = counts.groupBy(grade.alias("grade")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("grade")).collect()
    least, total = None, 0
    for row in rows:
        total += row.n
        if total > limit:
            break
        least = row.grade
    return counts.limit(0) if least is None else counts.filter(grade >= least)


def score(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", sample: int | None = None
) -> DataFrame:
    """One row per row of `docs`: id, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    Tokens are lower-case (A-Z) words and one end. `base_score` sums
    log10((c + 0.5) / (N + 0.5 (V + 1))) with counts over all training texts;
    `score` is the attention model's log10 probability of the text. Words are
    counted by 64-bit hashes. The model is fitted on all training texts; with
    `sample`, on so many, those with the smallest hashes of their ids. How the
    table is cut into partitions makes no difference. Every text's subword ids
    are made once and stored, for counting, fitting and scoring.

    Null texts are empty and have one token, their end. Repeated rows are scored
    each. Rows without an id are training texts. Other columns are not looked
    at; an empty table gives an empty result. Runs jobs when called.
    """
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"), held_out(id_column).alias("_held_out"))
    training = rows.filter("NOT _held_out")
    spelled = corpus_counts(training.select("_text"))
    counts = spelled.select("word", "c")
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = total.n or 0, total.v
    known = segments(path)
    pairs = pair_counts(spelled, path)
    of_ids = np.zeros(known.size, np.int64)
    # As many rows as the vocabulary has ids, and as PAIRS says.
    for row in pairs.groupBy((F.col("pair") % known.size).alias("id")).agg(F.sum("c").alias("c")).collect():
        of_ids[row.id] = row.c
    # The end's pair is always held, since it is no word's; `rest` are the pairs that are not.
    least = commonest(pairs, PAIRS).agg(F.min("c").alias("c")).first().c
    hold = F.col("pair") == known.size * known.size + known.end
    hold = hold if least is None else hold | (F.col("c") >= least)
    kept, rest = pairs.filter(hold).toArrow().sort_by("pair"), pairs.filter(~hold)
    whole = rest.isEmpty()
    frequent = commonest(counts, FREQUENT).toArrow()
    words, known_counts = np.asarray(frequent["word"], np.int64).view(np.uint64), np.asarray(frequent["c"], np.int64)
    order = np.argsort(words)
    words, known_counts = words[order], known_counts[order]

    divisor = n + 0.5 * (v + 1)
    end = counts.filter(F.col("word") == int(END.view(np.int64)[0])).first()
    ends = end.c if end else 0
    shared = docs.sparkSession.sparkContext.broadcast((words, known_counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known_counts = shared.value
        known = segments(path)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        logs = np.log10((known_counts + 0.5) / divisor)

        def lookup(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not len(words):
                return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
            at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
            return at, words[at] == hashes

        for batch in batches:
            for part, chunk in chunks(batch, 1, known):
                size = part.num_rows
                at, hit = lookup(chunk.hashes)
                value = np.where(hit, logs[at] if len(logs) else 0, 0)[chunk.inverse]
                base = np.bincount(chunk.owner, value, size).astype(np.float64)
                seen = np.bincount(chunk.owner, hit[chunk.inverse], size).astype(np.int64)
                base += np.log10((ends + 0.5) / divisor)
                seen += int(ends > 0)
                tokens = np.bincount(chunk.owner, minlength=size) + 1
                ids, _, begins = streams(chunk, known)
                key = number + np.arange(size)
                number += size
                none = np.zeros(size, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key), part.column(0), part.column(2), pa.array(none), pa.array(tokens), pa.array(seen), pa.array(base),
                        stored(ids, begins, known.size),
                    ],
                    NAMES,
                )
                # Words that aren't frequent go on to the shuffle, once for each text.
                rare = np.flatnonzero(~hit[chunk.inverse])
                pairs, times = np.unique(chunk.owner[rare] * (len(hit) + 1) + chunk.inverse[rare], return_counts=True)
                owner, word = pairs // (len(hit) + 1), chunk.hashes[pairs % (len(hit) + 1)]
                empty = pa.nulls(len(pairs), part.column(0).type)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[owner]), empty, pa.nulls(len(pairs), pa.bool_()), pa.array(word.view(np.int64)), pa.array(times),
                        pa.nulls(len(pairs), pa.int64()), pa.nulls(len(pairs), pa.float64()), pa.nulls(len(pairs), pa.binary()),
                    ],
                    NAMES,
                )

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"key long, id {kind}, held_out boolean, word long, n long, known long, base double, ids binary"
    out = materialize(rows.select("_id", "_text", "_held_out").mapInArrow(run, schema), "text-ids")

    # The layer, from the stored ids.
    streamed = out.filter("ids IS NOT NULL")
    learned = streamed.filter("NOT held_out").select(F.col("id").alias("_id"), "ids")
    if sample is not None:
        chosen = learned.select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(sample)
        learned = learned.join(F.broadcast(chosen), "_id").dropDuplicates(["_id"])
    common = common_ids(of_ids)
    cluster = clusters(corpus_following(learned, known.size, common), common, known.size)
    model = corpus_fit(learned, untrained(cluster, of_ids, None, known.end, np.random.default_rng(5)), int(of_ids.sum()))
    below = None if whole else sums_below(pairs, cluster)
    model.shares = Shares(cluster, of_ids, np.asarray(kept["pair"], np.int64), np.asarray(kept["c"], np.int64), below)
    fitted, size, opens = docs.sparkSession.sparkContext.broadcast(model), known.size, known.opens

    def score_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fitted.value
        for batch in batches:
            for part in parts_of(batch, 1):
                ids, sizes, begins = read_streams(part.column(1), size)
                share, (text, pair, times, weight) = model.shares.of_texts(ids, opens[ids], sizes)
                key, none = np.asarray(part.column(0)), pa.nulls
                score_ = model.score(ids, sizes, begins) + share
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(score_), none(n, pa.int64()), none(n, pa.int64()), none(n, pa.float64())], SCORED_NAMES
                )
                # Pairs that aren't held go on to the shuffle, with their id's weight.
                n = len(pair)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[text]), none(n, pa.float64()), pa.array(pair), pa.array(times), pa.array(weight)], SCORED_NAMES
                )

    schema = "key long, score double, pair long, n long, weight double"
    scores = materialize(streamed.select("key", "ids").mapInArrow(score_streams, schema), "text-scores")
    unheld = scores.filter("pair IS NOT NULL").join(rest, "pair")
    per_share = unheld.groupBy("key").agg(F.sum(F.col("n") * F.log10(1 + F.col("c") / F.col("weight"))).alias("rare_share"))
    rare = out.filter("ids IS NULL").select("key", "word", "n").join(counts, "word", "left")
    per_text = rare.groupBy("key").agg(
        F.sum(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(float(divisor)))).alias("rare_base"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
    )
    scored = streamed.drop("ids").join(scores.filter("score IS NOT NULL").select("key", "score"), "key").join(per_text, "key", "left")
    scored = scored.withColumn("rare_share", F.lit(0.0)) if whole else scored.join(per_share, "key", "left")
    return scored.select(
        F.col("id").alias(id_column),
        "held_out",
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(int(n)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_share", F.lit(0.0))).alias("score"),
    )


NAMES = ["key", "id", "held_out", "word", "n", "known", "base", "ids"]
SCORED_NAMES = ["key", "score", "pair", "n", "weight"]
