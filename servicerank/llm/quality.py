"""Document quality from attention over passages (multiple-instance learning).

A document is a bag of passages. Each passage is encoded, gated attention
weighs the passages, and the weighted mean is scored. Only documents carry
labels; the weights of passages are learned from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicerank.llm import arrays

#: Words in a passage.
PASSAGE = 128
#: Buckets of hashed words, hidden units, attention units.
BUCKETS, HIDDEN, GATES = 64, 32, 16
#: Labelled documents that the model is fitted on: those with the smallest hash of their id.
SAMPLE = 6_000

# Bytes by kind: every ASCII punctuation mark, space and line end on its own, letters, digits, others.
_KIND = np.zeros(256, np.int64)
_KIND[128:], _KIND[65:91], _KIND[97:123], _KIND[48:58] = 1, 2, 3, 4
_own = [32, 9, 10, 13, *(b for b in range(33, 127) if not chr(b).isalnum())]
_KIND[_own] = np.arange(5, 5 + len(_own))
KINDS = 5 + len(_own)
WIDTH = KINDS + 6 + BUCKETS


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a chunk of texts, and the text of each; a text has one at least."""
    texts = len(offsets) - 1
    starts, ends, owner = arrays.words(data, offsets)
    per_text = np.bincount(owner, minlength=texts)
    first_word = np.cumsum(per_text) - per_text
    bags = np.maximum(1, -(-per_text // PASSAGE))
    first_bag = np.cumsum(bags) - bags
    total = int(bags.sum())
    text_of = np.repeat(np.arange(texts), bags)
    bag = first_bag[owner] + (np.arange(len(starts)) - first_word[owner]) // PASSAGE

    # A passage's bytes run from its first word to the next passage, or to the end of the text.
    begins = offsets[:-1][text_of].copy()
    later = np.flatnonzero(bag[1:] != bag[:-1]) + 1 if len(bag) else np.empty(0, np.int64)
    inner = later[owner[later] == owner[later - 1]]
    begins[bag[inner]] = starts[inner]
    sizes = np.diff(np.append(begins, len(data)))
    of_byte = np.repeat(np.arange(total), sizes)
    kinds = np.bincount(of_byte * KINDS + _KIND[data], minlength=total * KINDS).reshape(total, KINDS)

    hashes = arrays.word_hashes(data, starts, ends, lower=True)
    n_words = np.bincount(bag, minlength=total)

    def repeated(keys: np.ndarray, of_bag: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Share of each passage's keys that stood in the text before."""
        keys = arrays.mixed(keys ^ arrays.mixed(owner.astype(np.uint64)))
        first = np.zeros(len(keys), bool)
        first[np.unique(keys, return_index=True)[1]] = True
        counted = np.maximum(1, np.bincount(of_bag, minlength=total))
        return np.bincount(of_bag[~first], minlength=total) / counted

    triples = arrays.window_hashes(arrays.prefix_hashes(hashes), 3)
    whole = owner[2:] == owner[:-2] if len(triples) else np.empty(0, bool)
    features = np.zeros((total, WIDTH), np.float32)
    features[:, :KINDS] = kinds / np.maximum(1, sizes)[:, None]
    lengths = np.bincount(bag, weights=ends - starts, minlength=total)
    features[:, KINDS] = lengths / np.maximum(1, n_words) / 10
    features[:, KINDS + 1] = np.log1p(n_words)
    features[:, KINDS + 2] = np.log1p(per_text[text_of])
    features[:, KINDS + 3] = repeated(hashes, bag, owner)
    features[:, KINDS + 4] = repeated(triples[whole], bag[: len(whole)][whole], owner[: len(whole)][whole])
    features[:, KINDS + 5] = n_words == 0
    buckets = (hashes >> np.uint64(8)).astype(np.int64) % BUCKETS
    bagged = np.bincount(bag * BUCKETS + buckets, minlength=total * BUCKETS).reshape(total, BUCKETS)
    features[:, KINDS + 6 :] = np.sqrt(bagged / np.maximum(1, n_words)[:, None])
    return features, text_of


@dataclass
class QualityModel:
    """Weights, and the mean and spread of each feature."""

    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, text_of: np.ndarray, texts: int) -> dict[str, np.ndarray]:
        w = self.weights
        x = np.clip((x - self.mean) / self.spread, -8, 8)
        hidden = np.tanh(x @ w["encode"] + w["encode_bias"])
        tanh = np.tanh(hidden @ w["tanh"])
        gate = 1 / (1 + np.exp(-(hidden @ w["gate"])))
        logits = (tanh * gate) @ w["attend"]
        most = np.full(texts, -np.inf, logits.dtype)
        np.maximum.at(most, text_of, logits)
        attention = np.exp(logits - most[text_of])
        attention /= np.bincount(text_of, attention, texts)[text_of]
        pooled = np.zeros((texts, HIDDEN), np.float64)
        np.add.at(pooled, text_of, attention[:, None] * hidden)
        margin = pooled @ w["score"] + w["score_bias"]
        return dict(x=x, hidden=hidden, tanh=tanh, gate=gate, attention=attention, pooled=pooled, margin=margin)

    def score(self, x: np.ndarray, text_of: np.ndarray, texts: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x, text_of, texts)["margin"], -50, 50)))


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 25, batch: int = 128, seed: int = 1) -> QualityModel:
    """Fit by Adam on the logistic loss of the documents' labels."""
    rng = np.random.default_rng(seed)
    everything = np.concatenate(bags) if bags else np.zeros((1, WIDTH))
    mean, spread = everything.mean(0), everything.std(0) + 1e-3

    def start(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    weights = {
        "encode": start(WIDTH, HIDDEN), "encode_bias": np.zeros(HIDDEN),
        "tanh": start(HIDDEN, GATES), "gate": start(HIDDEN, GATES), "attend": start(GATES),
        "score": start(HIDDEN), "score_bias": np.zeros(()),
    }
    model = QualityModel(mean, spread, weights)
    momentum = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            x = np.concatenate([bags[i] for i in chosen])
            text_of = np.repeat(np.arange(len(chosen)), [len(bags[i]) for i in chosen])
            gradients = _gradients(model, x, text_of, labels[chosen])
            step += 1
            rate = 3e-3 * (1 - 0.9 * epoch / epochs)
            for k, g in gradients.items():
                m, v = momentum[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                weights[k] = weights[k] - rate * (
                    m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + 1e-4 * weights[k]
                )
    return model


def _gradients(model: QualityModel, x: np.ndarray, text_of: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    w, f = model.weights, model.forward(x, text_of, len(labels))
    error = (1 / (1 + np.exp(-f["margin"])) - labels) / len(labels)
    pooled = error[:, None] * w["score"]
    hidden, attention = f["hidden"], f["attention"]
    pull = (hidden * pooled[text_of]).sum(1)
    mean = np.bincount(text_of, attention * pull, len(labels))
    logits = attention * (pull - mean[text_of])
    units = logits[:, None] * w["attend"]
    tanh = units * f["gate"] * (1 - f["tanh"] ** 2)
    gate = units * f["tanh"] * f["gate"] * (1 - f["gate"])
    back = attention[:, None] * pooled[text_of] + tanh @ w["tanh"].T + gate @ w["gate"].T
    back *= 1 - hidden**2
    return {
        "encode": f["x"].T @ back, "encode_bias": back.sum(0),
        "tanh": hidden.T @ tanh, "gate": hidden.T @ gate, "attend": (f["tanh"] * f["gate"]).T @ logits,
        "score": f["pooled"].T @ error, "score_bias": error.sum(),
    }


def held_out(id_column: str = "doc_id") -> Column:
    """Rows kept out of the fit: the CRC-32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(3)) == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    sample: int = SAMPLE,
) -> QualityModel:
    """Fit on at most `sample` labelled documents that aren't held out.

    Their features, a bounded number of rows, are brought to the driver; of
    repeated labels of one document the larger one counts. Without any label
    every score is near 0.5.
    """
    labelled = (
        labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label"))
        .dropna()
        .filter(~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    # `sample` rows of an id and a label: bounded whatever the tables hold.
    chosen = rows.join(F.broadcast(labelled), "_id").select("_label", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                data, offsets = arrays.utf8(part.column(1))
                x, text_of = passages(data, offsets)
                cuts = np.cumsum(np.bincount(text_of, minlength=part.num_rows))[:-1]
                bags = [b.astype(np.float32).tobytes() for b in np.split(x, cuts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(bags, pa.binary())], ["_label", "_bag"])

    found = chosen.mapInArrow(run, "_label int, _bag binary").orderBy(F.xxhash64("_bag")).collect()
    bags = [np.frombuffer(r._bag, np.float32).reshape(-1, WIDTH).astype(np.float64) for r in found]
    return fit(bags, np.array([r._label for r in found], float))


def _scores(model: QualityModel, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last text, scores and numbers of passages of the parts of a text column."""
    data, offsets = arrays.utf8(column)
    for first, last in arrays.chunks(offsets):
        part = data[offsets[first] : offsets[last]]
        x, text_of = passages(part, offsets[first : last + 1] - offsets[first])
        yield first, last, model.score(x, text_of, last - first), np.bincount(text_of, minlength=last - first)


def keep_good(docs: DataFrame, model: QualityModel, text_column: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `docs` whose text scores `least` or more, with all their columns. No shuffle."""
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found, _ in _scores(model, batch.column(place)):
                yield batch.slice(first, last - first).filter(pa.array(found >= least))

    return docs.mapInArrow(run, docs.schema)


def score(
    docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The id, `score` (0 to 1, higher is better) and `n_passages` of every whole text.

    No shuffle. Null and empty texts have one passage without words, and a score
    like any other. Repeated rows score alike; other columns are not looked at;
    an empty table gives an empty result.
    """
    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema[id_column].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("n_passages", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found, counted in _scores(model, batch.column(1)):
                ids = batch.column(0).slice(first, last - first)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found), pa.array(counted)], schema.names)

    return docs.select(id_column, text_column).mapInArrow(run, schema)
