"""Repeated word sequences, found from fixed blocks and extended to maximal repeats.

Each stretch of words is cut into non-overlapping blocks, which are indexed;
every rolling window of a block's length looks its words up there; hits are
extended to both sides, by binary searches on prefix hashes, to the longest
repeat. A window of 50 words holds a whole block of 25, wherever it begins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicerank.llm import arrays, repeats

#: Words in a gram that anchors a window, and stretches around one that a task compares itself.
GRAM, TOGETHER = 8, 512
#: Hits that are extended at a time.
HITS = 1 << 18


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, owner = arrays.words(data, offsets)
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    return arrays.word_hashes(data, starts, ends), np.append(0, np.cumsum(counts))


def _cut(text: bytes, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
    data = np.frombuffer(text, np.uint8)
    hashes, _ = _words(data, np.array([0, len(data)]))
    return [hashes[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def _hashed(context: bytes) -> np.ndarray:
    return np.frombuffer(context, np.uint64)


def _extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray, forward: bool) -> np.ndarray:
    """How far the sequences at a and b agree, up to `limit`: after them, or before them."""
    low, high = np.zeros(len(a), np.int64), limit.copy()
    while len(rows := np.flatnonzero(low < high)):
        middle = (low[rows] + high[rows] + 1) // 2
        x, y = (a[rows], b[rows]) if forward else (a[rows] - middle, b[rows] - middle)
        same = arrays.same_spans(prefix, x, y, middle)
        low[rows[same]] = middle[same]
        high[rows[~same]] = middle[~same] - 1
    return low


def block_repeats(
    symbols: np.ndarray, begins: np.ndarray, group: np.ndarray, doc: np.ndarray, window: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(stretch, begin, length) of maximal repeats of `window` symbols or more.

    Stretch i holds symbols[begins[i]:begins[i + 1]]; it is compared with those
    of its group that belong to a smaller doc.
    """
    block = (window + 1) // 2
    prefix = arrays.prefix_hashes(symbols)
    rolling = arrays.window_hashes(prefix, block)
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    at = np.arange(len(rolling))
    at = at[owner[: len(rolling)] == owner[block - 1 : block - 1 + len(rolling)]]
    keys = arrays.mixed(rolling[at] ^ arrays.mixed(group[owner[at]].astype(np.uint64)))
    fixed = np.flatnonzero((at - begins[owner[at]]) % block == 0)
    fixed = fixed[np.argsort(keys[fixed], kind="stable")]
    index = keys[fixed]
    first = np.searchsorted(index, keys, "left")
    count = np.searchsorted(index, keys, "right") - first
    probes = np.flatnonzero(count)
    ends = np.cumsum(count[probes])
    done = 0
    while done < len(probes):
        base = ends[done - 1] if done else 0
        last = max(done + 1, int(np.searchsorted(ends, base + HITS, "right")))
        part = probes[done:last]
        done = last
        a = at[np.repeat(part, count[part])]
        b = at[fixed[arrays.ragged(first[part], count[part])]]
        earlier = doc[owner[b]] < doc[owner[a]]
        a, b = a[earlier], b[earlier]
        if not len(a):
            continue
        one, two = owner[a], owner[b]
        left = _extension(prefix, a, b, np.minimum(a - begins[one], b - begins[two]), False)
        right = _extension(prefix, a, b, np.minimum(begins[one + 1] - a, begins[two + 1] - b), True)
        long = left + right >= window
        yield one[long], (a - left - begins[one])[long], (left + right)[long]


def _compare(window: int):
    def compare(fields: dict[str, np.ndarray], contexts: list[bytes]) -> tuple[np.ndarray, ...]:
        symbols = np.frombuffer(b"".join(contexts), np.uint64)
        sizes = np.fromiter(map(len, contexts), np.int64, len(contexts)) // 8
        begins = np.append(0, np.cumsum(sizes))
        new = np.ones(len(contexts), bool)
        new[1:] = fields["anchor"][1:] != fields["anchor"][:-1]
        found = list(block_repeats(symbols, begins, np.cumsum(new), fields["doc"], window))
        stretch, begin, length = (
            np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3)
        )
        begin = begin + fields["start"][stretch]
        return fields["doc"][stretch], begin, begin + length

    return compare


def _finish(text: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[int, str, str | None]:
    # Bytes are split at the very white space that the words are defined by.
    words = text.split()
    edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(words)]
    left = [w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b]]
    kept = b" ".join(left)
    return len(words) - len(left), hashlib.sha256(kept).hexdigest(), kept.decode() if len(begin) else None


FIELDS = [("n_removed", "long", pa.int64()), ("kept_sha256", "string", pa.string()), ("kept", "string", pa.string())]


def remove_repeated_words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 50, texts: bool = True
) -> DataFrame:
    """Texts without the words covered by `window` words that also stand in a document with a smaller id.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged; all windows are judged on the
    input. One row per row of `docs`: the id, `n_words`, `n_removed`,
    `kept_sha256` and with `texts` also `kept`: the words that stay, joined by
    one space (null where nothing was removed).

    Null texts have no words; texts shorter than the window lose nothing. Ids
    are taken to be unique: of rows that repeat an id one text is judged. Rows
    without an id lose nothing. Other columns are not looked at. An empty table
    gives an empty result. Runs jobs when called.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc"), F.col(text_column).alias("text"))
    fields = FIELDS if texts else FIELDS[:2]
    width = len(fields)
    plan = repeats.Plan(
        units=_words,
        contexts=_cut,
        hashed=_hashed,
        compare=_compare(window),
        finish=lambda text, begin, end: _finish(text, begin, end)[:width],
        fields=fields,
        window=window,
        gram=min(GRAM, window),
        together=TOGETHER,
        within=False,
    )
    shorter = repeats.find(rows, plan)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words = [(t or "").encode().split() for t in part.column(1).to_pylist()]
                digests = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(digests)],
                    ["doc", "n_words", "whole_sha256"],
                )

    every = rows.mapInArrow(whole, "doc long, n_words long, whole_sha256 string")
    return every.join(shorter, "doc", "left").select(
        F.col("doc").alias(id_column),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        *(["kept"] if texts else []),
    )
