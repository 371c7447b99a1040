"""Texts of an Arrow column as byte arrays, their words, and rolling hashes over both."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are turned into arrays at a time, unless one text is longer.
CHUNK = 1 << 20
#: Hashes are polynomials modulo a prime: modulo 2**64 some unequal strings have equal ones for every multiplier.
PRIME = (1 << 61) - 1
_MULTIPLIER = 0x9E3779B97F4A7C15 % PRIME
#: Symbols hashed at a time, so that what is computed on them stays in the processor's cache.
BLOCK = 1 << 14
_ONE, _P = np.uint64(1), np.uint64(PRIME)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)
_letters = np.random.default_rng(20240304).integers(1, PRIME, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: The first bytes of eight, by their number; and how many times eight bytes of a word are mixed.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LANES = 16
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _reduced(values: np.ndarray) -> np.ndarray:
    """Values below 2**64 modulo the prime."""
    values = (values & _P) + (values >> np.uint64(61))
    return np.where(values >= _P, values - _P, values)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, of numbers below it: by halves of 31 bits, as 2**61 counts as one."""
    low, half = np.uint64((1 << 31) - 1), np.uint64(31)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a1 * b0
    middle += a0 * b1
    out = a1 * b1
    out += out
    out += middle >> np.uint64(30)
    middle &= np.uint64((1 << 30) - 1)
    middle <<= half
    out += middle
    out += a0 * b0
    return _reduced(out)


def _geometric(ratio: int, size: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    known = 1
    while known < size:
        more = min(known, size - known)
        step = np.uint64(pow(ratio, known, PRIME))
        for at in range(0, more, BLOCK):
            end = min(at + BLOCK, more)
            out[known + at : known + end] = _product(out[at:end], step)
        known += more
    return out


def _reserve(size: int) -> None:
    global _powers, _inverses
    if len(_powers) < size:
        size = max(size, 2 * len(_powers))
        _powers = _geometric(_MULTIPLIER, size)
        _inverses = _geometric(pow(_MULTIPLIER, -1, PRIME), size)


def prefix_hashes(symbols: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of a symbol array; symbols count modulo the prime."""
    _reserve(len(symbols) + 1)
    out = np.zeros(len(symbols) + 1, np.uint64)
    low, half = np.uint64((1 << 31) - 1), np.uint64(31)
    carry = np.uint64(0)
    for at in range(0, len(symbols), BLOCK):
        end = min(at + BLOCK, len(symbols))
        terms = _product(_reduced(symbols[at:end]), _powers[at:end])
        # Sums of halves don't overflow within a block.
        upper, lower = np.cumsum(terms >> half), np.cumsum(terms & low)
        lower += upper >> np.uint64(30)
        lower += (upper & np.uint64((1 << 30) - 1)) << half
        lower += carry
        out[at + 1 : end + 1] = _reduced(lower)
        carry = out[end]
    return out


def _difference(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _reduced(prefix[end] + (_P - prefix[start]))


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end): equal spans have equal ones, wherever they stand."""
    out = np.empty(len(start), np.uint64)
    for at in range(0, len(start), BLOCK):
        a, b = start[at : at + BLOCK], end[at : at + BLOCK]
        out[at : at + BLOCK] = mixed(_product(_difference(prefix, a, b), _inverses[a]))
    return out


def window_hashes(prefix: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all spans of `size` symbols."""
    n = max(0, len(prefix) - size)
    out = np.empty(n, np.uint64)
    for at in range(0, n, BLOCK):
        end = min(at + BLOCK, n)
        spans = _reduced(prefix[at + size : end + size] + (_P - prefix[at:end]))
        out[at:end] = mixed(_product(spans, _inverses[at:end]))
    return out


def same_spans(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Whether the spans of `size` symbols from a and b on have equal hashes."""
    one, two = _difference(prefix, a, a + size), _difference(prefix, b, b + size)
    later = b > a
    first, second = np.where(later, one, two), np.where(later, two, one)
    return _product(first, _powers[np.abs(b - a)]) == second


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins and the last one ends; null is empty."""
    return flat(pc.fill_null(column, ""))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same of a column of bytes without nulls."""
    column = column.cast(pa.large_binary())
    _, where, content = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about `limit` bytes, one text at least."""
    first, last = 0, len(offsets) - 1
    while first < last:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), last)
        yield first, end
        first = end


def symbols(data: np.ndarray) -> np.ndarray:
    """A number below the prime for each byte."""
    return _letters[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that aren't white space, and the text it belongs to."""
    ink = ~WHITE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, ink
    starts = np.flatnonzero(ink & (~before[:-1] | cut[:-1]))
    ends = np.flatnonzero(ink & (~np.append(ink[1:], False) | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, mixed from its bytes eight at a time; of very long words from their polynomial."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:-8] = _LOWER[data] if lower else data
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    out = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), BLOCK):
        start, size = starts[at : at + BLOCK], ends[at : at + BLOCK] - starts[at : at + BLOCK]
        hashed = mixed(size.astype(np.uint64) * _GOLDEN)
        rows, lane = np.arange(len(start)), 0
        while len(rows) and lane < LANES:
            rest = size[rows] - 8 * lane
            held = eights[start[rows] + 8 * lane] & _MASKS[np.minimum(rest, 8)]
            hashed[rows] = mixed(hashed[rows] ^ held)
            rows, lane = rows[rest > 8], lane + 1
        out[at : at + BLOCK] = hashed
    for word in np.flatnonzero(ends - starts > 8 * LANES):
        prefix = prefix_hashes(_letters[padded[starts[word] : ends[word]]])
        out[word] = mixed(out[word : word + 1] ^ prefix[-1])[0]
    return out


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices starts[i], starts[i] + 1, ... (sizes[i] of them) for all i, one after the other."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.arange(total) + np.repeat(starts - before, sizes)
