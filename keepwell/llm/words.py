"""Word hashes of whole texts in numpy: one pass over the bytes of an Arrow column.

Words are runs of bytes other than space and \\x09-\\x0D. A word's hash is a polynomial
over its bytes modulo 2**64, mixed at the end; it depends on the word alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
# Bytes handled at once, extended to the end of a word: memory stays bounded for texts of any length.
SPAN = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


PLAIN = _drawn(256, 1)
FOLDED = PLAIN.copy()
FOLDED[ord("A") : ord("Z") + 1] = PLAIN[ord("a") : ord("z") + 1]  # A-Z only
FACTORS = _drawn(64, 2) | np.uint64(1)
_BASE = int(_drawn(1, 3)[0]) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets of the texts in them; a null text is empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(
    data: np.ndarray, offsets: np.ndarray, fold_case: bool, white: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of every word, and the n + 1 word offsets of the texts.

    white: for every byte value whether it stands in no word.
    """
    white = white[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    if len(data):
        edge[offsets[:-1][offsets[:-1] < len(data)]] = True  # a word ends where its text ends
    before = np.concatenate([[True], white[:-1]]) if len(data) else np.zeros(0, bool)
    starts = np.flatnonzero(~white & (before | edge[:-1]))
    after = np.concatenate([white[1:], [True]]) if len(data) else np.zeros(0, bool)
    ends = np.flatnonzero(~white & (after | edge[1:])) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    table = FOLDED if fold_case else PLAIN
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + SPAN, side="right")))
        first, last = int(starts[lo]), int(ends[hi - 1])
        powers, inverse = power_tables(max(SPAN, last - first) + 1)
        sums = np.zeros(last - first + 1, dtype=np.uint64)
        np.cumsum(table[data[first:last]] * powers[: last - first], out=sums[1:])
        s, e = starts[lo:hi] - first, ends[lo:hi] - first
        hashes[lo:hi] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        lo = hi
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on, ignoring where texts end."""
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        total += words[k : k + count] * FACTORS[k]
    return mix(total)
