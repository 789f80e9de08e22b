"""Words and their 64-bit hashes for whole Arrow batches, with numpy instead of a loop per word.

A word is a run of bytes other than space and U+0009..U+000D; A-Z count as a-z. The hash of
a word is a polynomial over its bytes modulo 2^64: one running sum serves every word of
a batch. Work goes in pieces of a few megabytes, so memory does not follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from delayengine.llm.scratch import holds

PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}
holds("words", _powers.clear)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finaliser)."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))[_LOWER]


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        factors[0] = 1
        known = _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return known[:n]


def mixed(*parts: np.ndarray) -> np.ndarray:
    """One hash for each row of several hash columns, in order."""
    out = np.uint64(0)
    for part in parts:
        out = mix((out * np.uint64(31)) ^ part)
    return out


class Texts(NamedTuple):
    """The bytes of several texts and where each begins; one more offset ends the last."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array) -> Texts:
    """The UTF-8 bytes of a string column; null is the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[at[0]:at[-1]], at - at[0])


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch holding about ``limit`` bytes of text, or one row."""
    ends = texts_of(batch.column(column)).offsets[1:]
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class Words(NamedTuple):
    """One entry for each word: its hash, the row it stands in, its first and last byte plus one."""

    hashes: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray  # words in each row


def words_of(texts: Texts, breaks: np.ndarray = _SPACE, skip: np.ndarray | None = None) -> Words:
    """All words of all texts. ``breaks`` marks separating bytes; ``skip`` bytes don't enter the hash."""
    data, offsets = texts
    n, rows = len(data), len(texts)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, none, np.zeros(rows, np.int64))
    gap = (data == 0x20) | (data - np.uint8(0x09) < np.uint8(5)) if breaks is _SPACE else breaks[data]
    changes = np.flatnonzero(gap[1:] != gap[:-1]) + 1  # words begin and end in turn
    edges = offsets[(offsets > 0) & (offsets < n)]
    inner = np.unique(edges[~(gap[edges - 1] | gap[edges])])  # texts that meet within a run of other bytes
    if len(inner):
        changes = np.insert(changes, np.repeat(np.searchsorted(changes, inner), 2), np.repeat(inner, 2))
    changes = np.concatenate((([] if gap[0] else [0]), changes, ([] if gap[-1] else [n]))).astype(np.int64)
    starts, ends = changes[::2], changes[1::2]
    values = _BYTE[data]
    if skip is not None:
        values[skip[data]] = 0
    values *= _power(_BASE, n)
    np.cumsum(values, out=values)
    sums = values[ends - 1] - np.where(starts > 0, values[starts - 1], np.uint64(0))
    inverse = pow(_BASE, -1, 1 << 64)
    hashes = mix(sums * _power(inverse, n)[starts])
    counts = np.diff(np.searchsorted(starts, offsets))
    return Words(hashes, np.repeat(np.arange(rows), counts), starts, ends, counts)


def runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2 .. within each run of the given lengths."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def tally(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and the sum of weights (or the count) of each."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    order = None if weights is None else np.argsort(keys, kind="stable")
    keys = np.sort(keys) if order is None else keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    if weights is None:
        return keys[first], np.diff(first, append=len(keys))
    return keys[first], np.add.reduceat(weights[order], first)


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in a sorted table, and whether it does."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def spans_hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of given spans of bytes, as ``words_of`` has them for words."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data)
    values = _BYTE[data] * _power(_BASE, n)
    np.cumsum(values, out=values)
    sums = values[ends - 1] - np.where(starts > 0, values[starts - 1], np.uint64(0))
    return mix(sums * _power(pow(_BASE, -1, 1 << 64), n)[starts])
