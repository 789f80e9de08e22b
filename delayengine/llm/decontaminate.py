"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

If an item of m characters occurs with at most e edits, at least m - q + 1 - q*e of its q-grams
occur in the text along diagonals that lie within e of each other. So q-grams are looked up in an index of the items, hits are
dealt to overlapping bands of diagonals, 2e + 1 wide and more, and bands with that many distinct q-grams are kept:
none with a passage is lost. Each is then aligned in a band of that width; the edits found decide.

Texts and items are compared in lower case with each run of white space as one space, as UTF-8
bytes: a changed accented letter may count as two edits. ``max_rate`` of an item's length is its edit budget, less
where the lemma needs it. Items of fewer than ``MIN_CHARS`` bytes match without edits and between word boundaries only; those
of fewer than Q bytes have no q-gram and are looked up whole where words begin.

Items are read in blocks of at most ``BLOCK_BYTES``; each block's index is broadcast and meets all documents, so
no item is dropped however many there are, and what is broadcast has a fixed bound. A block passes the
documents on with what it found: no shuffle. Whole texts are searched, in pieces of a few megabytes.

Null and empty texts have no matches; null items match nothing; equal items are all reported. Repeated rows get equal
results; other columns stay as they are. Without items nothing matches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayengine.llm.words import mix, pieces, runs, tally, texts_of

Q = 8
MAX_RATE = 0.1
MIN_CHARS = 24
BLOCK_BYTES = 4 << 20
_SIEVE_BITS = 18
_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])  # bytes of words
MATCHES = "array<struct<item_id:bigint,start:int,end:int,edits:int>>"


def _plain(column: pa.Array) -> pa.Array:
    lower = pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))
    return pc.utf8_trim_whitespace(pc.replace_substring_regex(lower, r"\s+", " "))


def _grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from each position as one number."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    two = data[:-1].astype(np.uint16) | data[1:].astype(np.uint16) << np.uint16(8)
    four = two[:-2].astype(np.uint32) | two[2:].astype(np.uint32) << np.uint32(16)
    return four[:-4].astype(np.uint64) | four[4:].astype(np.uint64) << np.uint64(32)


def _sieve(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SIEVE_BITS)


def _apart(text: np.ndarray, start: int, end: int) -> bool:
    """Whether no word goes on across either end."""
    return not any(0 < at < len(text) and _WORD[text[at - 1]] and _WORD[text[at]] for at in (start, end))


class Index:
    """Where each q-gram stands in a block of items."""

    def __init__(self, ids: list[int], items: list[bytes], max_rate: float = MAX_RATE):
        tiny = sorted((len(x), int.from_bytes(x, "little"), ids[i]) for i, x in enumerate(items) if 0 < len(x) < Q)
        self.tiny = {n: [np.array(c) for c in zip(*[(np.uint64(x), i) for m, x, i in tiny if m == n], strict=True)] for n in {t[0] for t in tiny}}
        long = [i for i, x in enumerate(items) if len(x) >= Q]
        self.ids, self.items = np.array([ids[i] for i in long], np.int64), [items[i] for i in long]
        self.sizes = np.array([len(x) for x in self.items], np.int64)
        # m - q + 1 - q*e must be 1 at least
        self.edits = np.where(self.sizes < MIN_CHARS, 0, np.minimum((self.sizes * max_rate).astype(np.int64), (self.sizes - Q) // Q))
        self.least = self.sizes - Q + 1 - Q * self.edits
        grams = [_grams(np.frombuffer(x, np.uint8)) for x in self.items]
        sizes = np.array([len(g) for g in grams], np.int64)
        keys = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.owner, self.place = np.repeat(np.arange(len(grams)), sizes)[order], runs(sizes)[order]
        self.keys, self.counts = tally(keys)
        self.firsts = np.cumsum(self.counts) - self.counts
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[_sieve(self.keys)] = True

    def search(self, column: pa.Array) -> list[list[tuple[int, int, int, int]]]:
        """For each text its matches: item id, start and end in the plain text, edits; the best place of each item."""
        found: list[list[tuple[int, int, int, int]]] = [[] for _ in range(len(column))]
        texts = texts_of(_plain(column))
        self._whole(texts, found)
        self._near(texts, found)
        return [self._best(x) for x in found]

    def _whole(self, texts, found) -> None:
        """Items shorter than a q-gram, where words begin and end."""
        if not self.tiny or not len(texts.data):
            return
        word, ends = _WORD[texts.data], np.append(texts.offsets[1:], texts.offsets[-1])
        edge = np.ones(len(word) + 1, bool)  # before each byte: a text's end, or a side that is in no word
        edge[1:-1] = ~word[1:] | ~word[:-1]
        edge[texts.offsets] = True
        at = np.flatnonzero(edge[:-1])
        row = np.searchsorted(texts.offsets, at, side="right") - 1
        grams = _grams(np.concatenate([texts.data, np.zeros(Q, np.uint8)]))[at]
        for n, (keys, ids) in self.tiny.items():
            cut = grams & np.uint64((1 << 8 * n) - 1)
            low, high = np.searchsorted(keys, cut, "left"), np.searchsorted(keys, cut, "right")
            good = (high > low) & (at + n <= ends[row])
            good[good] = edge[at[good] + n]
            for i in np.flatnonzero(good):
                start = int(at[i] - texts.offsets[row[i]])
                found[row[i]].extend((int(k), start, start + n, 0) for k in ids[low[i]:high[i]])

    def _near(self, texts, found) -> None:
        grams = _grams(texts.data)
        at = np.flatnonzero(self.sieve[_sieve(grams)]) if len(grams) and len(self.keys) else np.zeros(0, np.int64)
        if not len(at):
            return
        key = np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)
        hit = self.keys[key] == grams[at]
        at, key = at[hit], key[hit]
        row = np.searchsorted(texts.offsets, at, side="right") - 1
        inside = at + Q <= texts.offsets[row + 1]
        at, key, row = at[inside], key[inside], row[inside]
        if not len(at):
            return
        n = self.counts[key]
        which = np.repeat(self.firsts[key], n) + runs(n)
        item, place = self.owner[which], self.place[which]
        row, at = np.repeat(row, n), np.repeat(at, n)
        pair = row * len(self.items) + item
        enough = np.bincount(pair, minlength=len(texts) * len(self.items))[pair] >= self.least[item]
        row, at, item, place, pair = row[enough], at[enough], item[enough], place[enough], pair[enough]
        if not len(row):
            return
        diagonal = at - texts.offsets[row] - place + self.sizes[item]  # never negative
        width = self.edits[item] + 1
        for shift in (0, 1):  # bands of twice the width, each beginning in the middle of the last
            band = (diagonal // width + shift) // 2
            self._bands(texts, row, item, place, pair, band, shift, width, found)

    def _bands(self, texts, row, item, place, pair, band, shift, width, found) -> None:
        order = np.lexsort((place, band, pair))
        row, item, place, band, pair, width = row[order], item[order], place[order], band[order], pair[order], width[order]
        new = np.concatenate(([True], (pair[1:] != pair[:-1]) | (band[1:] != band[:-1])))
        distinct = new.copy()
        distinct[1:] |= place[1:] != place[:-1]
        first = np.flatnonzero(new)
        total = np.add.reduceat(distinct.astype(np.int64), first)
        for i in first[total >= self.least[item[first]]]:
            text = texts.data[texts.offsets[row[i]]:texts.offsets[row[i] + 1]]
            low = (2 * int(band[i]) - shift) * int(width[i]) - int(self.sizes[item[i]])  # the band's first diagonal
            match = self.align(text, int(item[i]), low - int(self.edits[item[i]]), low + int(2 * width[i] + self.edits[item[i]]))
            if match:
                found[row[i]].append((int(self.ids[item[i]]), *match))

    def align(self, text: np.ndarray, item: int, low: int, high: int) -> tuple[int, int, int] | None:
        """The fewest edits that make the item a part of the text on diagonals low..high, if within the budget."""
        word, budget = np.frombuffer(self.items[item], np.uint8), int(self.edits[item])
        start, end = max(low, 0), min(high + len(word), len(text))
        held = text[start:end].tobytes()
        exact = held.find(self.items[item])
        while exact >= 0 and len(word) < MIN_CHARS and not _apart(text, start + exact, start + exact + len(word)):
            exact = held.find(self.items[item], exact + 1)
        if exact >= 0:
            return start + exact, start + exact + len(word), 0
        if not budget:
            return None
        far, width = len(word) + len(text) + 1, high - low + 1
        steps = np.arange(width)
        # cost[k]: of aligning the item's first i bytes so that they end before text position i + low + k
        position = low + steps
        cost = np.where((position >= 0) & (position <= len(text)), 0, far)
        begin = position.copy()
        for i, byte in enumerate(word):
            position = position + 1
            there = (position >= 1) & (position <= len(text))
            letter = text[np.clip(position - 1, 0, max(len(text) - 1, 0))]
            step = np.where(there, cost + (letter != byte), far)
            skipped, skipped_begin = np.append(cost[1:] + 1, far), np.append(begin[1:], 0)  # the item's byte has no partner
            skipped = np.where((position >= 0) & (position <= len(text)), skipped, far)
            less = skipped < step
            step, begin = np.where(less, skipped, step), np.where(less, skipped_begin, begin)
            ahead = step - steps  # bytes of the text without partner
            lowest = np.minimum.accumulate(ahead)
            source = np.maximum.accumulate(np.where(ahead == lowest, steps, 0))
            cost, begin = np.where(there | (position == 0), lowest + steps, far), begin[source]
            if cost.min() > budget:
                return None
        best = int(cost.argmin())
        return int(begin[best]), int(position[best]), int(cost[best])

    @staticmethod
    def _best(matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        best: dict[int, tuple[int, int, int, int]] = {}
        for m in matches:
            if m[0] not in best or (m[3], m[1], m[2]) < (best[m[0]][3], *best[m[0]][1:3]):
                best[m[0]] = m
        return [best[k] for k in sorted(best)]


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[tuple[list[int], list[bytes]]]:
    """The items in plain form, in lists of at most ``limit`` bytes or one item."""
    ids, items, size = [], [], 0
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    for item_id, text in rows.toLocalIterator():
        plain = _plain(pa.array([text], pa.string()))[0].as_py().encode()
        if items and size + len(plain) > limit:
            yield ids, items
            ids, items, size = [], [], 0
        ids.append(item_id)
        items.append(plain)
        size += len(plain)
    if items:
        yield ids, items


def _pass(docs: DataFrame, ids: list[int], items: list[bytes], max_rate: float, column: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((ids, items))
    schema = docs.schema
    made: list[Index] = []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Index(*sent.value, max_rate))
        for batch in batches:
            for piece in pieces(batch, "text"):
                at = piece.schema.get_field_index(column)
                rows = [
                    (old or []) + [dict(zip(("item_id", "start", "end", "edits"), m, strict=True)) for m in new]
                    for old, new in zip(piece.column(at).to_pylist(), made[0].search(piece.column("text")), strict=True)
                ]
                yield piece.set_column(at, piece.schema.field(at), pa.array(rows, piece.schema.field(at).type))

    return docs.mapInArrow(run, schema)


def find_items(docs: DataFrame, benchmark: DataFrame, max_rate: float = MAX_RATE, matches: str = "matches", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with an array of (item_id, start, end, edits) in the new column ``matches``; empty where nothing matches."""
    if matches in docs.columns:
        raise ValueError(f"there already is a column {matches}")
    out = docs.withColumn(matches, F.from_json(F.lit("[]"), MATCHES))
    for ids, items in blocks(benchmark, block_bytes):
        out = _pass(out, ids, items, max_rate, matches)
    return out


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, whether the text holds a benchmark passage, the items in order and the fewest edits of any (null: none)."""
    found = find_items(docs.select(F.col("doc_id").cast("long"), "text"), benchmark)
    return found.select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"), F.array_sort(F.col("matches.item_id")).alias("item_ids"),
        F.array_min(F.col("matches.edits")).alias("fewest_edits"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without a benchmark passage; all columns are kept."""
    columns = docs.columns
    own = docs.select(F.struct(*columns).alias("row"), F.col("text").alias("text"))
    return find_items(own, benchmark).where(F.size("matches") == 0).select("row.*")
