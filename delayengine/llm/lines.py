"""Line deduplication: an exact set-similarity join of all lines, and removal of the later ones.

A line is the set of its words (lower case). It is removed if a line before it, in the order of doc_id, line
number and text, has a Jaccard similarity of ``threshold`` or more with it, whether or not that line stays. So
the first of each kind of line stays, and nothing depends on how the rows are dealt.

1. Words are counted over all lines in 2^22 counters, so the order of words by rarity has a fixed size. Any
   order all tasks share gives an exact join; a word that is alone in its counter can match nothing.
2. Lines of equal sets are merged: by task first, then by the set's hash. What is left are distinct sets with their first place.
3. Each set sends its rarest words (the prefix: two sets alike have one in common) to the word's shard. There the
   size, position and bitmap filters leave candidates; each later set keeps the nearest few, and how many it had.
   A word of many sets is cut into chunks, and each two of them are compared in a task of their own.
   Bitmaps stand in sorted arrays below the shared folder: two sets differ in at least as many words as bits.
4. The candidates' sets are made anew from the lines where they first stand and intersected. A later set whose listed
   candidates all fail, though it had others, is compared with all of them in a second round, so no match is lost.
   That round deals out only the entries of its sets' words.
5. Sets to remove and first places of repeated sets are stored as sorted hash arrays; a last pass over the texts
   looks its lines up there. Texts are never shuffled.

Lines without words stay and match nothing. Null texts stay null, empty ones empty. Rows equal in doc_id and
text count as one document and get equal results. Null ids come last. Words are
compared by 43 bits of their hash, sets by 128.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayengine.llm.packed import BLOCKS, blocks, pack, shard_of, unpack
from delayengine.llm.scratch import alone, give_back, mapped, put
from delayengine.llm.words import Texts, find, mix, mixed, pieces, runs, texts_of, words_of
from delayengine.session import new_folder, stage

THRESHOLD = 0.8
_BITS = 43  # of a word's hash; the other bits of a number take the line
_COUNTERS = 1 << 22
_MAP, LISTED, GROUP = 8, 4, 2048
SHARD_WORDS = 2_000_000  # words of text for a shard of keys and of words
_PARTS = 64  # rows in which a task hands its counters on
_FLUSH = 1_000_000  # words of lines that a task merges at once
_LATE = np.int64(2**63 - 1)  # stands for a null id


class Lines(NamedTuple):
    """The lines with words of some texts: set hashes, row, line number, and the words of all sets in the order of lines."""

    key: np.ndarray
    key2: np.ndarray
    row: np.ndarray
    line: np.ndarray
    size: np.ndarray
    words: np.ndarray


def _cuts(texts: Texts) -> np.ndarray:
    """Where each line begins, and the end of all."""
    data, offsets = texts
    return np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1])) if len(data) else offsets[:1]


def lines_of(texts: Texts) -> Lines:
    data, offsets = texts
    cuts = _cuts(texts)
    found = words_of(Texts(data, cuts))
    words, row = found.hashes >> np.uint64(64 - _BITS), found.rows
    if len(cuts) < 1 << (64 - _BITS):  # line and word in one number: one plain sort
        both = row.astype(np.uint64) << np.uint64(_BITS) | words
        both.sort()
        both = both[np.concatenate(([True], both[1:] != both[:-1]))[:len(both)]]
        words, row = both & np.uint64((1 << _BITS) - 1), (both >> np.uint64(_BITS)).astype(np.int64)
    else:
        order = np.lexsort((words, row))
        words, row = words[order], row[order]
        keep = np.concatenate(([True], (words[1:] != words[:-1]) | (row[1:] != row[:-1])))
        words, row = words[keep], row[keep]
    if not len(words):
        none = np.zeros(0, np.int64)
        return Lines(words, words, none, none, none, words)
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    used = row[first]
    text = np.searchsorted(offsets, cuts[used], side="right") - 1
    line = used - np.searchsorted(cuts, offsets[text])
    size = np.diff(first, append=len(words))
    key = mix(np.add.reduceat(mix(words), first) ^ size.astype(np.uint64))
    key2 = mix(np.add.reduceat(mix(words ^ np.uint64(0x5851F42D4C957F2D)), first))
    return Lines(key, key2, text, line, size, words)


def _counter(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(_BITS - 22)).astype(np.int64)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    alone("lines")
    counts, held = np.zeros(_COUNTERS, np.uint32), []

    def add() -> None:  # a sort takes less memory than a second set of counters
        found = np.concatenate(held)
        found.sort()
        first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))[:len(found)]).astype(np.int32)  # none in no words
        counts[found[first]] += np.diff(first, append=np.int32(len(found))).astype(np.uint32)
        held.clear()

    for batch in batches:
        for piece in pieces(batch):
            held.append(_counter(words_of(texts_of(piece.column("text"))).hashes >> np.uint64(64 - _BITS)).astype(np.int32))
            if sum(map(len, held)) > _COUNTERS // 8:
                add()
    if held:
        add()
    if counts.any():
        width = _COUNTERS // _PARTS
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(_PARTS), pa.int32()), pa.array(np.zeros(_PARTS), pa.int32()),
            pa.array([pack([counts[i * width:(i + 1) * width]]) for i in range(_PARTS)], pa.binary()),
        ], ["shard", "kind", "block"])
    give_back()


def _levels(key: tuple, table: pa.Table) -> pa.Table:
    """Sums as levels: 0 none, 1 for exactly one, then eight to each doubling."""
    total = np.zeros(_COUNTERS // _PARTS)
    for block in table.column("block"):
        total += unpack(block.as_py())[0]
    level = np.where(total > 0, 1 + np.ceil(8 * np.log2(np.maximum(total, 1))), 0).clip(0, 255).astype(np.uint8)
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([int(total.sum())]), pa.array([pack([level])], pa.binary())], ["shard", "words", "block"])


def rarity(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The level of each counter, 4 MB whatever the size of the corpus, and the number of words."""
    rows = docs.select("text").mapInArrow(_counted, BLOCKS).groupBy("shard").applyInArrow(_levels, "shard int, words long, block binary").collect()
    out = np.zeros(_COUNTERS, np.uint8)
    width = _COUNTERS // _PARTS
    for row in rows:
        out[row.shard * width:(row.shard + 1) * width] = unpack(row.block)[0]
    return out, sum(row.words for row in rows)


def _ids(piece: pa.RecordBatch) -> np.ndarray:
    return piece.column("doc_id").fill_null(int(_LATE)).to_numpy(zero_copy_only=False).astype(np.int64)


def _spot(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """One hash of doc_id and line; texts that share a doc_id share it."""
    return mixed(doc.view(np.uint64), line.astype(np.uint64))


def _places(piece: pa.RecordBatch, lines: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, line and text hash of each line."""
    ids = _ids(piece)
    texts = piece.column("text_hash").to_numpy(zero_copy_only=False).astype(np.int64)
    return ids[lines.row], lines.line.astype(np.int64), texts[lines.row]


def _place_hash(doc: np.ndarray, line: np.ndarray, text: np.ndarray) -> np.ndarray:
    return mixed(doc.view(np.uint64), line.view(np.uint64), text.view(np.uint64))


def _prefixes(lines: Lines, levels: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, place in the order by rarity, and word, of each prefix word that may be in another line."""
    owner = np.repeat(np.arange(len(lines.size)), lines.size)
    level = levels[_counter(lines.words)]
    # by line, level, and word: words are in order within a line, so their index tells them apart
    numbers = owner.astype(np.uint64) << np.uint64(36) | level.astype(np.uint64) << np.uint64(28) | np.arange(len(owner), dtype=np.uint64)
    order = (np.sort(numbers) & np.uint64((1 << 28) - 1)).astype(np.int64) if len(owner) < 1 << 28 else np.lexsort((lines.words, level, owner))
    place = runs(lines.size)
    least = np.ceil(lines.size * threshold - 1e-9).astype(np.int64)
    larger = np.floor(lines.size / threshold + 1e-9) > lines.size  # else all words must agree, and equal sets are merged already
    length = np.where(larger, lines.size - least + 1, 0)
    keep = (place < length[owner]) & (level[order] > 1)
    return owner[keep], place[keep], lines.words[order][keep]


def _bitmaps(lines: Lines, wanted: np.ndarray) -> np.ndarray:
    """_MAP x 64 bits for each set that is wanted, one set by each word; zeros for the others."""
    n, bits = int(wanted.sum()), 64 * _MAP
    words = lines.words[np.repeat(wanted, lines.size)]
    flags = np.zeros(n * bits, bool)
    flags[np.repeat(np.arange(n) * bits, lines.size[wanted]) + (mix(words ^ np.uint64(77)) & np.uint64(bits - 1)).astype(np.int64)] = True
    out = np.zeros((len(wanted), _MAP), np.uint64)
    out[wanted] = np.packbits(flags).view(np.uint64).reshape(n, _MAP)
    return out


def _merged(parts: list[list[np.ndarray]], words: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Sets by key, each with its first place and number of lines; and their prefix words."""
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    flat = np.concatenate(words)
    key, key2, doc, line, text, size, times, prefix, *bits = columns
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    among = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))  # sets met once need no more order
    own = order[among]
    order[among] = own[np.lexsort((text[own], line[own], doc[own], key2[own], key[own]))]
    new = np.concatenate(([True], (key[order][1:] != key[order][:-1]) | (key2[order][1:] != key2[order][:-1])))
    first = np.flatnonzero(new)
    total = np.add.reduceat(times[order], first)
    chosen = order[first]
    starts = (np.cumsum(prefix) - prefix)[chosen]
    at = np.repeat(starts, prefix[chosen]) + runs(prefix[chosen])
    return [key[chosen], key2[chosen], doc[chosen], line[chosen], text[chosen], size[chosen], total, prefix[chosen], *(m[chosen] for m in bits)], flat[at]


def _lines_out(levels, threshold: float, shards: int) -> Callable:
    """Each task's distinct sets, merged, in one block for each shard of keys. Prefix words go as word and place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, words, size = [], [], 0

        def flush() -> pa.RecordBatch:
            columns, flat = _merged(parts, words)
            shard = shard_of(columns[0], shards)
            edges = np.searchsorted(shard, np.arange(shards + 1))
            ends = np.concatenate(([0], np.cumsum(columns[7])))
            used, packed = np.flatnonzero(np.diff(edges)), []
            for s in used:
                low, high = edges[s], edges[s + 1]
                head, tail = pack([c[low:high] for c in columns]), pack([flat[ends[low]:ends[high]]["word"], flat[ends[low]:ends[high]]["place"]])
                packed.append(np.uint32(len(head)).tobytes() + head + tail)
            return pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(np.zeros(len(used)), pa.int32()), pa.array(packed, pa.binary())], ["shard", "kind", "block"]
            )

        for batch in batches:
            for piece in pieces(batch):
                lines = lines_of(texts_of(piece.column("text")))
                if not len(lines.key):
                    continue
                doc, line, text = _places(piece, lines)
                owner, place, word = _prefixes(lines, levels.value, threshold)
                flat = np.empty(len(word), [("word", "u8"), ("place", "u2")])
                flat["word"], flat["place"] = word, np.minimum(place, 65535)
                count = np.bincount(owner, minlength=len(lines.key))
                parts.append([lines.key, lines.key2, doc, line, text, lines.size, np.ones(len(doc), np.int64), count, *_bitmaps(lines, count > 0).T])
                words.append(flat)
                size += len(lines.words)
                if size > _FLUSH:
                    yield flush()
                    parts, words, size = [], [], 0
        if parts:
            yield flush()
        give_back()

    return run


def _sets_merged(folder: str, shards: int) -> Callable:
    """A shard of keys: stores the first place of repeated sets, and sends prefix words to their shards."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts, words = [], []
        for block in table.column("block").to_pylist():
            cut = 4 + int(np.frombuffer(block, np.uint32, 1)[0])
            word, place = unpack(block[cut:])
            flat = np.empty(len(word), [("word", "u8"), ("place", "u2")])
            flat["word"], flat["place"] = word, place
            parts.append(unpack(block[4:cut]))
            words.append(flat)
        columns, flat = _merged(parts, words)
        keys, key2, doc, line, text, size, times, prefix, *bits = columns
        many = times > 1
        put(folder, f"repeated-{key[0].as_py()}-keys", keys[many])
        put(folder, f"repeated-{key[0].as_py()}-values", np.stack([key2[many], _place_hash(doc[many], line[many], text[many])], 1))
        with_prefix = prefix > 0
        put(folder, f"maps-{key[0].as_py()}-keys", keys[with_prefix])
        put(folder, f"maps-{key[0].as_py()}-values", np.stack([m[with_prefix] for m in bits], 1))
        folded = np.bitwise_or.reduce(bits)
        owner = np.repeat(np.arange(len(keys)), prefix)
        shard = shard_of(flat["word"] << np.uint64(64 - _BITS), shards)
        order = np.lexsort((flat["word"], shard))
        owner, flat, shard = owner[order], flat[order], shard[order]
        out = pa.Table.from_batches([blocks(0, shard, shards, [
            flat["word"], keys[owner], doc[owner], line[owner].astype(np.uint32), size[owner].astype(np.uint32), flat["place"].copy(), folded[owner],
        ])])
        give_back()
        return out

    return run


def _order(word: np.ndarray, keys: np.ndarray, doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The order by word, doc_id, line and key: by two plain sorts of numbers where these fit, as sorting by columns takes longer."""
    n, bits = len(word), 64 - _BITS
    if 0 < n < 1 << bits and int(doc.max()) - int(doc.min()) < 1 << 40 and int(line.max()) < 1 << 23:
        place = (doc - doc.min()).astype(np.uint64) << np.uint64(23) | line.astype(np.uint64)
        at = np.argsort(place)
        tie = place[at[1:]] == place[at[:-1]]
        if not (tie & (keys[at[1:]] != keys[at[:-1]])).any():  # else texts share a doc_id, and their keys decide
            numbers = np.empty(n, np.uint64)
            numbers[at] = np.arange(n, dtype=np.uint64)
            numbers |= word << np.uint64(bits)
            numbers.sort()
            return at[numbers & np.uint64((1 << bits) - 1)]
    return np.lexsort((keys, line, doc, word))


def _entries(table: pa.Table) -> list[np.ndarray]:
    """Prefix words of a shard, by word and then by place in the corpus."""
    columns = [np.concatenate(c) for c in zip(*(unpack(b) for b in table.column("block").to_pylist()), strict=True)]
    order = _order(*columns[:4])
    return [c[order] for c in columns]


def _steps(word: np.ndarray, size: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of each two entries of a word whose sizes are near enough, the larger set second.

    The entries of a word are put in the order of size, and pairs made by how far apart they stand there; an entry that
    has met the last one of its word, or one too large for it, meets no more.
    """
    most = np.floor(np.arange(int(size.max(initial=0)) + 1) / threshold + 1e-9).astype(np.int64)  # the largest set that is near enough
    span = np.int64(len(most) + 1)
    number = np.cumsum(np.concatenate(([False], word[1:] != word[:-1]))[:len(word)]) * span + size  # word and size as one number
    order = np.argsort(number, kind="stable")
    number, ordered = number[order], size[order]
    end = np.searchsorted(number, number - ordered + np.minimum(most[ordered], span - 2), side="right")  # the first past an entry's partners
    active = np.arange(len(word))
    left = end - active
    step = 0
    while len(active):
        step += 1
        keep = left > step
        active, left = active[keep], left[keep]
        yield order[active], order[active + step]


def _across(cut: int, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of each entry before ``cut`` with each from there on."""
    for step in range(1, n):
        first = np.arange(max(0, cut - step), min(cut, n - step))
        yield first, first + step


def _candidates(entries: list[np.ndarray], cut: int | None, folder: str, shards: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Indices of later and earlier sets that share a word and pass the filters, and how far their bitmaps differ; a later set once at a time."""
    word, keys, _, _, size, place, bits = entries
    size = size.astype(np.int32)
    rest = size - place.astype(np.int32)  # words of the set from this one on
    part = threshold / (1 + threshold)
    total = np.arange(2 * int(size.max(initial=0)) + 1)
    need = np.ceil(part * total - 1e-9).astype(np.int32)  # words to share, by the sum of both sizes; that both have them holds the sizes near
    kinds, where = np.unique(keys, return_inverse=True)
    maps = _maps(folder, kinds, shards)
    for a, b in _steps(word, size, threshold) if cut is None else _across(cut, len(word)):
        both = size[a] + size[b]
        least = need[both]
        good = np.minimum(rest[a], rest[b]) >= least
        a, b, differ = a[good], b[good], (both - 2 * least)[good]
        good = np.bitwise_count(bits[a] ^ bits[b]) <= differ
        a, b, differ = a[good], b[good], differ[good]
        if len(a):
            far = np.bitwise_count(maps[where[a]] ^ maps[where[b]]).sum(1).astype(np.int64)
            good = far <= differ
            for own in (good & (a < b), good & (a > b)):  # entries are in the order of the corpus
                if own.any():
                    yield np.maximum(a[own], b[own]), np.minimum(a[own], b[own]), far[own]


def _maps(folder: str, keys: np.ndarray, shards: int) -> np.ndarray:
    """The long bitmaps of sets whose keys are given in order."""
    out = np.zeros((len(keys), _MAP), np.uint64)
    edges = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(edges)):
        own = slice(edges[s], edges[s + 1])
        at, _ = find(mapped(folder, f"maps-{s}-keys", "u8"), keys[own])
        out[own] = mapped(folder, f"maps-{s}-values", "u8").reshape(-1, _MAP)[at]
    return out


def _nearest(folder: str, shards: int, threshold: float, listed: int) -> Callable:
    """For each later set of a shard of words its nearest earlier candidates, as many as are listed, and how many it has."""

    def run(entries: list[np.ndarray], cut: int | None) -> pa.Table:
        keys = entries[1]
        count = np.zeros(len(keys), np.int64)
        best = np.full((len(keys), listed), 1 << 40, np.int64)  # far << 32 | index, ascending
        for b, a, far in _candidates(entries, cut, folder, shards, threshold):  # each later set at most once at a time
            count[b] += 1
            best[b] = np.sort(np.column_stack([best[b], far << 32 | a]), 1)[:, :listed]
        has = np.flatnonzero(count)
        best, spot = best[has], _spot(entries[2], entries[3]).view(np.int64)
        used = best < 1 << 40
        near = best[used] & 0xFFFFFFFF
        rows = pa.StructArray.from_arrays(
            [pa.array(best[used] >> 32), pa.array(keys[near].view(np.int64)), pa.array(spot[near])], ["far", "earlier", "other"]
        )
        ends = np.concatenate(([0], np.cumsum(used.sum(1)))).astype(np.int32)
        return pa.table(
            [pa.array(keys[has].view(np.int64)), pa.array(spot[has]), pa.ListArray.from_arrays(ends, rows), pa.array(count[has])],
            ["later", "spot", "best", "n"],
        )

    return run


def _all_candidates(folder: str, shards: int, threshold: float) -> Callable:
    """All candidates of the sets whose keys are stored as open, one row for each pair at hand."""

    def run(entries: list[np.ndarray], cut: int | None) -> pa.Table:
        kinds, where = np.unique(entries[1], return_inverse=True)
        wanted = _stored(folder, "open", kinds, shards)[where]
        later, earlier = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b, a, _ in _candidates(entries, cut, folder, shards, threshold):
            later.append(b[wanted[b]])
            earlier.append(a[wanted[b]])
        both, spot = (np.concatenate(later), np.concatenate(earlier)), _spot(entries[2], entries[3])
        pairs = np.unique(np.stack([of[i] for of in (entries[1], spot) for i in both], 1), axis=0).view(np.int64)
        return pa.table([pa.array(pairs[:, i].copy()) for i in range(4)], ["later", "earlier", "spot", "other"])

    return run


def _words_of_open(folder: str, shards: int) -> Callable:
    """The words of a batch by which the sets stored as open were sent, moved to the top bits."""

    def run(batch: pa.RecordBatch) -> np.ndarray:
        found = [np.zeros(0, np.uint64)]
        for block in batch.column("block"):
            word, keys, *_ = unpack(block.as_py())
            kinds, where = np.unique(keys, return_inverse=True)
            found.append(np.unique(word[_stored(folder, "open", kinds, shards)[where]]) << np.uint64(64 - _BITS))
        return np.unique(np.concatenate(found))

    return run


def _sent_with(folder: str, shards: int) -> Callable:
    """The blocks' entries of stored words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block in zip(batch.column("shard").to_pylist(), batch.column("block"), strict=True):
                columns = unpack(block.as_py())
                keep = _stored(folder, "words", columns[0] << np.uint64(64 - _BITS), shards)  # a block is in the order of words
                if keep.any():
                    rows = [pa.array([shard], pa.int32()), pa.array([0], pa.int32()), pa.array([pack([c[keep] for c in columns])], pa.binary())]
                    yield pa.RecordBatch.from_arrays(rows, ["shard", "kind", "block"])

    return run


def _chunked(entries: list[np.ndarray], group: int) -> tuple[list[np.ndarray], pa.Table]:
    """The entries of words with at most ``group``, and those of the others in chunks of that size, in order."""
    word = entries[0]
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))[:len(word)])
    count = np.diff(first, append=len(word))
    rows = []
    for start, n in zip(first[count > group].tolist(), count[count > group].tolist(), strict=True):
        for at in range(0, n, group):
            block = pack([e[start + at:start + min(at + group, n)] for e in entries])
            rows.append((int(word[start]), at // group, -(-n // group), block))
    kinds = [("word", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()), ("block", pa.binary())]
    table = pa.table([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])
    small = np.repeat(count <= group, count)
    return [e[small] for e in entries], table


def _compared(merged: DataFrame, find: Callable, columns: str, group: int, label: str) -> DataFrame:
    """The rows that ``find`` gives for the entries of each shard of words, or of each two chunks of a word."""

    def words(key: tuple, table: pa.Table) -> pa.Table:
        entries, chunks = _chunked(_entries(table), group)
        return pa.concat_tables([find(entries, None), chunks], promote_options="default")

    def chunks(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("chunk").to_numpy())
        parts = [unpack(b) for b in table.column("block").take(pa.array(order)).to_pylist()]
        cut = len(parts[0][0]) if len(parts) == 2 else None
        return find([np.concatenate(c) for c in zip(*parts, strict=True)], cut)

    rows = stage(merged.groupBy("shard").applyInArrow(words, f"{columns}, word bigint, chunk int, chunks int, block binary"), label)
    twice = rows.where(F.col("block").isNotNull()).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    twice = twice.select("word", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "block")
    small = rows.where(F.col("block").isNull()).drop("word", "chunk", "chunks", "block")
    return small.unionByName(twice.groupBy("word", "low", "high").applyInArrow(chunks, columns))


def _first_column(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def _store(rows: DataFrame, folder: str, name: str, shards: int, values: Callable[[pa.RecordBatch], np.ndarray] = _first_column) -> None:
    """Write the distinct values of the only column, or what ``values`` finds in a batch, as sorted arrays, one file for each shard.

    ``rows`` come without a Python step of their own: two in a row need two workers a task, and Spark's pool then deals
    later tasks to all of them in turn, so that each comes to hold what an operator keeps (``byte_bpe``: 260 MB).
    """

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [values(b) for b in batches]
        if held:
            keys = np.unique(np.concatenate(held))
            yield blocks(0, shard_of(keys, shards), shards, [keys])

    def save(key: tuple, table: pa.Table) -> pa.Table:
        keys = np.unique(np.concatenate([unpack(b)[0] for b in table.column("block").to_pylist()]))
        put(folder, f"{name}-{key[0].as_py()}-keys", keys)
        return pa.table([pa.array([len(keys)], pa.int64())], ["n"])

    rows.mapInArrow(packed, BLOCKS).groupBy("shard").applyInArrow(save, "n bigint").agg(F.sum("n")).collect()


def _stored(folder: str, name: str, keys: np.ndarray, shards: int) -> np.ndarray:
    """Which keys, given in order, are in the stored arrays."""
    out = np.zeros(len(keys), bool)
    for s, own in _by_shard(keys, shards):
        try:
            out[own] = find(mapped(folder, f"{name}-{s}-keys", "u8"), keys[own])[1]
        except FileNotFoundError:
            continue
    return out


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """The shards of keys given in order, and where each one's keys stand."""
    shard = shard_of(keys, shards)
    first = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))[:len(shard)])
    for start, end in zip(first.tolist(), [*first[1:].tolist(), len(shard)], strict=True):
        yield int(shard[start]), slice(start, end)


def _sets_of(folder: str, name: str, shards: int) -> Callable:
    """The sets of the lines that stand at stored places (and of those at the same line of another text with the doc_id)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                texts = texts_of(piece.column("text"))
                cuts = _cuts(texts)
                row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(cuts[:-1], texts.offsets)))
                spot = _spot(_ids(piece)[row], np.arange(len(row)) - np.searchsorted(cuts, texts.offsets[row]))
                order = np.argsort(spot)
                at = np.sort(order[_stored(folder, name, spot[order], shards)])
                if not len(at):
                    continue
                length = np.diff(cuts)[at]
                lines = lines_of(Texts(texts.data[np.repeat(cuts[at], length) + runs(length)], np.concatenate(([0], np.cumsum(length)))))
                _, first = np.unique(lines.key, return_index=True)
                first.sort()
                wanted = np.zeros(len(lines.key), bool)
                wanted[first] = True
                ends = np.concatenate(([0], np.cumsum(lines.size[first]))).astype(np.int32)
                words = pa.array(lines.words[np.repeat(wanted, lines.size)].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(lines.key[first].view(np.int64)), pa.ListArray.from_arrays(ends, words)], ["key", "words"])

    return run


def _verified(pairs: DataFrame, docs: DataFrame, folder: str, name: str, shards: int, threshold: float) -> DataFrame:
    """The pairs (later, earlier, and where each stands) that are as alike as the threshold, by their full sets."""
    _store(pairs.select(F.explode(F.array("spot", "other")).alias("key")), folder, name, shards)
    sets = docs.select("doc_id", "text").mapInArrow(_sets_of(folder, name, shards), "key bigint, words array<bigint>").dropDuplicates(["key"])
    sets = stage(sets, "line-sets")
    pairs = pairs.join(sets.select(F.col("key").alias("later"), F.col("words").alias("a")), "later")
    pairs = pairs.join(sets.select(F.col("key").alias("earlier"), F.col("words").alias("b")), "earlier")
    both = F.size(F.array_intersect("a", "b"))
    return pairs.where(both >= threshold * (F.size("a") + F.size("b") - both) - 1e-9).select("later", "earlier")


def _removing(folder: str, shards: int, columns: list[str]) -> Callable:
    """Texts without the lines to remove, and how many those were."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                lines = lines_of(texts_of(piece.column("text")))
                gone = np.zeros(len(lines.key), bool)
                if len(gone):
                    order = np.argsort(lines.key)
                    kinds = lines.key[order]
                    gone[order] = _stored(folder, "near", kinds, shards)
                    own = _place_hash(*_places(piece, lines))
                    for s, part in _by_shard(kinds, shards):
                        keys = mapped(folder, f"repeated-{s}-keys", "u8")
                        values = mapped(folder, f"repeated-{s}-values", "u8").reshape(-1, 2)
                        at, known = find(keys, kinds[part])
                        rows, at = order[part][known], at[known]
                        for step in (0, 1):  # two sets with one first hash stand side by side
                            next_ = np.minimum(at + step, len(keys) - 1) if len(keys) else at
                            same = (keys[next_] == lines.key[rows]) & (values[next_, 0] == lines.key2[rows])
                            gone[rows[same]] |= values[next_[same], 1] != own[rows[same]]
                removed = np.bincount(lines.row[gone], minlength=piece.num_rows)
                out, rows = piece, np.flatnonzero(removed)
                if len(rows):
                    texts, ends = piece.column("text").to_pylist(), np.searchsorted(lines.row, rows, side="right")
                    for row, start, end in zip(rows.tolist(), np.searchsorted(lines.row, rows).tolist(), ends.tolist(), strict=True):
                        drop = set(lines.line[start:end][gone[start:end]].tolist())
                        texts[row] = "\n".join(x for i, x in enumerate(texts[row].split("\n")) if i not in drop)
                    out = piece.set_column(piece.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
                out = out.append_column("removed", pa.array(removed, pa.int64()))
                yield out.select([*columns, "removed"])
        give_back()

    return run


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD, listed: int = LISTED, group: int = GROUP) -> DataFrame:
    """``docs`` (doc_id, text, and what else there is) with later lines removed from the texts, and their number in ``removed``.

    ``listed`` candidates of each line are compared first, and a word of over ``group`` sets is split; neither changes a result.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "line-keys")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"))
    levels, words = rarity(texts)
    levels = spark.sparkContext.broadcast(levels)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words // SHARD_WORDS)
    merged = texts.mapInArrow(_lines_out(levels, threshold, shards), BLOCKS).groupBy("shard").applyInArrow(_sets_merged(folder, shards), BLOCKS)
    merged = stage(merged, "line-words")  # read by both rounds
    columns = "later bigint, spot bigint, best array<struct<far:bigint,earlier:bigint,other:bigint>>, n bigint"
    # the words of a set may be in several shards: the sum of n is at least its number of candidates
    nearest = _compared(merged, _nearest(folder, shards, threshold, listed), columns, group, "line-nearest")
    best = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("best")))), 1, listed)
    nearest = stage(nearest.groupBy("later").agg(F.first("spot").alias("spot"), best.alias("best"), F.sum("n").alias("n")), "line-candidates")
    pairs = nearest.select("later", "spot", F.inline("best")).drop("far")
    first = stage(_verified(pairs, texts, folder, "first", shards, threshold).select("later").distinct(), "line-matches")
    near = first
    open_ = stage(nearest.where(F.col("n") > F.size("best")).join(first, "later", "left_anti").select("later"), "line-open")
    if not open_.isEmpty():
        _store(open_, folder, "open", shards)
        _store(merged, folder, "words", shards, _words_of_open(folder, shards))
        few = merged.mapInArrow(_sent_with(folder, shards), BLOCKS)
        columns = "later bigint, earlier bigint, spot bigint, other bigint"
        pairs = _compared(few, _all_candidates(folder, shards, threshold), columns, group, "line-all").distinct()
        near = near.unionByName(_verified(stage(pairs, "line-pairs"), texts, folder, "second", shards, threshold).select("later"))
    _store(near, folder, "near", shards)
    fields = [f.name for f in docs.schema.fields]
    extra = [F.col(c) for c in fields if c not in ("doc_id", "text", "text_hash")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"), *extra)
    names = ["doc_id", "text", *[c for c in fields if c not in ("doc_id", "text", "text_hash")]]
    schema = StructType([*(rows.schema[c] for c in names), *StructType.fromDDL("removed bigint").fields])
    return rows.mapInArrow(_removing(folder, shards, names), schema)


def clean_lines(docs: DataFrame) -> DataFrame:
    """doc_id, the text without later lines, and how many were removed."""
    return deduplicate(docs.select("doc_id", "text")).select("doc_id", "text", "removed")


def remove_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with later lines removed and ``n_chars`` following the text; a text left without words is dropped if it lost lines."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = F.struct(*[F.col(f"`{c}`") for c in ("doc_id", *rest)]).alias("row")  # each text goes through Arrow once
    out = deduplicate(docs.select("doc_id", "text", kept)).where((F.col("removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[(new[c] if c in new else F.col("row")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
