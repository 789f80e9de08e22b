"""Documents as token pieces, packed into sequences by bin completion.

1. Texts become ids of a ``tokenizers`` vocabulary that lower-cases, drops white space and splits words from digits and signs. Each task
   cuts its texts with numpy into units that the vocabulary can never join (``_units``), encodes each new unit once and
   puts the ids together. A document ends with ``END``; pieces have ``SIZE`` tokens, its last one what is left. A task numbers its
   pieces of each length as it goes.
2. Spark counts the pieces of each length. A packing needs no more than these ``SIZE`` numbers: it is a list of fillings (how many pieces of
   which lengths) and how often each is used.
3. Bin completion: the largest piece left is completed by undominated fillings of the rest (``completions``), as many times at once as the
   counts allow, and once; small pieces are kept back where others leave no waste either. Depth-first with backtracking; a branch ends when its waste leaves no hope of fewer sequences than the
   incumbent's; best fit, largest first, is the first incumbent, and completes the first ``TAILS`` branches that end so. The search ends at the lower bound or after ``NODES`` steps with the
   best packing found, so that the result is whole in any case; below that budget it is optimal among packings with at
   most ``WIDTH`` fillings tried for a piece, of those found in ``TRIES`` steps.
4. A piece's number among those of its length (its task's first number plus its own) tells sequence and place, by bisection in a sorted table.
   Texts are never shuffled. The table has at most a row for each filling and length in it.

Null texts are empty: their only token is the end. Null and repeated ids are kept, each row is packed; equal rows may change places. An empty
table gives no rows. Other columns are not read. Units are compared by 64-bit hashes.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delayengine.llm.words import Texts, pieces, runs, spans_hashed, texts_of
from delayengine.session import stage

SIZE = 2048  # fixed value: tokens of a sequence
END = 0  # fixed value: the id after each document
NODES, TRIES, WIDTH, TAILS = 6000, 400, 6, 20
KEPT = 400_000  # units whose ids a worker remembers
TOGETHER = 512  # units encoded at once

# --- Tokens -------------------------------------------------------------------------

_SPACE_KIND, _LETTER, _DIGIT, _SIGN = 0, 1, 2, 3
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE_KIND
_KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = _LETTER
_KIND[48:58] = _DIGIT
# Bytes whose words stay whole: the apostrophe, and all that begin other code points than U+00C0 to U+024F.
_WHOLE = np.zeros(256, bool)
_WHOLE[[0x27, 0xC0, 0xC1, 0xC2, *range(0xCA, 0x100)]] = True
# Code points in that range which are no letters, or no single letter in lower case: U+00D7, U+00F7, U+0130.
_ODD_PAIRS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))


def _units(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, last byte plus one, and row of each unit, and whether it is a whole word that may need splitting.

    Words are separated by white space. In a word of ASCII and Latin letters without apostrophe each run of letters, each digit
    and each run of signs is a unit; any other word is one unit.
    """
    data, offsets = texts
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(bool)
    kind = _KIND[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    black = kind != _SPACE_KIND
    first = black.copy()
    first[1:] &= ~black[:-1] | edge[1:n]
    whole = _WHOLE[data]
    for a, b in _ODD_PAIRS:
        whole[1:] |= (data[1:] == b) & (data[:-1] == a)
    word = np.cumsum(first) - 1  # the word of each byte that is no space
    closed = np.bincount(word[whole & black], minlength=word[-1] + 1).astype(bool) if word[-1] >= 0 else np.zeros(1, bool)
    inner = black.copy()
    inner[0] = False
    inner[1:] &= black[:-1] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    inner &= ~closed[np.maximum(word, 0)]
    begin = first | inner
    starts = np.flatnonzero(begin)
    stop = np.empty(n, bool)
    stop[-1] = black[-1]
    stop[:-1] = black[:-1] & (begin[1:] | ~black[1:])
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(offsets, starts, side="right") - 1, closed[np.maximum(word[starts], 0)]


class _Encoder:
    """The ids of units, each encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        known = self.tokenizer.get_vocab()
        self.last = np.zeros(max(known.values()) + 1, bool)  # ids that end a word
        if suffix := getattr(self.tokenizer.model, "end_of_word_suffix", None):
            self.last[[i for token, i in known.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.place: dict[int, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.counts = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, hashes: list[int], texts: list[str], plain: int) -> None:
        """Encode the texts; the first ``plain`` of them are single words, so many go at once."""
        found, counts = [], []
        for start in range(0, plain, TOGETHER):
            own = texts[start:min(start + TOGETHER, plain)]
            ids = self._ids([" ".join(own)])[0]
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(own) or ends[-1] != len(ids):
                alone = self._ids(own)
                ids, ends = np.concatenate(alone), np.cumsum([len(x) for x in alone])
            found.append(ids)
            counts.append(np.diff(ends, prepend=0))
        alone = self._ids(texts[plain:])
        ids = np.concatenate([*found, *alone])
        counts = np.concatenate([*counts, np.array([len(x) for x in alone], np.int64)]).astype(np.int64)
        at, total = len(self.place), len(ids)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while at + len(counts) > len(self.starts):
            self.starts, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.counts))
        self.ids[self.used:self.used + total] = ids
        self.starts[at:at + len(counts)] = self.used + np.cumsum(counts) - counts
        self.counts[at:at + len(counts)] = counts
        self.used += total
        self.place.update(zip(hashes, range(at, at + len(counts)), strict=True))

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts with ``END`` after each text, and the number of ids of each."""
        rows = len(texts)
        starts, ends, row, whole = _units(texts)
        kinds, first, inverse = np.unique(spans_hashed(texts.data, starts, ends), return_index=True, return_inverse=True)
        if len(self.place) > KEPT:
            self.forget()
        hashes = kinds.tolist()
        new = [i for i, h in enumerate(hashes) if h not in self.place]
        if new:
            raw = texts.data.tobytes()
            new = np.array(new)
            new = new[np.argsort(whole[first[new]], kind="stable")]
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            self._add(kinds[new].tolist(), [raw[a:b].decode() for a, b in spans], int((~whole[first[new]]).sum()))
        place = np.fromiter((self.place[h] for h in hashes), np.int64, len(hashes))[inverse]
        counts = self.counts[place]
        sizes = np.bincount(row, counts, rows).astype(np.int64) + 1
        ids = np.full(int(sizes.sum()), END, np.uint32)
        inside = np.ones(len(ids), bool)
        inside[np.cumsum(sizes) - 1] = False
        ids[inside] = self.ids[np.repeat(self.starts[place], counts) + runs(counts)]
        return ids, sizes


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _pieces_of(path: str, size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(size + 1, np.int64)
        for batch in batches:
            for piece in pieces(batch):
                ids, sizes = encoder(path).encode(texts_of(piece.column("text")))
                cuts = -(-sizes // size)
                number = runs(cuts)
                length = np.minimum(size, np.repeat(sizes, cuts) - number * size)
                ends = np.cumsum(length)
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - length).tolist(), ends.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                nth = np.empty(len(length), np.int64)
                kinds, times = np.unique(length, return_counts=True)
                nth[order] = runs(times) + np.repeat(met[kinds], times)
                met[kinds] += times
                owner = pa.array(np.repeat(np.arange(piece.num_rows), cuts))
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id").take(owner), pa.array(number, pa.int32()), pa.array(number * size, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(sums, pa.int64()), piece.column("task").take(owner), pa.array(nth, pa.int64()),
                ], ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return run


def token_pieces(docs: DataFrame, vocabulary: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece; its task, and its number among the task's pieces of its length."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.shiftright(F.monotonically_increasing_id(), 33).alias("task"))
    return rows.mapInArrow(
        _pieces_of(vocabulary, size), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task long, nth long"
    )


# --- Packing ------------------------------------------------------------------------


class Filling(NamedTuple):
    """A sequence's pieces, as lengths in falling order, and how many sequences are filled so."""

    lengths: tuple[int, ...]
    times: int


def lower_bound(counts: list[int], size: int) -> int:
    """No packing has fewer sequences: the bound of Martello and Toth over all thresholds."""
    n = np.array(counts, object)
    total, number = np.cumsum(n * np.arange(len(n))), np.cumsum(n)
    half, best = size // 2, -(-int(total[-1]) // size)
    for k in range(half + 1):
        large = number[-1] - number[size - k]
        middle, held = number[size - k] - number[half], total[size - k] - total[half]
        small = total[half] - (total[k - 1] if k else 0)
        best = max(best, int(large + middle + max(0, -(-(small - (middle * size - held)) // size))))
    return best


def best_fit(counts: list[int], size: int) -> list[Filling]:
    """Pieces from the largest down, each into the fullest sequence that takes it; equal ones at once."""
    room: list[list[list]] = [[] for _ in range(size + 1)]  # fillings by the room they leave, each with its number
    for length in range(size, 0, -1):
        left = counts[length]
        at = length
        while left:
            while at < size and not room[at]:
                at += 1
            lengths, times = room[at].pop() if at < size else ((), left)
            copies = at // length
            full = min(times, left // copies)
            rest = left - full * copies if full < times and left - full * copies < copies else 0
            if full:
                room[at - copies * length].append([lengths + (length,) * copies, full])
            if rest:
                room[at - rest * length].append([lengths + (length,) * rest, 1])
            if at < size and times > full + (rest > 0):
                room[at].append([lengths, times - full - (rest > 0)])
            left -= full * copies + rest
    return [Filling(lengths, times) for group in room for lengths, times in group]


def completions(counts: list[int], room: int, tries: int = TRIES, width: int = WIDTH) -> list[tuple[int, ...]]:
    """Undominated sets of pieces for ``room``, least waste first; larger pieces first among equal waste.

    A set is dominated if a piece left over could stand for one of its pieces, or for two together, and still fit. One piece
    that fills the room dominates all others.
    """
    below = [0] * (room + 1)  # the largest length up to here
    for length in range(1, room + 1):
        below[length] = length if counts[length] else below[length - 1]
    if not below[room]:
        return [()]
    if below[room] == room:
        return [(room,)]
    found: list[tuple[int, tuple[int, ...]]] = []
    first: list[tuple[int, ...]] = []
    used: dict[int, int] = {}
    steps = 0

    def free(top: int) -> int:
        """The largest length up to ``top`` of which a piece is left."""
        length = below[min(top, room)]
        while length and used.get(length, 0) >= counts[length]:
            length = below[length - 1]
        return length

    def dominated(waste: int) -> bool:
        own = [x for x, n in used.items() if n]
        pairs = {a + b for i, a in enumerate(own) for b in own[i + (used[a] < 2):]}
        return any(free(x + waste) > x for x in own) or any(free(x + waste) >= x for x in pairs)

    def search(left: int, top: int) -> bool:
        """False when enough has been seen."""
        nonlocal steps
        length = free(min(left, top))
        if not length:
            if not free(left):
                lengths = tuple(x for x, n in used.items() for _ in range(n))
                if not first:
                    first.append(lengths)
                if not dominated(left):
                    found.append((left, lengths))
                    return not (left == 0 and len(found) >= width)
            return True
        while length:
            for copies in range(min(counts[length], left // length), 0, -1):
                steps += 1
                used[length] = copies
                on = search(left - copies * length, length - 1)
                del used[length]
                if not on or steps > tries:
                    return False
            length = free(min(left, length - 1))
        return True

    search(room, room)
    found.sort(key=lambda x: (x[0], tuple(-y for y in x[1])))
    return [lengths for _, lengths in found[:width]] or first


def _options(counts: list[int], top: int, size: int, spare: int) -> list[Filling]:
    """What may be done with the largest piece left: each completion as often as the counts allow, and once.

    Fillings without waste and without pieces below ``spare`` are taken alone: small pieces serve best at the end.
    """
    counts[top] -= 1
    small = counts[1:spare]
    counts[1:spare] = [0] * len(small)
    rests = [r for r in completions(counts, size - top) if sum(r) == size - top] if top >= 2 * spare else []
    counts[1:spare] = small
    rests = rests or completions(counts, size - top)
    counts[top] += 1
    often, once = [], []
    for rest in rests:
        lengths = (top, *rest)
        most = min(counts[x] // lengths.count(x) for x in set(lengths))
        often.append(Filling(lengths, most))
        if most > 1:
            once.append(Filling(lengths, 1))
    return often + once


def _searched(counts: list[int], size: int, spare: int, nodes: int, best: list[Filling], bound: int) -> list[Filling]:
    """``best`` or a packing in fewer sequences."""
    counts, total = list(counts), sum(length * c for length, c in enumerate(counts))
    fewest, tails = sum(f.times for f in best), TAILS
    plan: list[Filling] = []
    made, left, waste = 0, total, 0

    def frame(top: int) -> tuple[Iterator[Filling], int]:
        while not counts[top]:
            top -= 1
        return iter(_options(counts, top, size, spare)), top

    stack = [frame(size)]
    while stack and nodes > 0 and fewest > bound:
        nodes -= 1
        step = next(stack[-1][0], None)
        if step is None:
            stack.pop()
            if plan:
                undone = plan.pop()
                for x in undone.lengths:
                    counts[x] += undone.times
                held = undone.times * sum(undone.lengths)
                made, left, waste = made - undone.times, left + held, waste - (undone.times * size - held)
            continue
        held = step.times * sum(step.lengths)
        wasted = waste + step.times * size - held
        if made + step.times >= fewest or left > held and -(-(total + wasted) // size) >= fewest:
            if tails and plan:  # what is left, by best fit
                tails -= 1
                rest = best_fit(counts, size)
                if made + sum(f.times for f in rest) < fewest:
                    best, fewest = plan + rest, made + sum(f.times for f in rest)
            continue
        for x in step.lengths:
            counts[x] -= step.times
        plan.append(step)
        made, left, waste = made + step.times, left - held, wasted
        if left:
            stack.append(frame(stack[-1][1]))
        else:
            best, fewest = list(plan), made
            stack.append((iter(()), 0))  # nothing is left to choose: the step is taken back
    return best


def pack(counts: list[int], size: int = SIZE, nodes: int = NODES) -> list[Filling]:
    """Fillings for ``counts[length]`` pieces of each length, in as few sequences as the search finds."""
    counts = [int(c) for c in counts]
    bound, best = lower_bound(counts, size), best_fit(counts, size)
    for spare in (size // 16, size // 10, 1):  # small pieces kept back first, then not
        if sum(f.times for f in best) > bound:
            best = _searched(counts, size, max(1, spare), nodes // 3, best, bound)
    return best


# --- Places -------------------------------------------------------------------------


class Places(NamedTuple):
    """Intervals of numbers of pieces of a length, in order: ``copies`` stand in each of the sequences from ``first`` on."""

    key: np.ndarray  # length << 40 | first number
    sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray


def places(plan: list[Filling]) -> Places:
    rows, done, first = [], {}, 0
    for lengths, times in plan:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            copies = lengths.count(length)
            low = done.get(length, 0)
            rows.append((length << 40 | low, first, copies, offset))
            done[length] = low + copies * times
            offset += copies * length
        first += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 4).T
    return Places(*columns)


def _placed(shared, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            at = np.searchsorted(own.key, length << 40 | number, side="right") - 1
            past = number - (own.key[at] & ((1 << 40) - 1))
            sequence = own.sequence[at] + past // own.copies[at]
            offset = own.offset[at] + past % own.copies[at] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return run


def packed(docs: DataFrame, vocabulary: str, size: int = SIZE, nodes: int = NODES) -> DataFrame:
    """Each piece with its sequence and its place there; sequences are filled from 0 without a gap."""
    found = stage(token_pieces(docs, vocabulary, size), "token-pieces")
    tally = stage(found.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-lengths")
    counts = [0] * (size + 1)
    for row in tally.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        counts[row.length] = row.n
    shared = docs.sparkSession.sparkContext.broadcast(places(pack(counts, size, nodes)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = stage(tally.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "piece-numbers")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = found.join(firsts, ["length", "task"]).select(*names, (F.col("before") + F.col("nth")).alias("number"))
    kind = found.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _placed(shared, names), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
