"""Collocations of two to four words, by a weighted de Bruijn graph of the words of each language.

A word (lower case, A-Z only) is a run of bytes other than space and tab inside a piece; pieces end at . , ; : ! ? and U+000A to U+000D.

1. Words are counted first; each travels once for each task's dictionary, with its text. Those below ``least`` can't stand in a
   candidate: from here on a piece also ends before and after them, which changes no count of the others. The frequent words' hashes are sorted
   arrays below the shared folder, which workers map into memory; a word's place in them is its number from here on, 0 is the end mark.
2. Each position gives the window of four words that begins there; where the piece ends sooner, the window ends in end marks. A
   window is an edge from its first three words to its last three. Tasks sum windows in numpy and hand each shard,
   chosen by the three words an edge leaves from, one compressed block. No shorter run of words is counted:
   three words occur as often as the edges that leave them, two words as often as the three-word nodes they begin,
   plus the pieces that end there (windows with end marks). Two words are summed from the shards' sums in a second, smaller exchange.
3. Edges and nodes below ``least`` can neither be candidates nor parts of one. In what is left, a node whose flow is that of its only edge
   in and of its only edge out is passed through: such unary paths are compacted by pointer doubling into one row of
   words with one count. Longest grams and the counts inside a path are read off it; ends of paths take theirs from the node's flow.
4. Candidates inside a longer one that is nearly as frequent go. Scores are integers (decimals, so products may pass 64 bits).

Words are told apart by 64-bit hashes of word and language; two words of one hash are found in step 1 and raise an error. Shards are as
many as the texts' bytes ask for (``SHARD_BYTES`` each), so no task grows with the corpus. A shard's node is never split: a node has at most
one edge for each word.

Null texts are empty, a null lang is ``und``; ids and other columns are not read, repeated rows count each time. Texts
without words and empty tables give no rows. Ties in score go to the larger count, then to the phrase in byte order.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delayengine.llm.packed import BLOCKS, pack, shard_of, unpack
from delayengine.llm.scratch import give_back, mapped, put
from delayengine.llm.words import _LOWER, find, mix, mixed, pieces, runs, texts_of, words_of
from delayengine.session import new_folder, stage

LEAST = 30  # fixed value: occurrences of a candidate
NEARLY = (4, 5)  # fixed value: a longer candidate of this part of the count drops a shorter one
SCORED = 2_000_000  # fixed value
BEST = 2000  # fixed value: phrases reported for each language
SHARD_BYTES = 8 << 20
WORD_SHARD_BYTES = 24 << 20
UNIT = 700_000  # words that a task sums at once
_STEP = 50_000  # words whose bytes are compared at once
_CODES = 65_535
_STOP = np.zeros(256, bool)
_STOP[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BREAK = _STOP.copy()
_BREAK[[0x09, 0x20]] = True
_END = 0
_FOUND = "what int, shard int, block binary, w1 long, w2 long, w3 long, w4 long, n long, lang string, word string"
_EDGE, _NODE, _PAIRS, _WORD, _TOTAL = 4, 3, 2, 1, 0  # what a row of the merged shards is


# --- Windows of a task --------------------------------------------------------------


def _joined(head: bytes, tail: bytes) -> bytes:
    return np.uint32(len(head)).tobytes() + head + tail


def _parted(block: bytes) -> tuple[bytes, bytes]:
    cut = 4 + int(np.frombuffer(block, np.uint32, 1)[0])
    return block[4:cut], block[cut:]


class _Piece:
    """Words of some texts as numbers into a sorted dictionary, and how many words follow each in its piece."""

    def __init__(self, batch: pa.RecordBatch):
        texts = texts_of(batch.column("text"))
        found = words_of(texts, _BREAK)
        langs = batch.column("lang").to_pylist()
        self.langs = sorted(set(langs))
        of_row = np.searchsorted(self.langs, langs) if langs else np.zeros(0, np.int64)
        salt = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs], np.uint64)
        ids = mix(found.hashes ^ salt[of_row[found.rows]])
        self.size = len(ids)
        self.ids, first, self.at = np.unique(ids, return_index=True, return_inverse=True)
        self.lang = of_row[found.rows[first]].astype(np.uint16)
        self.length = (found.ends - found.starts)[first].astype(np.uint32)
        self.text = _LOWER[texts.data[np.repeat(found.starts[first], self.length) + runs(self.length.astype(np.int64))]]
        stops = np.cumsum(_STOP[texts.data])[found.starts] if self.size else np.zeros(0, np.int64)
        self.more = np.zeros(self.size, bool)  # whether a word follows
        self.more[:-1] = (found.rows[1:] == found.rows[:-1]) & (stops[1:] == stops[:-1])


def _windows(ids: np.ndarray, more: np.ndarray, start: int, stop: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Distinct windows that begin in [start, stop), in order, as four arrays of words, and how often; in parts of few enough words."""
    kinds, codes = np.unique(ids[start:stop + 3], return_inverse=True)
    if len(kinds) > _CODES and stop - start > 1:
        middle = (start + stop) // 2
        yield from _windows(ids, more, start, middle)
        yield from _windows(ids, more, middle, stop)
        return
    n = stop - start
    codes = np.concatenate([codes.astype(np.uint64) + np.uint64(1), np.zeros(3, np.uint64)])
    follows = np.concatenate([more[start:stop + 2], np.zeros(3, bool)])
    keys, inside = codes[:n] << np.uint64(48), np.ones(n, bool)
    for k in (1, 2, 3):
        inside &= follows[k - 1:n + k - 1]
        keys |= np.where(inside, codes[k:n + k], 0).astype(np.uint64) << np.uint64(48 - 16 * k)
    keys = keys[follows[:n]]  # the counts of single words are known
    if not len(keys):
        return
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts, keys = np.diff(first, append=len(keys)), keys[first]
    kinds = np.concatenate([np.zeros(1, ids.dtype), kinds])
    yield (*(kinds[(keys >> np.uint64(48 - 16 * k) & np.uint64(0xFFFF)).astype(np.int64)] for k in range(4)), counts)


def _flat(column: np.ndarray) -> list[np.ndarray]:
    """Numbers below 2^32 as four columns of bytes, which compress better."""
    return list(np.ascontiguousarray(column.astype("<u4")).view(np.uint8).reshape(-1, 4).T)


def _numbers(bytes_: list[np.ndarray]) -> np.ndarray:
    return sum(b.astype(np.uint64) << np.uint64(8 * i) for i, b in enumerate(bytes_))


def _sum_blocks(words: list[np.ndarray], counts: np.ndarray, shard: np.ndarray, shards: int) -> pa.RecordBatch:
    """A block for each shard: the columns of words, in order, and their counts."""
    order = np.argsort(shard.astype(np.int16) if shards < 1 << 15 else shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    used, packed = np.flatnonzero(np.diff(edges)), []
    words, counts = [w[order] for w in words], counts[order].astype(np.uint64)
    for s in used:
        own = slice(edges[s], edges[s + 1])
        low, high = counts[own] & np.uint64(0xFFFFFFFF), counts[own] >> np.uint64(32)
        packed.append(pack([x for c in (*(w[own] for w in words), low, high) for x in _flat(c)]))
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(np.zeros(len(used)), pa.int32()), pa.array(packed, pa.binary())], ["shard", "kind", "block"]
    )


def _sums_in(block: bytes) -> list[np.ndarray]:
    """The columns of words as 32-bit numbers, the counts last."""
    raw = unpack(block)
    *words, low, high = (_numbers(raw[i:i + 4]) for i in range(0, len(raw), 4))
    return [*(w.astype(np.uint32) for w in words), (low | high << np.uint64(32)).astype(np.int64)]


def _shard_of(words: list[np.ndarray], shards: int) -> np.ndarray:
    return shard_of(mixed(*(w.astype(np.uint64) for w in words)), shards)


def _bytes_at(flat: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    length = length.astype(np.int64)
    return flat[np.repeat(starts, length) + runs(length)]


def _taken(flat: np.ndarray, length: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The bytes of the chosen words."""
    starts = np.cumsum(length.astype(np.int64)) - length
    return _bytes_at(flat, starts[chosen], length[chosen])


def _word_blocks(ids, counts, lang, length, flat, langs: list[str], shards: int) -> pa.RecordBatch:
    """Words with their counts, in order of the id; languages stand in front."""
    shard = shard_of(ids, shards)
    edges = np.searchsorted(shard, np.arange(shards + 1))
    ends = np.concatenate(([0], np.cumsum(length.astype(np.int64))))
    used, packed, names = np.flatnonzero(np.diff(edges)), [], json.dumps(langs).encode()
    for s in used:
        own = slice(edges[s], edges[s + 1])
        body = _joined(pack([ids[own], counts[own], lang[own], length[own]]), pack([flat[ends[edges[s]]:ends[edges[s + 1]]]]))
        packed.append(_joined(names, body))
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(np.zeros(len(used)), pa.int32()), pa.array(packed, pa.binary())], ["shard", "kind", "block"]
    )


def _dictionary(parts: list[_Piece], shards: int) -> pa.RecordBatch:
    """The words of some pieces, each once."""
    langs = sorted({x for p in parts for x in p.langs})
    kinds, first, inverse = np.unique(np.concatenate([p.ids for p in parts]), return_index=True, return_inverse=True)
    counts = np.bincount(inverse, np.concatenate([np.bincount(p.at, minlength=len(p.ids)) for p in parts]), len(kinds)).astype(np.int64)
    lang = np.concatenate([np.searchsorted(langs, p.langs)[p.lang] for p in parts]).astype(np.uint16)
    length, flat = np.concatenate([p.length for p in parts]), np.concatenate([p.text for p in parts])
    return _word_blocks(kinds, counts, lang[first], length[first], _taken(flat, length, first), langs, shards)


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[list[_Piece]]:
    parts: list[_Piece] = []
    size = 0
    for batch in batches:
        for piece in pieces(batch):
            part = _Piece(piece)
            if part.size:
                parts.append(part)
                size += part.size
            if size >= UNIT:
                yield parts
                parts, size = [], 0
    if parts:
        yield parts


def _counted_words(shards: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _units(batches):
            yield _dictionary(parts, shards)
        give_back()

    return run


def _numbered(folder: str, firsts: list[int], ids: np.ndarray) -> np.ndarray:
    """The numbers of the sorted ids, 0 for those that aren't frequent. ``firsts`` is the first number of each shard."""
    out = np.zeros(len(ids), np.uint32)
    edges = np.searchsorted(shard_of(ids, len(firsts)), np.arange(len(firsts) + 1))
    for s in np.flatnonzero(np.diff(edges)):
        at, known = find(mapped(folder, f"frequent-{s}", "u8"), ids[edges[s]:edges[s + 1]])
        out[edges[s]:edges[s + 1]] = np.where(known, at + firsts[s], 0)
    return out


def _summed(folder: str, firsts: list[int], shards: int) -> Callable:
    """Windows of frequent words: a rare one ends a piece before and after it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _units(batches):
            words, more = [], []
            for p in parts:
                own = _numbered(folder, firsts, p.ids)[p.at]
                follows = p.more & (own > 0)
                follows[:-1] &= own[1:] > 0
                words.append(own)
                more.append(follows)
            flat = np.concatenate(words)
            for *grams, counts in _windows(flat, np.concatenate(more), 0, len(flat)):
                yield _sum_blocks(grams, counts, _shard_of(grams[:3], shards), shards)
        give_back()

    return run


# --- Shards -------------------------------------------------------------------------


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where rows in order differ from the one before."""
    return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])))[:len(columns[0])])


def _merged_sums(blocks: list[bytes]) -> list[np.ndarray]:
    """Distinct rows of words, in order, with the sum of their counts."""
    *words, counts = (np.concatenate(c) for c in zip(*(_sums_in(b) for b in blocks), strict=True))
    pairs = [words[i].astype(np.uint64) << np.uint64(32) | words[i + 1] for i in range(0, len(words), 2)]
    order = np.lexsort(pairs[::-1])
    pairs = [p[order] for p in pairs]
    first = _firsts(*pairs)
    return [*(w[order[first]] for w in words), np.add.reduceat(counts[order], first)]


def _rows(what: int, n: np.ndarray, words: list[np.ndarray] = (), lang=None, text=None) -> pa.Table:
    size = len(n)
    blank = lambda kind: pa.nulls(size, kind)
    four = [pa.array(words[i].astype(np.int64)) if i < len(words) else blank(pa.int64()) for i in range(4)]
    return pa.table([
        pa.array(np.full(size, what), pa.int32()), blank(pa.int32()), blank(pa.binary()), *four, pa.array(n, pa.int64()),
        blank(pa.string()) if lang is None else pa.array(lang, pa.string()), blank(pa.string()) if text is None else pa.array(text, pa.string()),
    ], _FOUND_NAMES)


_FOUND_NAMES = [x.split()[0] for x in _FOUND.split(", ")]


def _merged_grams(shards: int, least: int) -> Callable:
    """Edges and nodes of at least ``least``, and the sums for two words as blocks."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        *edges, counts = _merged_sums(table.column("block").to_pylist())
        heavy = (counts >= least) & (edges[3] != _END)
        first = _firsts(*edges[:3])
        nodes, flow = [e[first] for e in edges[:3]], np.add.reduceat(counts, first)
        strong = (flow >= least) & (nodes[2] != _END)
        first = _firsts(*nodes[:2])
        pairs, partial = [x[first] for x in nodes[:2]], np.add.reduceat(flow, first)
        packed = _sum_blocks(pairs, partial, _shard_of(pairs, shards), shards)
        size = packed.num_rows
        sums = pa.table([
            pa.array(np.full(size, _PAIRS), pa.int32()), packed.column("shard"), packed.column("block"),
            *[pa.nulls(size, pa.int64())] * 5, *[pa.nulls(size, pa.string())] * 2,
        ], _FOUND_NAMES)
        out = pa.concat_tables([
            _rows(_EDGE, counts[heavy], [e[heavy] for e in edges]), _rows(_NODE, flow[strong], [x[strong] for x in nodes]), sums,
        ])
        del edges, counts, nodes, flow
        give_back()
        return out

    return run


def _merged_words(folder: str, least: int) -> Callable:
    """Words of at least ``least``, stored in order and returned with place and text; and how many words each language has here."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        names, parts, flats = [], [], []
        for block in table.column("block").to_pylist():
            head, body = _parted(block)
            langs, (columns, flat) = json.loads(head), _parted(body)
            ids, counts, lang, length = unpack(columns)
            parts.append([ids, counts, lang.astype(np.int64) + len(names), length])
            names += langs
            flats.append(unpack(flat)[0])
        ids, counts, lang, length = (np.concatenate(c) for c in zip(*parts, strict=True))
        flat = np.concatenate(flats)
        known = sorted(set(names))
        lang = np.searchsorted(known, names)[lang]
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], ids[order][1:] != ids[order][:-1])))
        chosen = np.repeat(order[first], np.diff(first, append=len(ids)))  # the word that stands for each entry
        starts = np.cumsum(length.astype(np.int64)) - length
        if (lang[chosen] != lang[order]).any() or (length[chosen] != length[order]).any():
            raise ValueError("two words have one hash")
        for at in range(0, len(order), _STEP):
            one, other = order[at:at + _STEP], chosen[at:at + _STEP]
            one, other = one[one != other], other[one != other]
            if (_bytes_at(flat, starts[one], length[one]) != _bytes_at(flat, starts[other], length[other])).any():
                raise ValueError("two words have one hash")
        total = np.add.reduceat(counts[order], first)
        of_lang = np.bincount(lang[order], counts[order], len(known)).astype(np.int64)
        keep = total >= least
        chosen = order[first][keep]
        put(folder, f"frequent-{key[0].as_py()}", ids[chosen])
        raw, ends = _taken(flat, length, chosen).tobytes(), np.cumsum(length[chosen].astype(np.int64)).tolist()
        texts = [raw[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]
        found = _rows(_WORD, total[keep], [np.arange(len(chosen))], [known[x] for x in lang[chosen]], texts)
        found = found.set_column(1, "shard", pa.array(np.full(len(chosen), key[0].as_py()), pa.int32()))
        give_back()
        return pa.concat_tables([found, _rows(_TOTAL, of_lang, lang=known)])

    return run


def _merged_pairs(least: int) -> Callable:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        *pairs, n = _merged_sums(table.column("block").to_pylist())
        keep = n >= least
        give_back()
        return pa.table([*(pa.array(p[keep].astype(np.int64)) for p in pairs), pa.array(n[keep])], ["w1", "w2", "n"])

    return run


class Graph:
    """Edges, nodes, pairs and words that occur at least ``least`` times, and the number of words of each language."""

    def __init__(self, docs: DataFrame, least: int = LEAST, shard_bytes: int = SHARD_BYTES):
        rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        shards, word_shards = size // shard_bytes + 1, size // WORD_SHARD_BYTES + 1
        folder = new_folder(docs.sparkSession, "phrase-words")
        words = rows.mapInArrow(_counted_words(word_shards), BLOCKS).groupBy("shard").applyInArrow(_merged_words(folder, least), _FOUND)
        words = stage(words, "phrase-words")
        listed = words.where(F.col("what") == _WORD)
        many = {r.shard: r["count"] for r in listed.groupBy("shard").count().collect()}  # a number for each shard
        firsts = [1]
        for s in range(word_shards):
            firsts.append(firsts[-1] + many.get(s, 0))
        first = F.element_at(F.lit(firsts[:-1]).cast("array<long>"), F.col("shard") + 1)
        self.words = listed.select("lang", (first + F.col("w1")).alias("id"), "word", "n")
        self.totals = words.where(F.col("what") == _TOTAL).groupBy("lang").agg(F.sum("n").alias("n"))
        counted = rows.mapInArrow(_summed(folder, firsts[:-1], shards), BLOCKS)
        found = stage(counted.groupBy("shard").applyInArrow(_merged_grams(shards, least), _FOUND), "phrase-graph")
        of = lambda what: found.where(F.col("what") == what)
        self.edges = of(_EDGE).select("w1", "w2", "w3", "w4", "n")
        self.nodes = of(_NODE).select("w1", "w2", "w3", "n")
        pairs = of(_PAIRS).select("shard", "block").groupBy("shard").applyInArrow(_merged_pairs(least), "w1 long, w2 long, n long")
        self.pairs = stage(pairs, "phrase-pairs")


# --- Unary paths --------------------------------------------------------------------


def compacted(graph: Graph) -> DataFrame:
    """The edges as maximal unary paths: ``words`` (four or more), their common count ``n``, and the flows ``first`` and ``last`` of the end nodes."""
    out = graph.edges.groupBy("w1", "w2", "w3").agg(F.count(F.lit(1)).alias("outs"), F.max("n").alias("out_n"))
    into = graph.edges.groupBy(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("w4").alias("w3"))
    into = into.agg(F.count(F.lit(1)).alias("ins"), F.max("n").alias("in_n"), F.max("w1").alias("w0"))
    at = ["w1", "w2", "w3"]
    flows = graph.nodes.join(out, at, "left").join(into, at, "left")
    unary = (F.col("outs") == 1) & (F.col("ins") == 1) & (F.col("out_n") == F.col("n")) & (F.col("in_n") == F.col("n"))
    nodes = stage(flows.select(*at, F.col("n").alias("flow"), F.when(unary, F.col("w0")).alias("w0")), "phrase-nodes")
    edge = lambda *w: F.struct(*[F.col(x).alias(f"e{i}") for i, x in enumerate(w)])
    edges = graph.edges.join(nodes, at).select(
        edge("w1", "w2", "w3", "w4").alias("edge"), "n", F.col("flow").alias("first"),
        F.when(F.col("w0").isNotNull(), edge("w0", "w1", "w2", "w3")).alias("up"),
    )
    ends = nodes.select(F.col("w1").alias("x2"), F.col("w2").alias("x3"), F.col("w3").alias("x4"), F.col("flow").alias("last"))
    same = (F.col("edge.e1") == F.col("x2")) & (F.col("edge.e2") == F.col("x3")) & (F.col("edge.e3") == F.col("x4"))
    edges = stage(edges.join(ends, same).drop("x2", "x3", "x4"), "phrase-edges")
    # where each edge's pointer stands and how far up; it ends at an edge without an edge above it
    links = stage(edges.where("up is not null").select("edge", F.col("up").alias("head"), F.lit(1).cast("long").alias("far")), "phrase-links")
    moving = links
    done = None
    while not moving.isEmpty():
        higher = moving.select(F.col("edge").alias("head"), F.col("head").alias("next"), F.col("far").alias("step"))
        moved = stage(moving.join(higher, "head", "left").select(
            "edge", F.coalesce("next", "head").alias("head"), (F.col("far") + F.coalesce("step", F.lit(0))).alias("far"), F.col("next").isNull().alias("ended"),
        ), "phrase-links")
        # a pointer that has ended may still be asked for by others, so it stays among the moving ones until all have ended
        if moved.where("not ended").isEmpty():
            done = moved
            break
        moving = moved.drop("ended")
    if done is not None:
        edges = edges.join(done.select("edge", "head", "far"), "edge", "left")
    else:
        edges = edges.withColumns({"head": F.lit(None).cast(edges.schema["edge"].dataType), "far": F.lit(None).cast("long")})
    path = F.coalesce("head", "edge")
    far = F.coalesce("far", F.lit(0).cast("long"))
    grouped = edges.groupBy(path.alias("path")).agg(
        F.array_sort(F.collect_list(F.struct(far.alias("far"), F.col("edge.e3").alias("word")))).alias("tail"), F.max("n").alias("n"),
        F.min_by("first", far).alias("first"), F.max_by("last", far).alias("last"),
    )
    return grouped.select(F.concat(F.array("path.e0", "path.e1", "path.e2"), F.col("tail.word")).alias("words"), "n", "first", "last")


def long_phrases(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The unary paths as text: the longest phrases none of whose parts of three words leads anywhere else."""
    graph = Graph(docs, least)
    paths = stage(compacted(graph), "phrase-paths").withColumn("key", F.xxhash64("words"))
    return _spelled(paths, graph, "words").select("lang", "phrase", "n")


def _spelled(rows: DataFrame, graph: Graph, ids: str) -> DataFrame:
    """``rows`` with ``lang`` and ``phrase`` for the array ``ids``."""
    flat = rows.select(ids).distinct().select(F.col(ids), F.posexplode(ids).alias("place", "id")).join(graph.words.select("id", "lang", "word"), "id")
    texts = flat.groupBy(ids).agg(F.max("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("found"))
    return rows.join(texts.select(ids, "lang", F.concat_ws(" ", "found.word").alias("phrase")), ids)


# --- Candidates ---------------------------------------------------------------------


def _wide(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def _kept(rows: DataFrame, longer: DataFrame, at: list[str]) -> DataFrame:
    """``rows`` without those of which ``longer`` (the same words and ``m``) has one nearly as frequent."""
    most = longer.groupBy(*at).agg(F.max("m").alias("m"))
    part, whole = NEARLY
    near = _wide(F.col("m")) * whole >= _wide(F.col("n")) * part
    return rows.join(most, at, "left").where(~F.coalesce(near, F.lit(False))).drop("m")


def candidates(graph: Graph) -> DataFrame:
    """``ids`` and the counts of each candidate that no longer one drops, with the counts of its parts."""
    paths = stage(compacted(graph), "phrase-paths")
    size = F.size("words")
    inner = lambda i, end, own: F.when(F.col("i") == i, F.col(end)).otherwise(F.col(own))
    fours = paths.select("*", F.explode(F.sequence(F.lit(1), size - 3)).alias("i")).select(
        F.slice("words", F.col("i"), 4).alias("ids"), "n",
        inner(1, "first", "n").alias("f3_first"), inner(size - 3, "last", "n").alias("f3_last"),
    )
    # inside a path a node counts as much as the path, so only nodes at ends of paths can be kept
    head, tail = F.slice("words", 1, 3), F.slice("words", size - 2, 3)
    ends = paths.select(F.explode(F.array(head, tail)).alias("w"), F.col("n").alias("m"))
    inside = paths.where(size > 4).select("*", F.explode(F.sequence(F.lit(2), size - 3)).alias("i"))
    inside = inside.select(F.slice("words", F.col("i"), 3).alias("w"), F.col("n").alias("m"))
    three = ["w1", "w2", "w3"]
    split = lambda rows, k: rows.select(*[F.col("w")[i].alias(f"w{i + 1}") for i in range(k)], "m")
    threes = _kept(graph.nodes, split(ends.unionByName(inside), 3), three)
    around = graph.nodes.select(F.explode(F.array(F.array("w1", "w2"), F.array("w2", "w3"))).alias("w"), F.col("n").alias("m"))
    twos = _kept(graph.pairs, split(around, 2), ["w1", "w2"])
    blank = F.lit(None).cast("long")
    rows = fours.unionByName(threes.select(F.array(*three).alias("ids"), "n", blank.alias("f3_first"), blank.alias("f3_last")))
    rows = rows.unionByName(twos.select(F.array("w1", "w2").alias("ids"), "n", blank.alias("f3_first"), blank.alias("f3_last")))
    rows = rows.select(
        "*", F.col("ids")[0].alias("a1"), F.col("ids")[1].alias("a2"), F.element_at("ids", -2).alias("z2"), F.element_at("ids", -1).alias("z1")
    )
    words = graph.words.select("id", F.col("n").alias("f"))
    rows = rows.join(words.select(F.col("id").alias("a1"), F.col("f").alias("f1_first")), "a1")
    rows = rows.join(words.select(F.col("id").alias("z1"), F.col("f").alias("f1_last")), "z1")
    rows = rows.join(graph.pairs.select(F.col("w1").alias("a1"), F.col("w2").alias("a2"), F.col("n").alias("f2_first")), ["a1", "a2"])
    rows = rows.join(graph.pairs.select(F.col("w1").alias("z2"), F.col("w2").alias("z1"), F.col("n").alias("f2_last")), ["z2", "z1"])
    return rows.select("ids", "n", *[f"f{k}_{side}" for k in (1, 2, 3) for side in ("first", "last")])


def scored(rows: DataFrame) -> DataFrame:
    """``ids``, a, l, r and score: the lowest-scoring cut of each candidate, the first of equal ones."""

    def cut(k: int, left: str, right: str) -> Column:
        score = F.expr(f"cast(n as decimal(19,0)) * {SCORED} div (cast({left} as decimal(19,0)) + cast({right} as decimal(19,0)))")
        return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))

    size = F.size("ids")
    cuts = (
        F.when(size == 2, F.array(cut(1, "f1_first", "f1_last")))
        .when(size == 3, F.array(cut(1, "f1_first", "f2_last"), cut(2, "f2_first", "f1_last")))
        .otherwise(F.array(cut(1, "f1_first", "f3_last"), cut(2, "f2_first", "f2_last"), cut(3, "f3_first", "f1_last")))
    )
    return rows.select("ids", F.col("n").alias("a"), F.array_min(cuts).alias("c")).select("ids", "a", "c.l", "c.r", "c.score")


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST) -> DataFrame:
    """The first ``best`` phrases of each language by score."""
    graph = Graph(docs, least)
    rows = scored(candidates(graph))
    langs = graph.words.select(F.col("id").alias("a1"), "lang")
    rows = rows.withColumn("a1", F.col("ids")[0]).join(langs, "a1").drop("a1")
    # ties at the end stay in until the phrases are known
    order = [F.desc("score"), F.desc("a")]
    near = rows.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= best)
    near = stage(near.select("ids", "a", "l", "r", "score"), "phrases-near")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    found = _spelled(near, graph, "ids").withColumn("rank", place.cast("long")).where(F.col("rank") <= best)
    return found.join(graph.totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
