"""Near-duplicate documents: MinHash banding, and each candidate pair verified on its full n-gram sets.

A text's set holds the hashes of its runs of ``words`` words; a shorter text is one run. Texts with equal sets
are one class from the start, however many copies there are. Class signatures are cut into bands; bands and rows follow
from the recall wanted at the threshold. Classes that share a band's hash are a bucket, dealt in blocks
of a bounded number of classes and n-grams; two blocks meet in one task. A pair counts in the first band it shares alone.

First, without sets, blocks find who has a pair to verify at all; then their sets, made anew from the
texts, go where needed, and a task intersects them by a matrix product. It returns no pairs: per class, its number of
linked documents, and edges enough to connect what is linked. So a group of n near copies makes about n rows
for each of its blocks, not n^2. Components of those edges are the classes of the result.

A null or empty text has no n-grams and is alike to nothing, not even to its copies. Rows of one doc_id stay
separate rows. The result's class is the least doc_id of its documents (null where only null ids are in it).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delayengine.llm.components import components
from delayengine.llm.words import mix, mixed, pieces, texts_of, words_of
from delayengine.session import stage

WORDS, THRESHOLD, RECALL, HASHES = 5, 0.8, 0.9999, 128
BLOCK_CLASSES, BLOCK_GRAMS = 256, 1 << 20
_COLUMNS = 4096


def band_plan(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows for which a pair at the threshold shares a band with probability ``recall``."""
    plans = []
    for rows in range(1, hashes + 1):
        chance = threshold**rows
        bands = 1 if chance >= 1 else math.ceil(math.log1p(-recall) / math.log1p(-chance)) if chance > 1e-12 else hashes + 1
        if bands * rows <= hashes:
            plans.append((bands, rows))
    return max(plans, key=lambda p: p[1]) if plans else (hashes, 1)


def gram_sets(column: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    found = words_of(texts_of(column))
    ends = np.cumsum(found.counts)
    sets = []
    if not len(found.hashes):
        return [found.hashes] * len(column)
    n = len(found.hashes)
    spans = mixed(*[found.hashes[i:n - words + 1 + i] for i in range(words)]) if n >= words else np.zeros(0, np.uint64)
    for start, end in zip(ends - found.counts, ends, strict=True):
        if end - start >= words:
            sets.append(np.unique(spans[start:end - words + 1]))
        elif end > start:  # a short text is one run, told apart from longer ones by its length
            sets.append(mixed(*[found.hashes[i:i + 1] for i in range(start, end)], np.full(1, end - start, np.uint64)))
        else:
            sets.append(found.hashes[:0])
    return sets


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One hash per set and band; sets must not be empty."""
    flat, firsts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    seeds = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros((len(sets), bands), np.uint64)
    for band in range(bands):
        lowest = []
        for row in range(rows):
            k = band * rows + row
            lowest.append(np.minimum.reduceat((flat * (seeds[2 * k] | np.uint64(1)) + seeds[2 * k + 1]) >> np.uint64(16), firsts))
        out[:, band] = mixed(*lowest)
    return out


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _signed(bands: int, rows: int, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                sets = gram_sets(piece.column("text"), words)
                full = [i for i, s in enumerate(sets) if len(s)]
                marks: list[bytes | None] = [None] * len(sets)
                if full:
                    for i, mark in zip(full, signatures([sets[i] for i in full], bands, rows), strict=True):
                        marks[i] = mark.tobytes()
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), piece.column("text_hash"), pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()), pa.array(marks, pa.binary()),
                ], ["doc_id", "text_hash", "class", "grams", "bands"])

    return run


def _sets(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                sets = gram_sets(piece.column("text"), words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["class", "set"]
                )

    return run


def _marks(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.frombuffer(b, np.uint64) for b in column.to_pylist()])


def _first_here(marks: np.ndarray, left: np.ndarray, right: np.ndarray, band: int) -> np.ndarray:
    """Which of left x right share ``band`` and no band before it."""
    here = marks[left, band][:, None] == marks[right, band][None, :]
    for before in range(band):
        here &= marks[left, before][:, None] != marks[right, before][None, :]
    return here


def _pairs(marks: np.ndarray, block: np.ndarray, i: int, j: int, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members of both blocks and the matrix of pairs that count here."""
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    here = _first_here(marks, left, right, band)
    if i == j:
        here &= np.triu(np.ones(here.shape, bool), 1)
    return left, right, here


def _needed(key: tuple, table: pa.Table) -> pa.Table:
    """Of one meeting of two blocks: the classes that have a pair to verify there."""
    band, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
    left, right, here = _pairs(_marks(table.column("bands")), table.column("block").to_numpy(), i, j, band)
    used = np.union1d(left[here.any(1)], right[here.any(0)])
    return table.take(pa.array(used, pa.int64()))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, some thousands of elements at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out
    flat = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    kinds, where, counts = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1  # an element of one set alone is in no intersection
    common = counts[where] > 1
    where, owner = number[where[common]], owner[common]
    order = np.argsort(where, kind="stable")
    where, owner = where[order], owner[order]
    for start in range(0, int(number[-1]) + 1 if len(kinds) else 0, _COLUMNS):
        a, b = np.searchsorted(where, [start, start + _COLUMNS])
        matrix = np.zeros((len(left) + len(right), _COLUMNS), np.float32)
        matrix[owner[a:b], where[a:b] - start] = 1
        out += matrix[:len(left)] @ matrix[len(left):].T
    return out


def _verified(threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        band, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
        left, right, here = _pairs(_marks(table.column("bands")), table.column("block").to_numpy(), i, j, band)
        names, copies = table.column("class").to_pylist(), table.column("copies").to_numpy()
        sets = [np.frombuffer(b, np.uint64) for b in table.column("set").to_pylist()]
        both = shared_counts([sets[x] for x in left], [sets[x] for x in right])
        sizes = np.array([len(s) for s in sets], float)
        alike = here & (both >= threshold * (sizes[left][:, None] + sizes[right][None, :] - both) - 1e-9)
        links = np.zeros(len(names), np.int64)
        np.add.at(links, left, alike @ copies[right])
        np.add.at(links, right, alike.T @ copies[left])
        root = list(range(len(names)))  # the edges that connect all that is linked here

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for x, y in zip(*np.nonzero(alike), strict=True):
            a, b = top(left[x]), top(right[y])
            root[max(a, b)] = min(a, b)
        rows = [(names[x], names[top(x)], int(links[x])) for x in range(len(names)) if links[x]]
        return pa.table(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())],
            ["class", "other", "links"],
        )

    return run


def classify(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL) -> DataFrame:
    """doc_id, text_hash, class_id, n_links (other documents as alike as ``threshold``) and whether the row's text stands for its class."""
    bands, rows = band_plan(threshold, recall)
    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    signed = stage(texts.mapInArrow(_signed(bands, rows, words), "doc_id bigint, text_hash bigint, class binary, grams int, bands binary"), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    classes = signed.where("class is not null").groupBy("class").agg(
        first.alias("first"), F.count("*").alias("copies"), F.first("grams").alias("grams"), F.first("bands").alias("bands"),
    )
    classes = stage(classes, "classes")

    # Buckets of two and more, each in so many blocks that a block is bounded.
    keys = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.substring(F.col("bands"), b * 8 + 1, F.lit(8))))
    entries = classes.select("class", "grams", keys.alias("band", "bucket"))
    many = entries.groupBy("band", "bucket").agg(F.count("*").alias("n"), F.sum("grams").alias("total")).where("n > 1")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_GRAMS)).cast("int")
    dealt = entries.join(many.select("band", "bucket", blocks.alias("blocks")), ["band", "bucket"])
    own = F.pmod(F.xxhash64("class", "band"), F.col("blocks")).cast("int")
    meetings = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j"))
    )
    dealt = dealt.withColumn("block", own).select("class", "band", "bucket", "block", F.explode(meetings).alias("m"))
    meeting = ["band", "bucket", "i", "j"]
    dealt = dealt.select("class", "band", "bucket", "block", "m.i", "m.j").join(classes.select("class", "bands"), "class")
    needed = stage(dealt.groupBy(*meeting).applyInArrow(_needed, dealt.schema), "needed")

    # The sets of those classes, from one text of each.
    wanted = needed.select("class").distinct().join(classes, "class").select("class", "copies", "first.doc_id", "first.text_hash")
    source = texts.join(wanted.select("doc_id", "text_hash").distinct(), on=[texts["doc_id"].eqNullSafe(wanted["doc_id"]), texts["text_hash"] == wanted["text_hash"]], how="left_semi")
    sets = source.select("text").mapInArrow(_sets(words), "class binary, set binary").dropDuplicates(["class"])
    sets = wanted.select("class", "copies").join(sets, "class")
    found = needed.join(sets, "class").groupBy(*meeting).applyInArrow(_verified(threshold), "class binary, other binary, links bigint")
    found = stage(found, "links")

    roots = components(found.select(F.col("class").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    out = classes.select("class", "first", "copies").join(links, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left")
    out = out.withColumn("root", F.coalesce("root", "class"))
    heads = out.groupBy("root").agg(F.min("first").alias("head"))
    out = out.join(heads, "root").select("class", "first", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    rows_ = signed.select("doc_id", "text_hash", "class").join(out, "class", "left")
    alone = F.col("class").isNull()
    return rows_.select(
        "doc_id", "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_hash") == F.col("head.text_hash")))).alias("stands"),
    )


def linked_documents(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and n_links of each row."""
    return classify(docs).select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, that of the least doc_id (null ids last, then by a hash of the text); all columns are kept.

    Texts without words are no copies of one another and all stay.
    """
    columns = docs.columns
    gone = classify(docs).groupBy("doc_id", "text_hash").agg(F.max("stands").alias("stands"), F.count("*").alias("n"))
    gone = gone.select("doc_id", "text_hash", "stands", "n").where("not stands or n > 1")
    rows = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.trim(F.coalesce("text", F.lit(""))).alias("text"))
    match = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["text_hash"] == gone["text_hash"])
    joined = rows.select("row", "doc_id", "text_hash", (F.regexp_replace("text", r"[\x20\x09-\x0D]+", "") == "").alias("blank")).join(gone, match, "left")
    joined = joined.where(F.col("stands").isNull() | F.col("stands")).select("row", rows["doc_id"], rows["text_hash"], "blank", F.coalesce("n", F.lit(1)).alias("n"))
    once = joined.where("n = 1 or blank").select("row")
    repeated = joined.where("n > 1 and not blank")
    place = F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy(F.to_json("row")))
    return once.unionByName(repeated.withColumn("place", place).where("place = 1").select("row")).select("row.*")
