"""An interpolated modified Kneser-Ney bigram model of all training texts, and the texts' scores.

Counting. Each task sums its bigrams in numpy and hands every shard, chosen by the bigram's
hash, one sorted block; a shard's task merges its blocks. A frequent word so is one entry per task, and its bigrams
are spread over all shards. Statistics of words (occurrences, followers by their count, preceding words) come
from the merged bigrams in a second, smaller exchange of the same form.

Storage. A shard is a file of sorted hashes beside files of what belongs to them, below the
shared folder; workers map the files into memory and look words up by bisection. Nothing of the
model is sent to the driver but the counts of counts.

Model. P(w|v) = max(c(vw) - D(c(vw)), 0)/c(v) + g(v) P(w);  P(w) = max(p(w) - E(p(w)), 0)/B + h/(V+1),
where p(w) is the number of distinct words before w, B their sum, V the number of words learned, and D, E the
discounts for 1, 2 and 3 or more. The first word follows a start mark, the last one an end mark
that counts as a token. A word after an unknown one gets P(w). Words are compared by 64-bit hashes.

A null text is an empty one: its only token is the end mark. Without training texts every
token gets 1/(V+1) = 1. Repeated rows count each time. Rows are scored one by one, whole, whatever their length.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayengine.llm.packed import BLOCKS, blocks, narrow, pack, shard_of, unpack
from delayengine.llm.scratch import mapped, put
from delayengine.llm.words import find, mixed, pieces, tally, texts_of, words_of
from delayengine.session import new_folder

START, END = np.uint64(1), np.uint64(2)  # hashes of the marks
SUMMED = 3_000_000  # distinct bigrams that a task holds before it hands them on


class Model(NamedTuple):
    """Where a model is and the few numbers that hold for all of it."""

    folder: str
    shards: int
    tokens: int
    distinct: int
    pairs: int  # distinct bigrams
    discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    add: float


def _sequence(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text followed by the end mark; the word before each; the row of each."""
    words = words_of(texts)
    sizes = words.counts + 1
    total = int(sizes.sum())
    ends = np.cumsum(sizes) - 1
    token, before = np.empty(total, np.uint64), np.empty(total, np.uint64)
    inner = np.ones(total, bool)
    inner[ends] = False
    token[inner], token[ends] = words.hashes, END
    before[1:] = token[:-1]
    before[ends - words.counts] = START
    return token, before, np.repeat(np.arange(len(sizes)), sizes)


# A block of bigrams: first words with the number of their followers here; then, in that order, the followers.
def _pair_blocks(before: np.ndarray, token: np.ndarray, counts: np.ndarray, shards: int) -> pa.RecordBatch:
    shard = shard_of(mixed(before, token), shards)
    order = np.lexsort((token, before, shard))
    before, token, counts, shard = before[order], token[order], counts[order], shard[order]
    edges = np.searchsorted(shard, np.arange(shards + 1))
    used, packed = np.flatnonzero(np.diff(edges)), []
    for s in used:
        own = slice(edges[s], edges[s + 1])
        firsts, followers = tally(before[own])
        heads = pack([firsts, narrow(followers)])
        tails = pack([token[own], narrow(counts[own])])
        packed.append(np.uint32(len(heads)).tobytes() + heads + tails)
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(np.zeros(len(used)), pa.int32()), pa.array(packed, pa.binary())],
        ["shard", "kind", "block"],
    )


def _pairs_in(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cut = 4 + int(np.frombuffer(block, np.uint32, 1)[0])
    firsts, followers = unpack(block[4:cut])
    token, counts = unpack(block[cut:])
    return np.repeat(firsts, followers), token, counts


def _summed_pairs(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Distinct (before, token) with the sum of their counts, in the order of their common hash."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    before, token, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    keys = mixed(before, token)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    totals = np.add.reduceat(counts[order].astype(np.uint64), first)
    return keys[first], before[order][first], token[order][first], totals


def _count(shards: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in pieces(batch):
                token, before, _ = _sequence(texts_of(piece.column("text")))
                _, b, t, c = _summed_pairs([(before, token, np.ones(len(token), np.uint32))])
                held.append((b, t, c))
                size += len(c)
                if size > SUMMED:
                    _, b, t, c = _summed_pairs(held)
                    held, size = [(b, t, c)], len(c)
                    if size > SUMMED // 2:
                        yield _pair_blocks(b, t, c, shards)
                        held, size = [], 0
        if held:
            yield _pair_blocks(*_summed_pairs(held)[1:], shards)

    return run


def _discounts(counts: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many entries have count 1, 2, 3 and 4."""
    n1, n2, n3, n4 = counts
    if not n1 or not n2:
        return (0.5, 0.5, 0.5) if n1 else (0.0, 0.0, 0.0)
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2)
    return tuple(min(max(d, 0.0), float(i)) for i, d in enumerate(found, 1))


def _merge_pairs(folder: str, shards: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys, before, token, counts = _summed_pairs([_pairs_in(b) for b in table.column("block").to_pylist()])
        put(folder, f"pair-{shard}-keys", keys)
        put(folder, f"pair-{shard}-counts", narrow(counts))
        three = counts >= 3
        parts = [  # per word: as a first word its occurrences and followers by count; as a token its predecessors, occurrences
            (before, np.stack([counts, counts == 1, counts == 2, three, np.zeros_like(counts), np.zeros_like(counts)], 1)),
            (token, np.stack([np.zeros_like(counts)] * 4 + [np.ones_like(counts), counts], 1)),
        ]
        words = np.concatenate([p[0] for p in parts])
        values = np.concatenate([p[1] for p in parts]).astype(np.uint64)
        order = np.argsort(words)
        words, values = words[order], values[order]
        first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        words, values = words[first], np.add.reduceat(values, first, axis=0)
        numbers = np.array([np.sum(counts == k) for k in (1, 2, 3, 4)] + [len(counts), counts.sum()], np.int64)
        own = blocks(1, shard_of(words, shards), shards, [words, *values.T])
        told = pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), pa.array([2], pa.int32()), pa.array([numbers.tobytes()], pa.binary())], own.schema.names
        )
        return pa.Table.from_batches([own, told])

    return run


def _merge_words(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        parts = [unpack(b) for b in table.column("block").to_pylist()]
        words = np.concatenate([p[0] for p in parts])
        values = np.concatenate([np.stack(p[1:], 1) for p in parts])
        order = np.argsort(words)
        words, values = words[order], values[order]
        first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        words, values = words[first], np.add.reduceat(values, first, axis=0)
        put(folder, f"word-{shard}-keys", words)
        put(folder, f"word-{shard}-values", values)
        after = values[:, 4]
        numbers = [int(np.sum(after == k)) for k in (1, 2, 3, 4)] + [int(np.sum(after > 0))]
        return pa.table({"shard": pa.array([shard], pa.int32()), "numbers": pa.array([numbers], pa.list_(pa.int64()))})

    return run


def fit(docs: DataFrame, training: Column, add: float = 0.1) -> Model:
    """Count the texts of the rows where ``training`` holds and store the model below the shared folder."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_folder(spark, "ngram-lm")
    counted = docs.where(training).select("text").mapInArrow(_count(shards), BLOCKS)
    spread = new_folder(spark, "ngram-lm-words")
    counted.groupBy("shard").applyInArrow(_merge_pairs(folder, shards), BLOCKS).write.parquet(spread)
    merged = spark.read.schema(BLOCKS).parquet(spread)
    counts = np.zeros(6, np.int64)
    for row in merged.where("kind = 2").select("block").toLocalIterator():  # six numbers for each shard
        counts += np.frombuffer(row[0], np.int64)
    words = merged.where("kind = 1").groupBy("shard").applyInArrow(_merge_words(folder), "shard int, numbers array<bigint>")
    totals = words.select(*[F.coalesce(F.sum(F.col("numbers")[i]), F.lit(0)).alias(f"n{i}") for i in range(5)]).first()
    return Model(
        folder, shards, int(counts[5]), int(totals[4]), int(counts[4]),
        _discounts([int(c) for c in counts[:4]]), _discounts([int(x) for x in totals[:4]]), add,
    )


def _looked_up(model: Model, kind: str, keys: np.ndarray, what: str, width: int) -> np.ndarray:
    """What is stored beside each key, zero where the key is unknown."""
    out = np.zeros((len(keys), width), np.float64)
    shard = shard_of(keys, model.shards)  # keys are in order, so shards are too
    edges = np.searchsorted(shard, np.arange(model.shards + 1))
    for s in np.flatnonzero(np.diff(edges)):
        own = slice(edges[s], edges[s + 1])
        try:
            table = mapped(model.folder, f"{kind}-{s}-keys", "u8")
        except FileNotFoundError:  # no entry fell into this shard
            continue
        values = mapped(model.folder, f"{kind}-{s}-{what}", "u1")
        values = values.view(f"u{len(values) // (len(table) * width)}").reshape(-1, width)
        at, known = find(table, keys[own])
        out[own][known] = values[at[known]]
    return out


def log_probabilities(model: Model, token: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 P of each token after the one before it, and the token's count in training."""
    words, inverse = np.unique(np.concatenate([token, before]), return_inverse=True)
    own, left = inverse[:len(token)], inverse[len(token):]
    stats = _looked_up(model, "word", words, "values", 6)
    d = np.array([0.0, *model.discounts])
    e = np.array([0.0, *model.word_discounts])
    after = stats[:, 4]
    spare = 1.0
    lower = np.zeros(len(words))
    if model.pairs:
        n = np.array(_word_classes(model))
        spare = float((n * e[1:]).sum()) / model.pairs
        lower = np.maximum(after - e[np.minimum(after, 3).astype(int)], 0) / model.pairs
    lower += spare / (model.distinct + 1)
    pairs, where = np.unique(mixed(before, token), return_inverse=True)
    seen = _looked_up(model, "pair", pairs, "counts", 1)[where, 0]
    context = stats[left]
    total = np.maximum(context[:, 0], 1)
    weight = np.where(context[:, 0] > 0, (context[:, 1:4] * d[1:]).sum(1) / total, 1.0)
    upper = np.maximum(seen - d[np.minimum(seen, 3).astype(int)], 0) / total
    return np.log10(upper + weight * lower[own]), stats[own, 5]


@functools.lru_cache(maxsize=4)
def _word_classes(model: Model) -> tuple[int, int, int]:
    """How many words follow 1, 2, and 3 or more distinct words; every word learned follows some."""
    one = two = 0
    for s in range(model.shards):
        try:
            after = mapped(model.folder, f"word-{s}-values", "u8").reshape(-1, 6)[:, 4]
        except FileNotFoundError:
            continue
        one, two = one + int(np.sum(after == 1)), two + int(np.sum(after == 2))
    return one, two, model.distinct - one - two


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (log10) and perplexity of each text."""
    base = np.log10(model.tokens + model.add * (model.distinct + 1)) if model.tokens else 0.0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                rows = piece.num_rows
                token, before, row = _sequence(texts_of(piece.column("text")))
                logs, counts = log_probabilities(model, token, before)
                sizes = np.bincount(row, minlength=rows)
                total = np.bincount(row, logs, rows)
                plain = np.log10(counts + model.add) - base if model.tokens else np.zeros(len(counts))
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(sizes, pa.int64()),
                    pa.array(np.bincount(row, counts > 0, rows).astype(np.int64)),
                    pa.array(np.bincount(row, plain, rows)), pa.array(total), pa.array(10.0 ** (-total / sizes)),
                ], ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double"
    )


def score_corpus(docs: DataFrame) -> DataFrame:
    """Learn from the documents whose crc32(doc_id) mod 10 is not 0 and score all of them."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    model = fit(docs, F.coalesce(remainder != 0, F.lit(False)))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )
