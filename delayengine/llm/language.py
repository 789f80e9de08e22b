"""Language identification by rank order: a document's most frequent n-grams against each language's.

N-grams are 1 to 3 letters of a lower-cased word with a mark at both ends; whatever is no letter
separates words. A profile is the ``size`` most frequent n-grams in order, ties by code point.
The distance of two profiles sums how far each of the document's n-grams is out of place,
``size`` where the language lacks it. Profiles are learned from a bounded sample: at most about
``rows_per_language`` documents of each language, chosen by a hash of their id; their counts are summed in Spark.
Prediction reads whole texts, all rows, in numpy, a quarter of a megabyte at a time: the arrays take some hundred times that.

Null texts and texts without a letter are ``und`` with score 0, and so is everything if no language was learned.
Ties between languages go to the first by name. Rows are handled one by one; extra columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayengine.llm.scratch import alone, give_back
from delayengine.llm.words import pieces, runs

SIZE = 300
ROWS_PER_LANGUAGE = 2000
MAX_LANGUAGES = 1000
MIN_SCORE = 0.15
PIECE_BYTES = 1 << 18
_EDGE = 0x1FFFFF  # stands for the end of a word; no code point is as large


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts with one edge between words, before the first and after the last; the row of each."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.array([len(t) for t in texts])
    rows = np.repeat(np.arange(len(texts)), sizes)
    letter = _letters()[points]
    first = letter.copy()  # letters that begin a word
    if len(first):
        first[1:] &= ~letter[:-1] | (rows[1:] != rows[:-1])
    points, rows, first = points[letter], rows[letter], first[letter]
    at = np.arange(len(points)) + np.cumsum(first)  # an edge goes before each word
    out, owner = np.full(len(points) + int(first.sum()), _EDGE, np.int64), np.empty(len(points) + int(first.sum()), np.int64)
    out[at], owner[at] = points, rows
    owner[at[first] - 1] = rows[first]
    return out, owner


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, n-gram and count, in the order of row, then n-gram."""
    symbols, rows = _symbols(texts)
    if not len(symbols):
        none = np.zeros(0, np.int64)
        return none, none, none
    alphabet, dense = np.unique(symbols, return_inverse=True)  # in order, the edge last
    width = len(alphabet) + 1
    if width**3 * len(texts) >= 1 << 63:
        half = len(texts) // 2
        low, high = gram_counts(texts[:half]), gram_counts(texts[half:])
        return np.concatenate([low[0], high[0] + half]), np.concatenate([low[1], high[1]]), np.concatenate([low[2], high[2]])
    # the same n-grams in dense digits, so that one sort orders them by row, length and code point
    digits = np.append(dense + 1, width - 1)
    owner = np.append(rows, -1)
    edge = width - 1 if alphabet[-1] == _EDGE else -1
    one = digits[:-1] != edge
    two = one | (digits[1:] != edge)
    three = digits[1:-1] != edge
    keys = np.concatenate([
        (owner[:-1] * width**3 + digits[:-1])[one],
        (owner[:-1] * width**3 + digits[:-1] * width + digits[1:])[two],
        (owner[:-2] * width**3 + digits[:-2] * width**2 + digits[1:-1] * width + digits[2:])[three],
    ])
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts, keys = np.diff(first, append=len(keys)), keys[first]
    row, code = np.divmod(keys, width**3)
    points = np.concatenate(([0], alphabet))
    grams = points[code // width**2] << 42 | points[code // width % width] << 21 | points[code % width]
    return row, grams, counts


def top(rows: np.ndarray, grams: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``size`` most frequent n-grams of each row with their rank from 0; ties in the order given."""
    order = np.lexsort((np.arange(len(rows)), -counts, rows))
    rows, grams = rows[order], grams[order]
    _, sizes = np.unique(rows, return_counts=True)
    ranks = runs(sizes)
    return rows[ranks < size], grams[ranks < size], ranks[ranks < size]


def _texts(piece: pa.RecordBatch, column: str) -> list[str]:
    return pc.utf8_lower(piece.column(column).cast(pa.large_string()).fill_null("")).to_pylist()


def _bounded(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in small pieces, in a worker that holds nothing of other operators, and keeps nothing free afterwards."""
    alone("language")
    for batch in batches:
        yield from pieces(batch, text, PIECE_BYTES)
    give_back()


def learn(docs: DataFrame, training: Column, rows_per_language: int = ROWS_PER_LANGUAGE, size: int = SIZE) -> list[tuple[str, np.ndarray]]:
    """(language, n-grams by rank) from the rows where ``training`` holds and ``lang`` is not null."""
    known = docs.where(training & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    totals = known.groupBy("lang").count().orderBy("lang").take(MAX_LANGUAGES + 1)
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not totals:
        return []
    parts = F.create_map(*[F.lit(x) for lang, n in totals for x in (lang, int(min(1.0, rows_per_language / n) * 2**32))])
    sample = known.where(F.xxhash64("doc_id", F.lit(7)).bitwiseAND(0xFFFFFFFF) < F.element_at(parts, F.col("lang")))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _bounded(batches):
            langs, codes = np.unique(np.array(piece.column("lang").to_pylist(), object), return_inverse=True)
            rows, grams, counts = gram_counts(_texts(piece, "text"))
            for i, lang in enumerate(langs):
                own = codes[rows] == i
                kinds, where = np.unique(grams[own], return_inverse=True)
                sums = np.bincount(where, counts[own], len(kinds)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(kinds), pa.string()), pa.array(kinds), pa.array(sums)], ["lang", "gram", "n"]
                )

    counted = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counted.withColumn("place", place).where(F.col("place") <= size).orderBy("lang", "place").collect()
    found: dict[str, list[int]] = {}
    for row in best:  # at most MAX_LANGUAGES x size
        found.setdefault(row.lang, []).append(row.gram)
    return [(lang, np.array(grams, np.int64)) for lang, grams in sorted(found.items())]


def predict(docs: DataFrame, profiles: list[tuple[str, np.ndarray]], text: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``: 1 less the distance as a part of the largest possible one."""
    langs = [lang for lang, _ in profiles]
    table = np.unique(np.concatenate([g for _, g in profiles])) if profiles else np.zeros(0, np.int64)
    places = np.full((len(table) + 1, len(langs)), -1, np.int64)  # the last row: in no profile
    for i, (_, grams) in enumerate(profiles):
        places[np.searchsorted(table, grams), i] = np.arange(len(grams))
    model = docs.sparkSession.sparkContext.broadcast((langs, table, places))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table, places = model.value
        for piece in _bounded(batches, text):
            rows, grams, ranks = top(*gram_counts(_texts(piece, text)), size)
            n = np.bincount(rows, minlength=piece.num_rows)
            names, scores = ["und"] * piece.num_rows, np.zeros(piece.num_rows)
            if langs and len(rows):
                at = np.minimum(np.searchsorted(table, grams), len(table) - 1)
                own = places[np.where(table[at] == grams, at, len(table))]
                far = np.where(own < 0, size, np.abs(own - ranks[:, None]))
                total = np.stack([np.bincount(rows, far[:, i], piece.num_rows) for i in range(len(langs))], 1)
                best = total.argmin(1)
                scores = np.where(n > 0, 1 - total[np.arange(len(n)), best] / np.maximum(n * size, 1), 0.0)
                names = [langs[b] if k else "und" for b, k in zip(best, n, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(names, pa.string()), pa.array(scores)], [*piece.schema.names, "lang_pred", "score"]
            )

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *StructType.fromDDL("lang_pred string, score double").fields]))


def _training() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0, F.lit(False))


def predict_corpus(docs: DataFrame) -> DataFrame:
    """Learn from the documents whose crc32(doc_id) mod 5 is not 0, predict all."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    profiles = learn(docs, _training())
    return predict(docs.select("doc_id", "text"), profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose language is one of those learned, with a score of at least ``min_score``."""
    rest = [c for c in docs.columns if c != "text"]
    own = predict(docs.select("text", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row")), learn(docs, _training()))
    own = own.where((F.col("lang_pred") != "und") & (F.col("score") >= min_score))
    return own.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
