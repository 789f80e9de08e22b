"""Rows dealt to ranges of a key, with copies of the rows next to each range: neighbours without one global sort.

A window over all rows, or over a host that holds a third of them, would be one task. Here the ranges
are cut at keys of a bounded sample, so they are about equal whatever the keys; each range also gets
the first row after it and the last one before it. Where the cuts fall changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RANGES = 4096
_GROUP = 64


def _upto(cuts: list, key: Column) -> Column:
    """How many cuts are not above the key: first among every 64th, then among the 64 there."""
    coarse, values = cuts[::_GROUP], F.array(*[F.lit(c) for c in cuts])
    count = lambda array: F.size(F.filter(array, lambda x: x <= key))
    group = count(F.array(*[F.lit(c) for c in coarse]))
    return F.when(group == 0, 0).otherwise((group - 1) * _GROUP + count(F.slice(values, (group - 1) * _GROUP + 1, _GROUP)))


def cuts_of(rows: DataFrame, key: Column, rows_per_range: int) -> list:
    """Keys that occur, in order, at about every ``rows_per_range`` rows; the first key of all comes first."""
    keys = rows.select(key.alias("key")).where("key is not null")
    total, least = keys.agg(F.count("*"), F.min("key")).first()
    ranges = min(MAX_RANGES, total // rows_per_range + 1)
    if ranges < 2:
        return [] if least is None else [least]
    part = int(min(1.0, 20 * ranges / total) * 2**32)
    sample = [r.key for r in keys.where(F.xxhash64("key").bitwiseAND(0xFFFFFFFF) < part).distinct().orderBy("key").collect()]
    step = max(1, len(sample) // ranges)
    return sorted({least, *sample[step::step]})


def lasts_of(rows: DataFrame, key: Column, cuts: list) -> list:
    """The last key of each range."""
    if not cuts:
        return []
    own = F.coalesce(_upto(cuts, key), F.lit(0))
    ends = rows.select(own.alias("range"), key.alias("key")).groupBy("range").agg(F.max("key").alias("key"))
    return sorted(r.key for r in ends.where("key is not null").collect())  # one for each range


def with_neighbours(rows: DataFrame, key: Column, cuts: list, lasts: list = (), around: bool = False) -> DataFrame:
    """``rows`` with ``range`` and ``guest``, each row once as no guest in its own range.

    The first row of a range is also a guest in the range before it, with ``around`` in the last range for
    the first of all, so there guests must be ordered last; given ``lasts``, the last row of a range is also a guest in the next one. Null keys are in
    range 0, below all others, and are nobody's guests.
    """
    if not cuts:
        return rows.withColumns({"range": F.lit(0), "guest": F.lit(False)})
    own, end = F.coalesce(_upto(cuts, key), F.lit(0)), len(cuts)
    place = lambda at, guest: F.struct(at.cast("int").alias("range"), F.lit(guest).alias("guest"))
    places = [place(own, False), F.when(key.isin(cuts) & (own > 1), place(own - 1, True))]
    if around:
        places.append(F.when(key == cuts[0], place(F.lit(end), True)))
    if lasts:
        places.append(F.when(key.isin(list(lasts)) & (own < end), place(own + 1, True)))
    placed = F.filter(F.array(*places), lambda x: x.isNotNull())
    return rows.select("*", F.explode(placed).alias("place")).select(*rows.columns, "place.range", "place.guest")
