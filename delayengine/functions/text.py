"""Picking values out of records that spell the same field in several ways."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _typed(df: DataFrame, name: str, kind: str, zero_is_empty: bool) -> Column:
    source = df.schema[name].dataType
    value = F.col(name)
    if isinstance(source, T.StringType):
        value = F.nullif(value, F.lit(""))
        if kind != "string":
            value = value.try_cast(kind)
    elif kind != source.simpleString():
        value = value.cast(kind)
    if zero_is_empty and kind in ("int", "bigint", "float", "double"):
        value = F.nullif(value, F.lit(0).cast(kind))
    return value


def pick(
    df: DataFrame,
    aliases: Sequence[str],
    kind: str,
    default: Column | None = None,
    zero_is_empty: bool = False,
) -> Column:
    """First usable value among ``aliases``, cast to ``kind``.

    Aliases the frame does not have are left out when the plan is built, so a
    record set with one spelling costs one column. Empty text counts as missing;
    with ``zero_is_empty`` a numeric zero does too.
    """
    present = [_typed(df, a, kind, zero_is_empty) for a in aliases if a in df.columns]
    if default is not None:
        present.append(default.cast(kind))
    if not present:
        return F.lit(None).cast(kind)
    return present[0] if len(present) == 1 else F.coalesce(*present)


def title_case(value: Column) -> Column:
    return F.initcap(F.lower(value))


def route_text(origin: Column, dest: Column) -> Column:
    return F.concat_ws(" → ", origin, dest)


def ground_status(on_ground: Column) -> Column:
    return F.when(on_ground, F.lit("Ground")).otherwise(F.lit("Airborne"))
