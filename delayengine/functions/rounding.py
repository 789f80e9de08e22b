"""Decimal rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest(value: Column, digits: int) -> Column:
    """The ``digits``-place decimal nearest to the double's exact binary value, ties to even.

    Spark's own ``round`` works on the shortest decimal text of the double: it lifts
    0.575 to 0.58 although the double lies below it. Away from a tie one multiplication
    decides; only values within reach of a tie take the exact route through
    ``format_number``, which rounds the binary value.
    """
    scale = F.lit(float(10**digits))
    scaled = value.cast("double") * scale
    whole = F.rint(scaled)
    clear = (F.abs(F.abs(scaled - whole) - F.lit(0.5)) > F.lit(1e-5)) & (F.abs(scaled) < F.lit(1e9))
    exact = F.call_function("format_number", value.cast("double"), F.lit("0." + "0" * digits))
    return F.when(clear, whole / scale).otherwise(exact.try_cast("double"))
