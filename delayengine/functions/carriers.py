"""Airline codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from delayengine.schema import ICAO_TO_IATA


def _iata(icao: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(ICAO_TO_IATA.items())])
    return F.try_element_at(pairs, icao)


def carrier_from_callsign(callsign: Column) -> Column:
    """IATA code of a callsign's airline prefix; NULL for an airline not in the table."""
    return _iata(F.upper(F.substring(F.trim(callsign), 1, 3)))


def carrier_or_prefix(carrier: Column) -> Column:
    """IATA code of an ICAO code, else its first two letters, else ``UNK``."""
    icao = F.upper(F.trim(F.coalesce(F.nullif(carrier, F.lit("")), F.lit("UNK"))))
    short = F.when(F.length(icao) >= 2, F.substring(icao, 1, 2)).otherwise(F.lit("UNK"))
    return F.coalesce(_iata(icao), short)
