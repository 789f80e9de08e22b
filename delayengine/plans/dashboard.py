"""Everything a dashboard refresh needs, from one frame of raw live records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from delayengine.operators.features import state_features
from delayengine.operators.model import ScoreTable, fill_predictions
from delayengine.operators.normalize import normalized, positioned
from delayengine.operators.summary import congestion, delay_histogram, density, kpis
from delayengine.operators.views import congestion_bars, delays, map_points, risk_table


def normalized_live(
    records: DataFrame, as_of: Column, scores: ScoreTable | None = None
) -> DataFrame:
    """Positioned, normalised flights; given scores, missing predictions are made first."""
    if scores is not None:
        features = state_features(records, as_of, mode="fallback")
        records = fill_predictions(scores, features).drop("month")
    return positioned(normalized(records, as_of))


def payload(flights: DataFrame, as_of: Column, online: bool = True) -> dict[str, DataFrame]:
    """The panels of the dashboard, each its own lazy plan over ``flights``.

    Store or persist ``flights`` (the current state, one row per aircraft) when
    several panels are read.
    """
    late = delays(flights)
    crowded = congestion(flights)
    return {
        "flights": flights,
        "density": density(flights, as_of),
        "delays": late,
        "congestion": crowded,
        "kpi": kpis(flights, online),
        "risk_table": risk_table(late),
        "map": map_points(flights),
        "congestion_chart": congestion_bars(crowded),
        "delay_distribution": delay_histogram(flights),
    }
