"""Delay risk labels, scores and bands. Thresholds are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delayengine.functions.rounding import nearest

MEDIUM_MINUTES = 5.0
HIGH_MINUTES = 30.0
MEDIUM_PROBABILITY = 0.3
HIGH_PROBABILITY = 0.6
ORANGE_SCORE = 50.0
ALERT_SCORE = 75.0


def label_from_minutes(minutes: Column) -> Column:
    return (
        F.when(minutes > F.lit(HIGH_MINUTES), F.lit("high"))
        .when(minutes >= F.lit(MEDIUM_MINUTES), F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def label_from_probability(probability: Column) -> Column:
    return (
        F.when(probability < F.lit(MEDIUM_PROBABILITY), F.lit("low"))
        .when(probability < F.lit(HIGH_PROBABILITY), F.lit("medium"))
        .when(probability.isNotNull(), F.lit("high"))
    )


def score_from_minutes(minutes: Column) -> Column:
    """Minutes as a share of an hour, held to 0.02..1, two decimals; NULL stays NULL."""
    share = F.greatest(F.lit(0.02), F.least(minutes / F.lit(60.0), F.lit(1.0)))
    return F.when(minutes.isNotNull(), nearest(share, 2))


def minutes_from_probability(probability: Column) -> Column:
    """Notional delay for display: probability 1 is one hour."""
    return nearest(probability * F.lit(60.0), 1)


def congestion_band(score: Column) -> Column:
    return (
        F.when(score < F.lit(ORANGE_SCORE), F.lit("green"))
        .when(score < F.lit(ALERT_SCORE), F.lit("orange"))
        .otherwise(F.lit("red"))
    )
