"""The delay classifier: pipeline, fitting and batch scoring."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from delayengine.functions.risk import (
    label_from_minutes,
    label_from_probability,
    minutes_from_probability,
    score_from_minutes,
)
from delayengine.operators.features import usable
from delayengine.schema import FEATURES, LABEL, WEIGHT
from delayengine.session import stage

# Inclusive input ranges of the scoring contract (fixed values).
FEATURE_RANGES = {"hour_of_day": (0, 23), "day_of_week": (1, 7), "month": (1, 12)}


def classifier(
    trees: int = 20, depth: int = 5, max_bins: int = 64, seed: int = 42, bootstrap: bool = True
) -> Pipeline:
    """Unfitted pipeline: index the carrier, assemble the features, random forest.

    ``max_bins`` must exceed the number of carriers, as unseen ones take one more slot.
    """
    carrier, *numbers = FEATURES
    return Pipeline(
        stages=[
            StringIndexer(inputCol=carrier, outputCol="carrier_idx", handleInvalid="keep"),
            VectorAssembler(inputCols=["carrier_idx", *numbers], outputCol="features"),
            RandomForestClassifier(
                labelCol=LABEL,
                weightCol=WEIGHT,
                numTrees=trees,
                maxDepth=depth,
                maxBins=max_bins,
                bootstrap=bootstrap,
                seed=seed,
            ),
        ]
    )


def collapse(rows: DataFrame) -> DataFrame:
    """Sum the weights of identical rows.

    The four features take few distinct values, so any number of flights shrinks to
    at most carriers x 24 x 7 x 12 x 2 weighted rows in one map-side-combined pass.
    """
    return rows.groupBy(*FEATURES, LABEL).agg(F.sum(WEIGHT).alias(WEIGHT))


def fit(train: DataFrame, collapsed: bool = True, **params) -> PipelineModel:
    """Fit the classifier, reading ``train`` once.

    The forest is grown on the summed weights of equal rows, without bagging: the fit
    does not grow with the data, and the model does not depend on how the rows are
    partitioned. With ``collapsed=False`` every flight is a training row, bagged one by
    one; Spark seeds the bags by partition, so that model depends on the partitioning.
    """
    rows = collapse(usable(train)) if collapsed else usable(train)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # The copy leaves the training summary behind: that would ship the session and
        # the training plan with every scoring task.
        return classifier(bootstrap=not collapsed, **params).fit(rows).copy()
    finally:
        rows.unpersist()


def counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass through whatever action comes next, without another scan."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def scorable() -> Column:
    """Whether a row meets the scoring contract."""
    checks = F.col("carrier").isNotNull()
    for name, (low, high) in FEATURE_RANGES.items():
        checks = checks & F.col(name).between(low, high)
    return F.coalesce(checks, F.lit(False))


def rejected(rows: DataFrame) -> DataFrame:
    """Rows outside the scoring contract."""
    return rows.filter(~scorable())


@dataclass(frozen=True)
class ScoreTable:
    """A model's answer to every input of the scoring contract.

    The forest knows its carriers and one slot for all others, and the numbers have
    fixed ranges: at most max_bins x 24 x 7 x 12 rows. Scoring is then a join with a
    table of bounded size instead of a walk through all trees for every flight.
    """

    answers: DataFrame
    known: tuple[str, ...]
    other: str

    def look_up(self, rows: DataFrame, how: str) -> DataFrame:
        """Join ``delay_probability``; rows outside the contract find no partner."""
        carrier = F.col("carrier")
        key = F.when(carrier.isin(*self.known), carrier).when(
            carrier.isNotNull(), F.lit(self.other)
        )
        keys = ["known_carrier", *FEATURE_RANGES]
        keyed = rows.withColumn("known_carrier", key)
        return keyed.join(self.answers, keys, how).select(*rows.columns, "delay_probability")


def tabulate(spark: SparkSession, model: PipelineModel) -> ScoreTable:
    """Run the model once over its whole input space and store the answers."""
    answer = vector_to_array("probability")[1]
    return score_table(spark, tuple(model.stages[0].labels), answer, model.transform)


def score_table(
    spark: SparkSession,
    known: tuple[str, ...],
    probability: Column,
    transform: Callable[[DataFrame], DataFrame] = lambda grid: grid,
) -> ScoreTable:
    """The answers of any rule over the whole input space."""
    other = "?" * (1 + max(map(len, known), default=0))
    grid = spark.createDataFrame([(c,) for c in (*known, other)], "carrier string")
    for name, (low, high) in FEATURE_RANGES.items():
        grid = grid.withColumn(name, F.explode(F.sequence(F.lit(low), F.lit(high))))
    answers = transform(grid).select(
        F.col("carrier").alias("known_carrier"),
        *FEATURE_RANGES,
        probability.alias("delay_probability"),
    )
    return ScoreTable(stage(answers, "scores"), known, other)


def score(table: ScoreTable, rows: DataFrame) -> DataFrame:
    """Delay probability and risk label of every row within the scoring contract."""
    scored = table.look_up(rows, "inner")
    return scored.withColumn("risk_label", label_from_probability(F.col("delay_probability")))


def fill_predictions(table: ScoreTable, flights: DataFrame) -> DataFrame:
    """Predict where ``predicted_delay_minutes`` or ``risk_label`` is absent.

    Rows that bring both keep them; rows outside the scoring contract get label and
    score from their delay, as do complete rows lacking a score. There is no cap on the
    number of predictions.
    """

    def own(name: str, kind: str) -> Column:
        return (F.col(name) if name in flights.columns else F.lit(None)).cast(kind)

    minutes, risk = own("predicted_delay_minutes", "double"), own("delay_risk", "double")
    label = F.nullif(own("risk_label", "string"), F.lit(""))
    wanted = minutes.isNull() | label.isNull()
    # NULL unless a prediction is wanted and the row is within the contract.
    probability = F.when(wanted, F.col("delay_probability"))
    guess = minutes_from_probability(probability)
    known = F.coalesce(minutes, F.lit(0.0))
    return table.look_up(flights, "left").withColumns(
        {
            "delay_probability": probability,
            "predicted_delay_minutes": F.coalesce(guess, minutes),
            "risk_label": F.coalesce(
                label_from_probability(probability), label, label_from_minutes(known)
            ),
            "delay_risk": F.when(probability.isNotNull(), score_from_minutes(guess)).otherwise(
                F.coalesce(risk, score_from_minutes(known))
            ),
        }
    )
