"""Model quality on held-out flights.

Predictions may be one row per flight, or one row per distinct (features, label) with
the number of flights in ``flights``, as ``tally`` makes them before the model runs.
Both give the same figures; the second runs the model on a bounded number of rows.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayengine.functions.rounding import nearest
from delayengine.schema import FEATURES, LABEL

# (label, prediction) pairs in report order.
CELLS = ((0, 0), (0, 1), (1, 0), (1, 1))


def tally(rows: DataFrame, *more: str) -> DataFrame:
    """Count identical rows (also by ``more`` columns), in one map-side-combined pass."""
    return rows.groupBy(*FEATURES, LABEL, *more).agg(F.count(F.lit(1)).alias("flights"))


def _flights(predictions: DataFrame) -> Column:
    return F.col("flights") if "flights" in predictions.columns else F.lit(1).cast("bigint")


def _cell(label: int, prediction: int) -> str:
    return f"label_{label}_pred_{prediction}"


def confusion(predictions: DataFrame) -> DataFrame:
    """Rows per (label, prediction), as ``cell`` and ``flights``."""
    cell = F.concat(
        F.lit("label_"), F.col(LABEL).cast("int").cast("string"),
        F.lit("_pred_"), F.col("prediction").cast("int").cast("string"),
    )
    return predictions.groupBy(cell.alias("cell")).agg(
        F.sum(_flights(predictions)).alias("flights")
    )


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_balance(rows: DataFrame) -> DataFrame:
    """Total, delayed share and on-time share (four decimals), in one pass."""
    delayed = F.col("delayed")
    total = F.col("total")
    return rows.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(LABEL) == 1).alias("delayed")
    ).select(
        "total",
        nearest(_share(delayed, total), 4).alias("delayed_pct"),
        nearest(_share(total - delayed, total), 4).alias("on_time_pct"),
    )


def quality(predictions: DataFrame) -> DataFrame:
    """One row: accuracy, weighted precision and recall, F1, confusion map, class balance.

    Everything follows from four counts, so the predictions are read once.
    """
    counts = predictions.agg(
        *[
            F.coalesce(
                F.sum(F.when((F.col(LABEL) == l) & (F.col("prediction") == p), _flights(predictions))),
                F.lit(0).cast("bigint"),
            ).alias(_cell(l, p))
            for l, p in CELLS
        ]
    )
    n = {cell: F.col(_cell(*cell)) for cell in CELLS}
    total = n[0, 0] + n[0, 1] + n[1, 0] + n[1, 1]

    def per_class(k: int) -> tuple[Column, Column, Column, Column]:
        hit = n[k, k]
        support = n[k, 0] + n[k, 1]
        precision = _share(hit, n[0, k] + n[1, k])
        recall = _share(hit, support)
        f1 = _share(F.lit(2.0) * precision * recall, precision + recall)
        return _share(support, total), precision, recall, f1

    share0, precision0, recall0, f1_0 = per_class(0)
    share1, precision1, recall1, f1_1 = per_class(1)
    named = [(F.lit(_cell(*c)), n[c]) for c in CELLS]
    cells = F.map_filter(
        F.create_map(*[x for pair in named for x in pair]), lambda _, v: v > F.lit(0)
    )
    delayed = n[1, 0] + n[1, 1]
    return counts.select(
        nearest(_share(n[0, 0] + n[1, 1], total), 4).alias("accuracy"),
        nearest(share0 * precision0 + share1 * precision1, 4).alias("precision"),
        nearest(share0 * recall0 + share1 * recall1, 4).alias("recall"),
        nearest(share0 * f1_0 + share1 * f1_1, 4).alias("f1"),
        cells.alias("confusion_matrix"),
        F.struct(
            total.alias("total"),
            nearest(_share(delayed, total), 4).alias("delayed_pct"),
            nearest(_share(total - delayed, total), 4).alias("on_time_pct"),
        ).alias("class_balance"),
    )


def area_under_roc(predictions: DataFrame) -> float:
    evaluator = BinaryClassificationEvaluator(
        labelCol=LABEL, rawPredictionCol="rawPrediction", metricName="areaUnderROC"
    )
    if "flights" in predictions.columns:
        evaluator.setWeightCol("flights")
    return evaluator.evaluate(predictions)


def metrics(predictions: DataFrame) -> DataFrame:
    """The full metrics row: ``quality`` preceded by the area under the ROC curve.

    Only the predicted columns are kept while the two passes run.
    """
    weight = ["flights"] if "flights" in predictions.columns else []
    kept = predictions.select(LABEL, "prediction", "rawPrediction", *weight).persist()
    try:
        auc = round(area_under_roc(kept), 4)
        row = quality(kept).first()
    finally:
        kept.unpersist()
    spark = predictions.sparkSession
    return spark.createDataFrame([row], quality(predictions).schema).select(
        F.lit(auc).alias("auc"), "*"
    )
