"""Pipeline, scoring contract, metrics and the training job on small data."""

import json
import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from delayengine.jobs import score as score_job
from delayengine.jobs import train as train_job
from delayengine.operators import clean, evaluate, model
from delayengine.operators.features import labelled, split_rows, train_and_test, usable
from delayengine.plans import tables
from delayengine.schema import FEATURES
from delayengine.sinks.tables import write_model, write_months
from delayengine.sources.stored import fitted_model

SF = "/root/testdata/sf0.001"
ROWS = [
    ("NK", 5, 3, 2, 0), ("NK", 20, 5, 6, 1), ("AS", 9, 2, 4, 0), ("AS", 18, 7, 8, 1), ("HA", 11, 4, 10, 0),
    ("HA", 16, 1, 12, 1), ("F9", 4, 6, 1, 0), ("F9", 23, 3, 5, 1), ("OO", 13, 2, 3, 0), ("OO", 15, 7, 9, 1),
]
DDL = "carrier string, hour_of_day int, day_of_week int, month int"


@pytest.fixture(scope="module")
def train(spark):
    rows = [(*r, 2.0 if r[-1] else 1.0) for r in ROWS]
    return spark.createDataFrame(rows, f"{DDL}, is_delayed int, class_weight double")


@pytest.fixture(scope="module")
def fitted(train):
    return model.fit(train)


@pytest.fixture(scope="module")
def scores(spark, fitted):
    return model.tabulate(spark, fitted)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def test_probabilities(spark, fitted, scores):
    row = fitted.transform(frame(spark, ("NK", 13, 5, 8))).first()
    assert all(0.0 <= p <= 1.0 for p in row.probability) and math.isclose(sum(row.probability), 1.0, abs_tol=1e-6)
    assert model.score(scores, frame(spark, ("NK", 13, 5, 8))).first().delay_probability == row.probability[1]


def test_unseen_carrier_gives_numbers(spark, fitted, scores):
    rows = model.score(scores, frame(spark, ("NK", 6, 1, 3), ("AS", 22, 7, 12), ("UNKNOWN", 13, 5, 9))).collect()
    assert len(rows) == 3 and not any(math.isnan(r.delay_probability) for r in rows)
    assert {r.risk_label for r in rows} <= {"low", "medium", "high"}
    predictions = fitted.transform(frame(spark, ("UNKNOWN", 13, 5, 9), (None, 13, 5, 9))).collect()
    assert all(r.prediction in (0.0, 1.0) for r in predictions)


def test_scoring_repeats(spark, fitted, scores):
    row = frame(spark, ("HA", 9, 2, 11))
    first, second = (model.score(scores, row).first().delay_probability for _ in range(2))
    assert first == second


def test_rows_outside_the_contract_are_set_aside(spark, fitted, scores):
    rows = frame(spark, ("NK", 24, 1, 1), ("NK", 0, 0, 1), ("NK", 0, 1, 13), (None, 0, 1, 1), ("NK", None, 1, 1), ("NK", 23, 7, 12))
    assert model.score(scores, rows).count() == 1 and model.rejected(rows).count() == 5


def test_training_ignores_null_numbers_and_takes_many_carriers(spark, train):
    more = spark.range(40).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("carrier"), F.lit(5).alias("hour_of_day"),
        F.lit(2).alias("day_of_week"), F.lit(3).alias("month"), (F.col("id") % 2).cast("int").alias("is_delayed"),
        F.lit(1.0).alias("class_weight"),
    )
    holed = train.unionByName(more).unionByName(train.limit(1).withColumn("hour_of_day", F.lit(None).cast("int")))
    assert model.fit(holed, trees=2, depth=2).stages[-1].getNumTrees == 2


def test_collapsed_cells_keep_all_weight(train):
    cells = model.collapse(train.unionByName(train))
    assert cells.count() == 10 and cells.agg(F.sum("class_weight")).first()[0] == 30.0


def test_model_does_not_depend_on_partitions(spark):
    flights = tables.flights(spark, SF)
    found = set()
    for pieces in (1, 7, 40):
        rows = split_rows(labelled(flights.repartition(pieces)), tables.ROW_ID)
        train, test = train_and_test(evaluate.tally(usable(rows), "held_out"))
        found.add(str(evaluate.metrics(model.fit(train, trees=5).transform(test)).first()))
    assert len(found) == 1


def test_saved_model_scores_the_same(spark, fitted, scores, tmp_path):
    path = write_model(fitted, str(tmp_path), "v1")
    again = fitted_model(path)
    rows = frame(spark, ("HA", 9, 2, 11))
    assert model.score(model.tabulate(spark, again), rows).first() == model.score(scores, rows).first()


def test_missing_predictions_are_filled(spark, fitted, scores):
    rows = spark.createDataFrame(
        [("a", "NK", 13, 5, 8, None, None, None), ("b", "NK", 13, 5, 8, 12.0, "high", 0.9),
         ("c", "NK", 13, 5, 8, 12.0, "", None), ("d", None, 13, 5, 8, 12.0, None, None), ("e", "NK", None, 4, 7, None, None, None),
         ("f", "NK", 99, 4, 7, 7.0, "low", None)],
        f"icao24 string, {DDL}, predicted_delay_minutes double, risk_label string, delay_risk double",
    )
    probability = model.score(scores, frame(spark, ("NK", 13, 5, 8))).first().delay_probability
    filled = model.fill_predictions(scores, rows)
    got = {r.icao24: r for r in filled.collect()}
    assert set(rows.columns) | {"delay_probability"} == set(filled.columns)
    minutes = round(probability * 60, 1)
    for key in ("a", "c"):
        assert (got[key].delay_probability, got[key].predicted_delay_minutes) == (probability, minutes)
        assert got[key].delay_risk == round(max(0.02, min(minutes / 60, 1)), 2)
    assert (got["b"].predicted_delay_minutes, got["b"].risk_label, got["b"].delay_risk) == (12.0, "high", 0.9)
    assert (got["d"].risk_label, got["d"].delay_risk, got["d"].delay_probability) == ("medium", 0.2, None)
    assert (got["e"].predicted_delay_minutes, got["e"].risk_label, got["e"].hour_of_day) == (None, "low", None)
    assert (got["f"].delay_risk, got["f"].hour_of_day) == (0.12, 99)


def test_score_table_is_the_model(spark, fitted, scores):
    assert scores.answers.count() == 6 * 24 * 7 * 12
    rows = spark.range(3000).select(
        F.element_at(F.array(*map(F.lit, ("NK", "AS", "HA", "F9", "OO", "??", "other"))), (F.col("id") % 7 + 1).cast("int")).alias("carrier"),
        (F.col("id") % 24).cast("int").alias("hour_of_day"), (F.col("id") % 7 + 1).cast("int").alias("day_of_week"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
    )
    direct = fitted.transform(rows).select(*FEATURES, vector_to_array("probability")[1].alias("delay_probability"))
    looked_up = model.score(scores, rows).drop("risk_label")
    assert direct.exceptAll(looked_up).count() == 0 == looked_up.exceptAll(direct).count()
    assert "BroadcastHashJoin" in looked_up._jdf.queryExecution().executedPlan().toString()


def test_tallied_metrics_are_the_same(spark, fitted, train):
    rows = train.unionByName(train.filter("month > 5")).unionByName(train.limit(3).withColumn("is_delayed", F.lit(1)))
    plain = evaluate.metrics(fitted.transform(rows)).first()
    tallied = evaluate.metrics(fitted.transform(evaluate.tally(rows))).first()
    assert plain == tallied and plain.class_balance.total == rows.count()


def predictions(spark):
    pairs = [(0, 0.0)] * 50 + [(0, 1.0)] * 7 + [(1, 0.0)] * 12 + [(1, 1.0)] * 9
    return spark.createDataFrame(pairs, "is_delayed int, prediction double")


def test_metrics_equal_the_evaluators(spark):
    rows = predictions(spark)
    got = evaluate.quality(rows).first()
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
    for field, metric in names.items():
        evaluator = MulticlassClassificationEvaluator(labelCol="is_delayed", predictionCol="prediction", metricName=metric)
        assert got[field] == round(evaluator.evaluate(rows), 4)
    assert got.confusion_matrix == {"label_0_pred_0": 50, "label_0_pred_1": 7, "label_1_pred_0": 12, "label_1_pred_1": 9}
    assert tuple(got.class_balance) == (78, round(21 / 78, 4), round(57 / 78, 4))
    cells = {r.cell: r.flights for r in evaluate.confusion(rows).collect()}
    assert cells == got.confusion_matrix


def test_metrics_of_nothing_and_of_one_class(spark):
    empty = evaluate.quality(predictions(spark).limit(0)).first()
    assert (empty.accuracy, empty.f1, empty.confusion_matrix) == (0.0, 0.0, {})
    assert tuple(evaluate.class_balance(predictions(spark).limit(0)).first()) == (0, 0.0, 0.0)
    one = evaluate.quality(predictions(spark).filter("is_delayed = 0")).first()
    assert one.recall == round(50 / 57, 4)


def test_training_job(spark, tmp_path, monkeypatch):
    flights, models = str(tmp_path / "flights"), str(tmp_path / "models")
    write_months(clean.with_month_keys(tables.flights(spark, SF)), flights)
    years = list(range(1995, 2002))
    found = train_job.run(spark, flights, models, "v1", years, extra_identity=tables.ROW_ID, trees=5, depth=4)
    rows = found["rows"]
    assert found["mode"] == "collapsed"
    assert rows["raw"] == 6000 and 0 < rows["test"] < rows["train"] < rows["features"] < 6000
    assert rows["train"] + rows["test"] == rows["features"]
    assert found["class_balance"]["total"] == rows["test"] and 0.4 < found["auc"] < 1.0
    written = json.loads(spark.read.text(f"{models}/v1_metrics.json").first()[0])
    assert written["confusion_matrix"] == found["confusion_matrix"] and written["auc"] == found["auc"]
    bagged = train_job.run(spark, flights, models, "v2", years, mode="rows", extra_identity=tables.ROW_ID, trees=5, depth=4)
    assert abs(bagged["auc"] - found["auc"]) < 0.1 and bagged["rows"] == rows
    assert bagged["class_balance"] == found["class_balance"]
    with pytest.raises(ValueError, match="mode"):
        train_job.run(spark, flights, models, "v3", years, mode="auto")
    out, rejects = str(tmp_path / "scored"), str(tmp_path / "rejects")
    tables.states(spark, SF).write.parquet(str(tmp_path / "states"))
    score_job.run(spark, found["model"], spark.read.parquet(str(tmp_path / "states")), out, rejects)
    scored, refused = spark.read.parquet(out), spark.read.parquet(rejects)
    assert scored.count() + refused.count() == 1000 and refused.count() > 0
    assert refused.filter("carrier is not null").count() == 0
    assert set(FEATURES) | {"delay_probability", "risk_label"} <= set(scored.columns)
