"""Every registered query against its SQL, on all rows of the small tables."""

import pytest
from compare import differences

import __spark_entry__ as driver

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_matches_sql(spark, name):
    assert differences(driver.queries()[name](spark, SF), driver.oracle_sql()[name], SF) == []


def test_entry_gives_rows(spark):
    assert driver.entry(spark).count() > 0


def test_only_model_queries_lack_sql():
    own = {name for name in driver.queries() if driver.queries()[name].__module__.startswith("delayengine.plans")}
    assert own - set(driver.oracle_sql()) == {
        "scored_flights", "confusion_matrix", "model_metrics", "collapsed_model_metrics", "predictions_filled",
        "stream_scored",
    }


def test_fact_rows_are_not_shuffled_to_build_a_view(spark):
    for name in ("flights_partitioned", "clean_flights", "labelled", "state_enriched", "route_features"):
        plan = driver.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_statistics_read_only_their_columns(spark):
    plan = driver.queries()["by_carrier"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan
    lineitem = next(l for l in plan.splitlines() if "lineitem.parquet" in l)
    assert "l_tax" not in lineitem and "l_shipdate" not in lineitem
    assert "PushedFilters: [IsNotNull(l_linenumber), Not(EqualTo(l_linenumber,7))" in lineitem


def test_expiry_reaches_the_scan(spark):
    plan = driver.queries()["live_expired"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in plan


def test_every_branch_occurs(spark):
    """Bands, alerts, limits, failing checks and late rows are all met by the queries that should show them."""
    def rows(name):
        return driver.queries()[name](spark, SF).collect()

    assert {r.band for r in rows("congestion_chart")} == {r.band for r in rows("congestion_risk")} == {"green", "orange", "red"}
    assert rows("kpis")[0].congestion_alerts > 0
    latest = driver.queries()["latest_state"](spark, SF).where("latitude is not null").count()
    assert len(rows("live_limit")) == 60 < latest
    assert {r.reason for r in rows("message_rejects")} == {None, "no aircraft"}
    assert not any(r.passed for r in rows("enriched_quality_raw"))
    assert {r.check: r.passed for r in rows("live_quality_raw")} == {"live_json_valid": False, "live_entries": True, "live_keys": False}
    assert sum(r.late for r in rows("stream_density")) > 0
    assert {r.reference_version for r in rows("stream_history")} == {0, 1}
