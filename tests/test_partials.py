"""Quality figures kept by month: equal to the whole report, recomputed only where months were written."""

import os
import shutil

from pyspark.sql import functions as F

from delayengine.operators import clean, quality
from delayengine.plans import tables
from delayengine.sinks.partials import month_files, refresh_partials
from delayengine.sinks.tables import write_months
from delayengine.sources.flights import scan_months
from delayengine.streaming.snapshots import SnapshotTable

SF = "/root/testdata/sf0.001"


def as_of():
    return F.lit("2001-12-31").cast("date")


def same_report(spark, root, store):
    whole = scan_months(spark, root)
    kept = quality.report_of_partials(store.read(), whole.columns, as_of())
    return sorted(map(tuple, kept.collect())) == sorted(map(tuple, quality.flight_report(whole, as_of()).collect()))


def test_only_rewritten_months_are_read(spark, tmp_path):
    root, store = str(tmp_path / "flights"), SnapshotTable(spark, str(tmp_path / "partials"))
    write_months(clean.with_month_keys(tables.flights(spark, SF)), root)
    months = {(r.year, r.month) for r in scan_months(spark, root).select("year", "month").distinct().collect()}
    assert set(refresh_partials(spark, root, store, as_of())) == months
    assert same_report(spark, root, store)
    assert refresh_partials(spark, root, store, as_of()) == [] and len(store.versions()) == 1
    bad = scan_months(spark, root, 1997, 6).withColumn("CANCELLED", F.lit(2.0).cast("float")).limit(1)
    write_months(spark.createDataFrame(bad.collect(), bad.schema), root)
    assert refresh_partials(spark, root, store, as_of()) == [(1997, 6)]
    assert same_report(spark, root, store) and store.read().count() == len(months)
    checks = {r.check: r.passed for r in quality.report_of_partials(store.read(), scan_months(spark, root).columns, as_of()).collect()}
    assert not checks["cancelled_flag"]


def test_months_that_are_gone_lose_their_row(spark, tmp_path):
    root, store = str(tmp_path / "flights"), SnapshotTable(spark, str(tmp_path / "partials"))
    write_months(clean.with_open_keys(tables.flights(spark, SF)), root)
    refresh_partials(spark, root, store, as_of())
    before = store.read().count()
    month = month_files(spark, root).orderBy("year", "month").first()
    shutil.rmtree(os.path.join(root, f"year={month.year}", f"month={month.month}"))
    assert refresh_partials(spark, root, store, as_of()) == []
    assert store.read().count() == before - 1 and same_report(spark, root, store)


def test_missing_columns_fail_as_in_the_whole_report(spark, tmp_path):
    root, store = str(tmp_path / "flights"), SnapshotTable(spark, str(tmp_path / "partials"))
    write_months(clean.with_month_keys(tables.flights(spark, SF)).drop("DISTANCE"), root)
    refresh_partials(spark, root, store, as_of())
    assert same_report(spark, root, store)
    line = quality.report_of_partials(store.read(), scan_months(spark, root).columns, as_of()).where("check = 'distance_positive'").first()
    assert not line.passed and line.observed == "column missing"
