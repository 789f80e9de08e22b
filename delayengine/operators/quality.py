"""Data-quality checks: each table is scanned once for all of its checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayengine.functions.clock import flight_date
from delayengine.schema import FLIGHT_TYPES

# Sane ranges (fixed values).
DELAY_RANGE = (-60, 600)
DEPARTURE_RANGE = (0, 2400)
FIRST_YEAR = 2019
MONTH_RANGE = (1, 12)


@dataclass(frozen=True)
class Check:
    """One rule: aggregates over the table, and a verdict over the aggregates."""

    name: str
    expected: str
    column: str
    aggregates: dict[str, Column]
    passed: Callable[[], Column]
    observed: Callable[[], Column]


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("none"))


def _span(name: str, column: str, low: int, high: int) -> Check:
    least, most = f"{name}_min", f"{name}_max"
    return Check(
        name,
        f"{column} in [{low}, {high}]",
        column,
        {least: F.min(column), most: F.max(column)},
        lambda: (F.col(least) >= F.lit(low)) & (F.col(most) <= F.lit(high)),
        lambda: F.concat(F.lit("min="), _text(F.col(least)), F.lit(", max="), _text(F.col(most))),
    )


def _no_violations(name: str, expected: str, column: str, violation: Column) -> Check:
    bad = f"{name}_bad"
    return Check(
        name,
        expected,
        column,
        {bad: F.count_if(violation)},
        lambda: F.col(bad) == F.lit(0),
        lambda: F.concat(F.lit("violations="), _text(F.col(bad))),
    )


def _flight_rules(as_of: Column) -> list[Check]:
    newest = F.col("newest_date")
    low, high = DEPARTURE_RANGE
    return [
        _span("dep_delay_range", "DEP_DELAY", *DELAY_RANGE),
        _span("arr_delay_range", "ARR_DELAY", *DELAY_RANGE),
        Check(
            "no_future_date",
            "FL_DATE not in the future",
            "FL_DATE",
            {"newest_date": F.max(flight_date(F.col("FL_DATE")))},
            lambda: newest <= as_of,
            lambda: F.concat(F.lit("max="), _text(newest)),
        ),
        _no_violations(
            "cancelled_flag", "CANCELLED is 0 or 1", "CANCELLED",
            ~F.col("CANCELLED").isin(0.0, 1.0),
        ),
        _no_violations(
            "distance_positive", "DISTANCE above 0", "DISTANCE", F.col("DISTANCE") <= F.lit(0)
        ),
        _no_violations(
            "departure_range", f"CRS_DEP_TIME in [{low}, {high}]", "CRS_DEP_TIME",
            ~F.col("CRS_DEP_TIME").between(low, high),
        ),
        _no_violations(
            "first_year", f"year from {FIRST_YEAR}", "year", F.col("year") < F.lit(FIRST_YEAR)
        ),
        _no_violations("month_range", "month in [1, 12]", "month", ~F.col("month").between(*MONTH_RANGE)),
    ]


def _report(table: DataFrame, rules: list[Check], fixed: list[tuple], rows: Column | None = None) -> DataFrame:
    def line(name: str, expected: str, passed: Column, observed: Column) -> Column:
        passed = F.coalesce(passed, F.lit(False))
        return F.struct(
            F.lit(name).alias("check"),
            passed.alias("passed"),
            observed.alias("observed"),
            F.concat(
                F.when(passed, F.lit("PASS ")).otherwise(F.lit("FAIL ")),
                F.lit(expected), F.lit(": "), observed,
            ).alias("message"),
        )

    live = [r for r in rules if r.column in table.columns]
    gone = [r for r in rules if r.column not in table.columns]
    lines = [line(*f) for f in fixed]
    lines += [line(r.name, r.expected, r.passed(), r.observed()) for r in live]
    lines += [line(r.name, r.expected, F.lit(False), F.lit("column missing")) for r in gone]
    aggregates = [column.alias(name) for r in live for name, column in r.aggregates.items()]
    one_row = table.agg((F.count(F.lit(1)) if rows is None else rows).alias("rows"), *aggregates)
    return one_row.select(F.inline(F.array(*lines)))


def _columns_line(columns: Sequence[str]) -> tuple[str, str, Column, Column]:
    missing = [c for c in FLIGHT_TYPES if c not in columns]
    return (
        "required_columns",
        f"{len(FLIGHT_TYPES)} flight columns present",
        F.lit(not missing),
        F.lit("missing=" + (",".join(missing) or "none")),
    )


def flight_report(flights: DataFrame, as_of: Column) -> DataFrame:
    """Columns ``check, passed, observed, message`` for a flights table.

    An all-NULL delay or date column fails its check. ``as_of`` is today's date.
    """
    return _report(flights, _flight_rules(as_of), [_columns_line(flights.columns)])


def _merged(name: str) -> Column:
    """How partial aggregates of a table's parts combine, by the ending of their names."""
    if name == "rows" or name.endswith("_bad"):
        return F.sum(name)
    return F.min(name) if name.endswith("_min") else F.max(name)


def flight_partials(flights: DataFrame, as_of: Column, by: tuple[str, ...] = ("year", "month")) -> DataFrame:
    """One row for each month with the aggregates that all checks of ``flight_report`` need."""
    rules = [r for r in _flight_rules(as_of) if r.column in flights.columns]
    aggregates = [c.alias(name) for r in rules for name, c in r.aggregates.items()]
    return flights.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *aggregates)


def report_of_partials(partials: DataFrame, columns: Sequence[str], as_of: Column) -> DataFrame:
    """``flight_report`` of a table with these columns, from the partial rows of its months."""
    rules = [r for r in _flight_rules(as_of) if r.column in columns]
    names = ["rows", *(name for r in rules for name in r.aggregates)]
    merged = [replace(r, aggregates={n: _merged(n) for n in r.aggregates}) for r in _flight_rules(as_of)]
    blank = [F.lit(None).alias(c) for c in columns if c not in partials.columns]
    return _report(partials.select(*names, *blank, *[c for c in ("year", "month") if c in columns]), merged, [_columns_line(columns)], F.sum("rows"))


def enriched_report(documents: DataFrame) -> DataFrame:
    """Every enriched document has an aircraft id."""
    rule = _no_violations("icao24_present", "icao24 not NULL", "icao24", F.col("icao24").isNull())
    return _report(documents, [rule], [])


def live_report(messages: DataFrame) -> DataFrame:
    """The live table holds entries, all of them valid JSON (column ``value``) and, where it has a ``key``, all under one."""
    invalid = F.try_parse_json(F.col("value")).isNull()
    rules = [
        _no_violations("live_json_valid", "values are JSON", "value", invalid),
        Check(
            "live_entries", "at least one entry", "value", {},
            lambda: F.col("rows") > F.lit(0),
            lambda: F.concat(F.lit("rows="), _text(F.col("rows"))),
        ),
    ]
    if "key" in messages.columns:
        blank = F.coalesce(F.col("key"), F.lit("")) == F.lit("")
        rules.append(_no_violations("live_keys", "entries have a key", "key", blank))
    return _report(messages, rules, [])


def roll_up(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total")
    )
