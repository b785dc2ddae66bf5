"""Quality rules on trips and weather, and a gate that fails on them.

Every report has one row per rule: ``rule``, ``checked_rows``, ``violations``, ``passed``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.schemas import DAILY_MEASURES, DAILY_TEXTS, HOURLY_MEASURES, TRIP_SCHEMA

# --- Fixed values: required columns and allowed ranges and values ------------------------------

REQUIRED_TRIP_COLUMNS = tuple(TRIP_SCHEMA.names)

# Column -> (test, limit) pairs a value must pass.
TRIP_RANGES = {
    "passenger_count": ((">", 0), ("<=", 10)),
    "trip_distance": ((">=", 0), ("<=", 300)),
    "fare_amount": ((">=", 0),),
    "extra": ((">=", 0), ("<=", 5)),
    "mta_tax": ((">=", 0), ("<=", 5)),
    "tip_amount": ((">=", 0),),
    "tolls_amount": ((">=", 0),),
    "total_amount": ((">=", 0),),
    "Airport_fee": ((">=", 0),),
    "PULocationID": ((">", 0),),
    "DOLocationID": ((">", 0),),
}

TRIP_VALUE_SETS = {
    "payment_type": (1, 2, 3, 4),
    "RatecodeID": (1, 2, 3, 4, 5),
    "store_and_fwd_flag": ("Y", "N"),
}

# Part of a weather column's name -> its tests.
WEATHER_RANGES = {
    "temperature": ((">=", -60), ("<=", 60)),
    "wind": ((">=", 0),),
    "precipitation": ((">=", 0),),
    "relative_humidity_2m": ((">=", 0), ("<=", 100)),
}

DUPLICATE_SHARE, DUPLICATE_FLOOR = 0.01, 10

# ------------------------------------------------------------------------------------------------


class QualityError(AssertionError):
    """At least one quality rule failed."""


def _breaks(column: str, test: str, limit: float) -> Column:
    c = F.col(column)
    return {">": c <= limit, ">=": c < limit, "<=": c > limit}[test]


def _report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Count violations of all rules in one pass; a rule that is unknown for a row is not violated."""
    counts = [F.count_if(broken).alias(f"v{i}") for i, broken in enumerate(rules.values())]
    totals = df.agg(F.count("*").alias("n"), *counts)
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.col("n").alias("checked_rows"), F.col(f"v{i}").alias("violations"))
        for i, rule in enumerate(rules)
    ]
    return totals.select(F.inline(F.array(*rows))).withColumn("passed", F.col("violations") == 0)


def range_rules(ranges: Mapping[str, Iterable[tuple[str, float]]]) -> dict[str, Column]:
    return {f"{c} {t} {limit}": _breaks(c, t, limit) for c, tests in ranges.items() for t, limit in tests}


def trip_rules(trips: DataFrame) -> DataFrame:
    return _report(trips, range_rules(TRIP_RANGES))


def weather_rules(weather: DataFrame) -> DataFrame:
    """Range rules for every numeric column whose name holds a known measure."""
    numeric = [f.name for f in weather.schema if isinstance(f.dataType, T.NumericType)]
    ranges = {c: tests for part, tests in WEATHER_RANGES.items() for c in numeric if part in c.lower()}
    return _report(weather, range_rules(ranges))


def value_set_rules(trips: DataFrame, allowed: Mapping[str, tuple] = TRIP_VALUE_SETS) -> DataFrame:
    """Rows outside a column's value set. NULL is a value here and counts as a violation."""
    rules = {f"{c} in {'/'.join(map(str, v))}": F.col(c).isNull() | ~F.col(c).isin(*v) for c, v in allowed.items()}
    return _report(trips, rules)


def _presence(df: DataFrame, rules: Mapping[str, bool]) -> DataFrame:
    """Rules about the schema hold for all rows or none; they are counted once."""
    return _report_constant(df, {rule: 0 if ok else 1 for rule, ok in rules.items()})


def _report_constant(df: DataFrame, violations: Mapping[str, int]) -> DataFrame:
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.col("n").alias("checked_rows"), F.lit(v).cast("bigint").alias("violations"))
        for rule, v in violations.items()
    ]
    empty = F.struct(
        F.lit("not empty").alias("rule"), F.col("n").alias("checked_rows"),
        F.when(F.col("n") > 0, 0).otherwise(1).cast("bigint").alias("violations"),
    )
    totals = df.agg(F.count("*").alias("n"))
    return totals.select(F.inline(F.array(*rows, empty))).withColumn("passed", F.col("violations") == 0)


def trip_schema_rules(trips: DataFrame) -> DataFrame:
    """Required columns, time stamp types, not empty."""
    types = {f.name: f.dataType for f in trips.schema}
    rules = {f"has {c}": c in types for c in REQUIRED_TRIP_COLUMNS}
    for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        rules[f"{c} is a timestamp"] = isinstance(types.get(c), (T.TimestampNTZType, T.TimestampType))
    return _presence(trips, rules)


def weather_schema_rules(weather: DataFrame) -> DataFrame:
    """All hourly or all daily columns, not empty."""
    have = set(weather.columns)
    hourly, daily = set(HOURLY_MEASURES), set(DAILY_MEASURES) | set(DAILY_TEXTS)
    return _presence(weather, {"has all hourly or all daily columns": hourly <= have or daily <= have})


def duplicate_check(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in full. Up to 1 % of the rows, and up to 10 always, may.

    Copies of a hot row collapse map-side before the shuffle.
    """
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    found = copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("violations"),
    )
    allowed = F.greatest(F.floor(F.col("checked_rows") * F.lit(DUPLICATE_SHARE)), F.lit(DUPLICATE_FLOOR))
    return found.select(
        F.lit("full-row duplicates").alias("rule"), "checked_rows", "violations",
        (F.col("violations") <= allowed).alias("passed"),
    )


def quality_gate(*reports: DataFrame) -> None:
    """Raise :class:`QualityError` naming every failed rule. A report is one row per rule."""
    failed = [
        f"{r.rule}: {r.violations} of {r.checked_rows}"
        for report in reports for r in report.filter(~F.col("passed")).collect()
    ]
    if failed:
        raise QualityError("; ".join(failed))
