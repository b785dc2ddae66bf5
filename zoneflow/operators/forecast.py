"""The forecast frame: start, future grid, time-shifted history, climatology, filling, checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.config import (
    FEATURES, HOUR_WEATHER_MEANS, MAX_HORIZON_HOURS, RANK_SIGNALS, SAME_HOUR_MEASURES, ZONE_HOUR_MEANS,
)
from zoneflow.functions.calendar import CALENDAR_COLUMNS, ntz, plus_hours, with_calendar, with_sql
from zoneflow.operators.hourly import rolling_columns
from zoneflow.operators.quantiles import column_limits, count_medians, merged_counts, tail_limits, value_counts
from zoneflow.session import materialize

GRID_ZONE = ("PUZone", "PUBorough", "PUZone_enc", "PUBorough_enc")

HISTORY_ROLLING = (
    "rolling_24h_trip_mean", "rolling_168h_trip_mean", "rolling_24h_rph_mean", "rolling_7d_rph_mean",
    "rolling_24h_rph_std",
)

# Hours back -> {history column: feature}.
LAG_PLAN = {
    1: {
        "trip_count": "lag_1h_trip_count",
        "target_rph": "lag_1h_rph",
        "rolling_24h_rph_mean": "rolling_24h_rph_mean",
        "rolling_7d_rph_mean": "rolling_7d_rph_mean",
        "rolling_24h_rph_std": "rolling_24h_rph_std",
        **{m: f"lag1h_{m}" for m in SAME_HOUR_MEASURES},
    },
    2: {"trip_count": "lag_2h_trip_count", "target_rph": "lag_2h_rph"},
    24: {
        "trip_count": "lag_24h_trip_count",
        "rolling_24h_trip_mean": "rolling_24h_trip_mean",
        "rolling_168h_trip_mean": "rolling_168h_trip_mean",
        "target_rph": "lag_24h_rph",
    },
    168: {"target_rph": "lag_168h_rph"},
}

# The online forecast knows no same-hour measures and no weekly trip mean; climatology replaces them.
ONLINE_LAG_PLAN = {
    1: {
        "trip_count": "lag_1h_trip_count",
        "target_rph": "lag_1h_rph",
        "rolling_24h_rph_mean": "rolling_24h_rph_mean",
        "rolling_7d_rph_mean": "rolling_7d_rph_mean",
        "rolling_24h_rph_std": "rolling_24h_rph_std",
    },
    2: LAG_PLAN[2],
    24: {
        "trip_count": "lag_24h_trip_count",
        "rolling_24h_trip_mean": "rolling_24h_trip_mean",
        "target_rph": "lag_24h_rph",
    },
    168: LAG_PLAN[168],
}

# Corrected mode: windows end with the last known hour, so all of them attach one hour later.
CORRECTED_LAG_PLAN = {
    **LAG_PLAN,
    1: {**LAG_PLAN[1], **{c: c for c in (*HISTORY_ROLLING, "rolling_airport_activity")}},
    24: {"trip_count": "lag_24h_trip_count", "target_rph": "lag_24h_rph"},
}


def check_request(hours: int, top: int | None = None, rank_by: str = "opportunity",
                  max_hours: int | None = None) -> None:
    """Limits of a forecast request; ``max_hours`` is the online limit."""
    if hours < 1:
        raise ValueError(f"hours must be at least 1, got {hours}")
    if max_hours is not None and hours > max_hours:
        raise ValueError(f"hours must be at most {max_hours}, got {hours}")
    if top is not None and top < 1:
        raise ValueError(f"top must be at least 1, got {top}")
    if rank_by not in RANK_SIGNALS:
        raise ValueError(f"no signal {rank_by!r} to rank by; known: {', '.join(RANK_SIGNALS)}")


def check_online_request(hours: int, top: int | None, rank_by: str) -> None:
    check_request(hours, top, rank_by, MAX_HORIZON_HOURS)


def forecast_start(history: DataFrame, start: dt.datetime | None = None) -> DataFrame:
    """One row: range and size of the history and the first hour to forecast."""
    first = ntz(start) if start is not None else plus_hours(F.max("ts_hour"), 1)
    return history.agg(
        F.min("ts_hour").alias("data_min_ts_hour"),
        F.max("ts_hour").alias("data_max_ts_hour"),
        F.count("*").alias("history_rows"),
        first.alias("forecast_start"),
    )


def start_column(history: DataFrame, start: dt.datetime | None = None) -> Column:
    """The first forecast hour as a value usable in any expression: a literal, or a scalar subquery."""
    if start is not None:
        return ntz(start)
    return history.agg(plus_hours(F.max("ts_hour"), 1)).scalar()


def future_grid(history: DataFrame, first: Column, hours: int, compat: bool = True) -> DataFrame:
    """Every zone of the history in every future hour, with calendar columns. Hours unfold per zone, so
    the zones meet no cross join."""
    zones = history.select(*[c for c in GRID_ZONE if c in history.columns]).distinct()
    step = F.make_dt_interval(F.lit(0), F.lit(1))
    ahead = F.sequence(first, plus_hours(first, hours - 1), step)
    grid = zones.withColumn("ts_hour", F.explode(ahead))
    # In compatible mode a future Monday is day 0 although training counts Sunday as 0.
    return with_calendar(grid, monday_first=compat).drop("year")


def history_rolling(history: DataFrame, names: Sequence[str] = HISTORY_ROLLING, include_current: bool = False
                    ) -> DataFrame:
    """Rolling values recomputed on the stored rows, thin hours already dropped."""
    return history.drop(*names).withColumns(rolling_columns(tuple(names), include_current))


def recent_history(history: DataFrame, first: Column, hours: int, rows_back: int = 168, hours_back: int = 168
                   ) -> DataFrame:
    """The rows of each zone that lags and rolling values of the grid can depend on.

    Lags reach rows of the last ``hours_back`` hours and of the horizon; a window on such a row reaches
    ``rows_back`` rows further, however old. So the newest ``rows_back + hours_back + hours`` hours that a zone
    has rows in are enough, with all rows of each, and Spark drops the others before the shuffle. Nothing
    changes in the result; years of history just stay where they are.
    """
    newest = Window.partitionBy("PUZone").orderBy(F.col("ts_hour").desc())
    reached = history.filter(F.col("ts_hour") < plus_hours(first, hours))
    numbered = reached.withColumn("_newest", F.dense_rank().over(newest))
    return numbered.filter(F.col("_newest") <= rows_back + hours_back + hours).drop("_newest")


def time_lag_join(grid: DataFrame, history: DataFrame, first: Column, hours: int, plan: dict = LAG_PLAN) -> DataFrame:
    """Attach history by clock time: a feature k hours back is the history row of exactly k hours before.

    All offsets are served by one aggregation and one join. Each history row is sent to the future hours
    it is a lag for (at most one per offset), rows that reach no hour of the grid are dropped first, and
    one row per (zone, hour) carries every lag. (zone, hour) must be unique in the history; see
    ``repeated_cells``.
    """
    sources = sorted({s for lags in plan.values() for s in lags if s in history.columns})
    last = plus_hours(first, hours - 1)
    reach = history.filter(
        (F.col("ts_hour") >= plus_hours(first, -max(plan))) & (F.col("ts_hour") <= plus_hours(last, -min(plan))))
    sent = reach.select("PUZone", "ts_hour", *sources, F.explode(F.array(*[F.lit(k) for k in plan])).alias("_k"))
    sent = sent.withColumn("ts_hour", plus_hours(F.col("ts_hour"), F.col("_k"))).filter(
        F.col("ts_hour").between(first, last))
    lags = [
        F.expr(f"max(CASE WHEN _k = {k} THEN {source} END) AS {feature}")
        for k, columns in plan.items() for source, feature in columns.items() if source in sources
    ]
    return grid.join(sent.groupBy("PUZone", "ts_hour").agg(*lags), ["PUZone", "ts_hour"], "left")


def lag_derived(lagged: DataFrame, weekly_activity: bool = True) -> DataFrame:
    """Momentum and stability of a future row, from its lags alone."""
    columns = {
        "trip_count_delta_1h": "lag_1h_trip_count - lag_2h_trip_count",
        "rph_delta_1h": "lag_1h_rph - lag_2h_rph",
        "rph_zscore": "(lag_1h_rph - rolling_24h_rph_mean) / (coalesce(rolling_24h_rph_std, 0D) + 1e-6D)",
        "rph_cv": "coalesce(rolling_24h_rph_std, 0D) / (coalesce(rolling_24h_rph_mean, 0D) + 1e-6D)",
    }
    if weekly_activity:
        columns["relative_zone_activity"] = "lag_1h_trip_count / nullif(rolling_168h_trip_mean, 0D)"
    return with_sql(lagged, columns)


def zone_hour_means(history: DataFrame) -> DataFrame:
    names = [c for c in ZONE_HOUR_MEANS if c in history.columns]
    return history.groupBy("PUZone", "hour").agg(*[F.avg(c).alias(c) for c in names])


def hour_weather_means(history: DataFrame) -> DataFrame:
    names = [c for c in HOUR_WEATHER_MEANS if c in history.columns]
    return history.groupBy("hour").agg(*[F.avg(c).alias(c) for c in names])


def zone_hour_stats(grid: DataFrame, history: DataFrame) -> DataFrame:
    """Climatology: means per zone and hour of day, weather means per hour of day."""
    joined = grid.join(zone_hour_means(history), ["PUZone", "hour"], "left")
    # At most 24 rows.
    return joined.join(F.broadcast(hour_weather_means(history)), "hour", "left")


def feature_counts(history: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Value counts of a part of the history, for :func:`fill_missing`: what a month adds to the medians of all months."""
    return value_counts(history, [c for c in features if c in history.columns], ["PUZone"])


def fill_missing(future: DataFrame, history: DataFrame, features: Sequence[str] = FEATURES, counts: DataFrame | None = None) -> DataFrame:
    """Missing features become the zone's median, else the median of all zones, else 0. A feature that
    the frame lacks altogether starts out missing.

    ``counts``: :func:`feature_counts` of the parts of the history, one after the other; without them the history is counted
    here, once for both kinds of medians."""
    always_there = set(GRID_ZONE) | set(CALENDAR_COLUMNS)
    fillable = [c for c in features if not (c in always_there and c in future.columns)]
    known = [c for c in fillable if c in history.columns]
    frame = future
    if known:
        if counts is None:
            counts, limits = materialize(feature_counts(history, known)), materialize(column_limits(history, known))
        else:
            counts = materialize(merged_counts(counts.filter(F.col("_column").isin(known)), ["PUZone"]))
            limits = materialize(tail_limits(counts))
        by_zone = count_medians(counts, known, ["PUZone"], limits).withColumnsRenamed({c: f"_zone_{c}" for c in known})
        # The medians of all zones are one row, read once as a subquery.
        overall = count_medians(merged_counts(counts), known, limits=limits).select(F.struct(*known)).scalar()
        frame = frame.join(by_zone, "PUZone", "left").withColumn("_all", overall)

    def filled(c: str) -> str:
        sources = [f"double({c})"] if c in future.columns else []
        if c in known:
            sources += [f"_zone_{c}", f"_all.{c}"]
        return f"coalesce({', '.join([*sources, '0D'])})"

    return with_sql(frame, {c: filled(c) for c in fillable}).drop("_all", *[f"_zone_{c}" for c in known])


def forecast_window_check(future: DataFrame, first: Column, hours: int) -> DataFrame:
    """One row: the hours asked for, the hours present, and whether they agree."""
    return future.agg(F.min("ts_hour").alias("actual_first"), F.max("ts_hour").alias("actual_last")).select(
        first.alias("expected_first"), "actual_first",
        plus_hours(first, hours - 1).alias("expected_last"), "actual_last",
    ).withColumn("ok", F.coalesce(
        (F.col("expected_first") == F.col("actual_first")) & (F.col("expected_last") == F.col("actual_last")),
        F.lit(False)))


def assert_forecast_window(future: DataFrame, first: Column, hours: int) -> None:
    row = forecast_window_check(future, first, hours).first()
    if not row.ok:
        raise ValueError(f"the rows span {row.actual_first} to {row.actual_last}, asked for were {row.expected_first} "
                         f"to {row.expected_last}")
