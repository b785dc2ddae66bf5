"""The hourly zone store: cells of (zone, borough, hour) with measures, flow, lags and rolling values.

Trip rows only meet aggregations that combine map-side. Windows run on cells, where a zone has at most
one row per hour (and borough), so no partition grows beyond the hours of the history read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.config import SAME_HOUR_MEASURES, TRIP_LIMITS, MonthWindow, StoreConfig
from zoneflow.functions.calendar import ntz, with_calendar, with_sql
from zoneflow.functions.scalar import ratio_sql
from zoneflow.operators.quantiles import group_quantiles, key_sql, keyed
from zoneflow.session import materialize
from zoneflow.sources.sinks import in_month

CELL = ("PUZone", "PUBorough", "ts_hour")

# Mean of a cell -> what is averaged over its trips.
CELL_MEANS = {
    "target_rph": "revenue_per_hour",
    "avg_revenue": "revenue",
    "avg_tip": "tip_amount",
    "tip_rate": "CASE WHEN tip_amount > 0 THEN 1D ELSE 0D END",
    "avg_distance_mi": "trip_distance",
    "avg_duration_min": "trip_duration_min",
    "precipitation": "precipitation",
    "temperature": "apparent_temperature",
    "wind_speed": "wind_speed_10m",
    "frac_raining": "double(is_raining)",
    "frac_airport_pickup": "double(is_airport_pickup)",
    "frac_airport_dropoff": "double(is_airport_dropoff)",
}
CELL_QUANTILES = {"median_rph": 0.5, "p75_rph": 0.75}


def hourly_pickups(trips: DataFrame, limits: dict = TRIP_LIMITS) -> DataFrame:
    """Pickups per cell: trip count, 12 means, median and 75th percentile of revenue per hour.

    Counts and means combine map-side, so a hot cell costs a row per task. The quantiles are a branch of
    their own over four columns, partitioned by cell at its end as the means are: joining them moves
    nothing, and a plan that uses no quantile drops the branch. The calendar depends on the hour alone and
    is added after grouping instead of widening the key.
    """
    means = [f"avg({source}) AS {name}" for name, source in CELL_MEANS.items()]
    cells = trips.groupBy(F.expr(key_sql(CELL))).agg(*[F.expr(a) for a in ("count(*) AS trip_count", *means)])
    rows = keyed(trips, CELL, "revenue_per_hour", *limits["revenue_per_hour"])
    cells = cells.join(group_quantiles(rows, CELL_QUANTILES), "_k", "left")
    cells = cells.selectExpr("_k.*", "trip_count", *CELL_MEANS, *CELL_QUANTILES)
    return with_calendar(cells).selectExpr("*", "to_date(ts_hour) AS service_date")


def hourly_dropoffs(trips: DataFrame) -> DataFrame:
    """Trips that end in a zone, by the hour they *started*."""
    return trips.groupBy(F.col("DOZone").alias("zone"), "ts_hour").agg(F.count("*").alias("dropoff_count"))


def pickup_dropoff_flow(pickups: DataFrame, dropoffs: DataFrame) -> DataFrame:
    """Pickups with the arrivals of the same zone and hour; no arrivals count as 0."""
    arrivals = dropoffs.withColumnRenamed("zone", "PUZone")
    merged = pickups.join(arrivals, ["PUZone", "ts_hour"], "left").fillna(0, ["dropoff_count"])
    return with_sql(merged, {
        "net_pickup_flow": "trip_count - dropoff_count",
        "pickup_dropoff_ratio": ratio_sql("double(trip_count)", "dropoff_count"),
    })


def _by_zone():
    return Window.partitionBy("PUZone").orderBy("ts_hour", "PUBorough")


LAGS = {
    "lag_1h_rph": ("target_rph", 1),
    "lag_2h_rph": ("target_rph", 2),
    "lag_24h_rph": ("target_rph", 24),
    "lag_168h_rph": ("target_rph", 168),
    "lag_1h_trip_count": ("trip_count", 1),
    "lag_2h_trip_count": ("trip_count", 2),
    "lag_24h_trip_count": ("trip_count", 24),
    "lag_1h_dropoff_count": ("dropoff_count", 1),
}

# Rolling value -> (aggregate, column, rows before the current one).
ROLLING = {
    "rolling_24h_trip_mean": (F.avg, "trip_count", 24),
    "rolling_168h_trip_mean": (F.avg, "trip_count", 168),
    "rolling_24h_rph_mean": (F.avg, "target_rph", 24),
    "rolling_7d_rph_mean": (F.avg, "target_rph", 168),
    "rolling_24h_rph_std": (F.stddev_samp, "target_rph", 24),
    "rolling_airport_activity": (F.avg, "frac_airport_pickup", 24),
}


def lag_columns() -> dict[str, Column]:
    by_zone = _by_zone()
    return {name: F.lag(source, k).over(by_zone) for name, (source, k) in LAGS.items()}


def rolling_columns(names=tuple(ROLLING), include_current: bool = False) -> dict[str, Column]:
    """Means and deviations over the rows before the current one (or up to it)."""
    last = 0 if include_current else -1
    by_zone = _by_zone()
    return {
        name: aggregate(source).over(by_zone.rowsBetween(last - rows + 1, last))
        for name, (aggregate, source, rows) in ROLLING.items() if name in names
    }


def lag_features(flow: DataFrame) -> DataFrame:
    return flow.withColumns(lag_columns())


def rolling_features(flow: DataFrame) -> DataFrame:
    return flow.withColumns(rolling_columns())


def derived_features(lagged: DataFrame, compat: bool = True) -> DataFrame:
    """Momentum, stability, speed and congestion of a cell.

    In compatible mode ``rph_delta_1h`` and ``rph_zscore`` use the hour's own revenue; otherwise the
    last known hour's, as a forecast has to.
    """
    now, previous = ("target_rph", "lag_1h_rph") if compat else ("lag_1h_rph", "lag_2h_rph")
    speed = "(avg_distance_mi / (avg_duration_min / 60D))"
    derived = with_sql(lagged, {
        "trip_count_delta_1h": "lag_1h_trip_count - lag_2h_trip_count",
        "demand_vs_baseline": ratio_sql("trip_count", "rolling_24h_trip_mean"),
        "rph_delta_1h": f"{now} - {previous}",
        "rph_zscore": ratio_sql(f"({now} - rolling_24h_rph_mean)", "rolling_24h_rph_std"),
        "avg_speed_mph": f"CASE WHEN avg_duration_min > 0 THEN {speed} END",
        "congestion_score": f"CASE WHEN avg_duration_min > 0 AND avg_distance_mi > 0 THEN 1D / {speed} END",
        "rph_cv": ratio_sql("rolling_24h_rph_std", "rolling_24h_rph_mean"),
        "relative_zone_activity": ratio_sql("lag_1h_trip_count", "rolling_168h_trip_mean"),
    })
    return derived.withColumn("precipitation_delta", F.col("precipitation") - F.lag("precipitation", 1).over(_by_zone()))


def shifted_features(derived: DataFrame) -> DataFrame:
    """Every same-hour measure as the value of the zone's previous row."""
    by_zone = _by_zone()
    return derived.withColumns({f"lag1h_{m}": F.lag(m, 1).over(by_zone) for m in SAME_HOUR_MEASURES})


def hour_grid(cells: DataFrame) -> DataFrame:
    """Every clock hour of each zone between its first and last cell; added hours have NULL measures."""
    spans = cells.groupBy("PUZone", "PUBorough").agg(F.expr("min(ts_hour) AS a"), F.expr("max(ts_hour) AS b"))
    hours = spans.selectExpr("PUZone", "PUBorough", "explode(sequence(a, b, INTERVAL 1 HOUR)) AS ts_hour")
    # The struct key lets the NULL zone meet its own cells.
    keyed = hours.selectExpr(key_sql(CELL)).join(cells.selectExpr(key_sql(CELL), "struct(*) AS c"), "_k", "left")
    return keyed.selectExpr("_k.*", *[f"c.`{name}`" for name in cells.columns if name not in CELL])


def store_features(flow: DataFrame, config: StoreConfig = StoreConfig()) -> DataFrame:
    """All window features of the flow cells: one sort per zone serves every lag and frame."""
    by_hour = hour_grid(flow) if config.lag_mode == "time" else flow
    lagged = by_hour.withColumns({**lag_columns(), **rolling_columns()})
    featured = shifted_features(derived_features(lagged, config.compat))
    return featured.filter("trip_count IS NOT NULL") if config.lag_mode == "time" else featured


def flow_cells(trips: DataFrame, config: StoreConfig = StoreConfig()) -> DataFrame:
    return pickup_dropoff_flow(hourly_pickups(trips, config.limits), hourly_dropoffs(trips))


def feature_store_month(trips: DataFrame, window: MonthWindow, config: StoreConfig = StoreConfig()) -> DataFrame:
    """Store rows of the target month: windows see lookback and thin cells, the filters come last."""
    featured = store_features(flow_cells(trips, config), config)
    return featured.filter((F.col("trip_count") >= config.min_trips) & in_month("ts_hour", window))


#: Rows of a zone before a month that its windows reach: the longest lag or frame, and one for what is shifted afterwards.
TAIL_ROWS = max(*(k for _, k in LAGS.values()), *(rows for *_, rows in ROLLING.values())) + 25


def zone_tails(flow: DataFrame, rows: int = TAIL_ROWS) -> DataFrame:
    """The newest ``rows`` flow cells of every zone. Spark limits each group before the shuffle."""
    newest_first = Window.partitionBy("PUZone").orderBy(F.desc("ts_hour"), F.desc("PUBorough"))
    return flow.withColumn("_place", F.row_number().over(newest_first)).filter(F.col("_place") <= rows).drop("_place")


def feature_store_after(tails: DataFrame | None, trips: DataFrame, window: MonthWindow, config: StoreConfig = StoreConfig()
                        ) -> tuple[DataFrame, DataFrame]:
    """(store rows of the month, tails after it) from the month's trips and the tails before it.

    However far apart a zone's rows lie, this equals a build over all history, which a lookback of whole months does not. The
    month's flow is aggregated once and no earlier trip is read. Stepping by clock hours, rows further back than the longest
    window do not count and are left out of the grid.
    """
    own = materialize(flow_cells(trips.filter(in_month("tpep_pickup_datetime", window)), config))
    both = own if tails is None else tails.unionByName(own)
    seen = both
    if config.lag_mode == "time":
        seen = both.filter(F.col("ts_hour") >= ntz(window.start) - F.make_dt_interval(F.lit(0), F.lit(TAIL_ROWS)))
    featured = store_features(seen, config)
    return featured.filter((F.col("trip_count") >= config.min_trips) & in_month("ts_hour", window)), zone_tails(both)
