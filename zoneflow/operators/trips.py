"""Trip-level features and the trip quality filter."""

from __future__ import annotations

from pyspark.sql import DataFrame

from zoneflow.config import StoreConfig
from zoneflow.functions.calendar import (
    calendar_of, flag_sql, hour_floor_sql, microseconds_sql, rush_flags, with_sql,
)

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
REVENUE_PARTS = ("fare_amount", "extra", "tip_amount", "tolls_amount", "Airport_fee")


def trip_features(trips: DataFrame, config: StoreConfig = StoreConfig()) -> DataFrame:
    """Enriched trips with 29 more columns: money and time, calendar, weather and airport flags."""
    airports = ", ".join("'" + name.replace("'", "\\'") + "'" for name in config.airport_zones)
    money = with_sql(trips, {
        "trip_duration_min": f"{microseconds_sql(PICKUP, DROPOFF)} / 6e7D",
        # Never negative. One unknown part makes it 0, which the quality filter then drops.
        "revenue": f"greatest({' + '.join(REVENUE_PARTS)}, 0D)",
    })
    return with_sql(money, {
        "revenue_per_hour": "CASE WHEN trip_duration_min > 1 THEN revenue / (trip_duration_min / 60D) END",
        "ts_hour": hour_floor_sql(PICKUP),
        "service_date": f"to_date({PICKUP})",
        **calendar_of(PICKUP),
        **rush_flags(PICKUP),
        "is_raining": flag_sql("precipitation > 0"),
        "is_cold": flag_sql("apparent_temperature < 5"),
        "is_hot": flag_sql("apparent_temperature > 30"),
        "is_airport_pickup": flag_sql(f"PUZone IN ({airports})"),
        "is_airport_dropoff": flag_sql(f"DOZone IN ({airports})"),
    })


def usable(config: StoreConfig = StoreConfig()) -> str:
    """Inclusive limits on every quality column, as SQL; an unknown value fails."""
    return " AND ".join(f"{name} BETWEEN {low}D AND {high}D" for name, (low, high) in config.limits.items())


def trip_quality_filter(features: DataFrame, config: StoreConfig = StoreConfig()) -> DataFrame:
    return features.filter(usable(config))
