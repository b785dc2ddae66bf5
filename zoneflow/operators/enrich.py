"""Trips joined with the zone lookup and with hourly and daily weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.config import MonthWindow
from zoneflow.functions.calendar import hour_floor
from zoneflow.sources.files import unique_weather
from zoneflow.sources.sinks import in_window

TRIP_WEATHER_HOURLY = (
    "temperature_2m", "precipitation", "apparent_temperature",
    "wind_speed_10m", "wind_speed_100m", "relative_humidity_2m",
)
TRIP_WEATHER_DAILY = ("apparent_temperature_mean", "precipitation_hours", "sunrise", "sunset")

def with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Pickup and dropoff zone names. Unknown ids keep their trip, with NULL names.

    No hint: the lookup is a file scan, so Spark knows its size and broadcasts it while it is small.
    """
    for end, key in (("PU", "PULocationID"), ("DO", "DOLocationID")):
        side = zones.select(
            F.col("LocationID").cast("bigint").alias(f"_{end}"),
            F.col("Borough").alias(f"{end}Borough"),
            F.col("Zone").alias(f"{end}Zone"),
        )
        trips = trips.join(side, F.col(key) == F.col(f"_{end}"), "left").drop(f"_{end}")
    return trips


def with_weather(trips: DataFrame, weather: DataFrame, window: MonthWindow | None = None) -> DataFrame:
    """Weather of the pickup's hour and day.

    With a month window the weather side holds at most one row per hour of it, which proves that it
    can be broadcast; without one the choice is left to Spark's size check. Each side is one row per time
    step, so no trip is multiplied.
    """
    pickup = "tpep_pickup_datetime"
    if window:
        weather = weather.filter(in_window("date", window))
    hourly = unique_weather(weather, "hourly", F.col("date"), TRIP_WEATHER_HOURLY).withColumnRenamed("at", "_hour")
    daily = unique_weather(weather, "daily", F.to_date("date"), TRIP_WEATHER_DAILY).withColumnRenamed("at", "_day")
    # Sub-hour time stamps never match a pickup hour; without them the bound on the hourly side holds.
    hourly = hourly.filter(F.col("_hour") == hour_floor("_hour"))
    if window:
        hourly, daily = F.broadcast(hourly), F.broadcast(daily)
    joined = trips.join(hourly, hour_floor(pickup) == F.col("_hour"), "left")
    joined = joined.join(daily, F.to_date(pickup) == F.col("_day"), "left")
    return joined.drop("_hour", "_day")


def enrich_trips(
    trips: DataFrame, zones: DataFrame, weather: DataFrame, window: MonthWindow | None = None
) -> DataFrame:
    """Trips with 4 zone and 10 weather columns. With a window only its trips are read."""
    if window:
        trips = trips.filter(in_window("tpep_pickup_datetime", window))
    return with_weather(with_zones(trips, zones), weather, window)
