"""Declared schemas of the inputs. Reading with a declared schema needs no footer scan."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _DOUBLE, _TEXT, _TIME, _INT = (
    T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType(), T.IntegerType())


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


TRIP_SCHEMA = _schema(
    ("VendorID", _LONG), ("tpep_pickup_datetime", _TIME), ("tpep_dropoff_datetime", _TIME),
    ("passenger_count", _DOUBLE), ("trip_distance", _DOUBLE), ("RatecodeID", _LONG),
    ("store_and_fwd_flag", _TEXT), ("PULocationID", _LONG), ("DOLocationID", _LONG), ("payment_type", _LONG),
    ("fare_amount", _DOUBLE), ("extra", _DOUBLE), ("mta_tax", _DOUBLE), ("tip_amount", _DOUBLE),
    ("tolls_amount", _DOUBLE), ("total_amount", _DOUBLE), ("Airport_fee", _DOUBLE),
)

HOURLY_MEASURES = (
    "temperature_2m", "precipitation", "apparent_temperature",
    "wind_speed_100m", "wind_speed_10m", "relative_humidity_2m",
)
DAILY_MEASURES = ("temperature_2m_max", "temperature_2m_min", "apparent_temperature_mean", "precipitation_hours")
DAILY_TEXTS = ("sunset", "sunrise")

WEATHER_SCHEMA = _schema(
    ("date", _TIME), ("type", _TEXT), *[(c, _DOUBLE) for c in HOURLY_MEASURES + DAILY_MEASURES],
    *[(c, _TEXT) for c in DAILY_TEXTS], ("trip_month", _TEXT),
)


def _arrays(doubles: tuple[str, ...], texts: tuple[str, ...] = ()) -> T.StructType:
    return _schema(("time", T.ArrayType(_TEXT)), *[(c, T.ArrayType(_DOUBLE)) for c in doubles],
                   *[(c, T.ArrayType(_TEXT)) for c in texts])


WEATHER_PAYLOAD_SCHEMA = _schema(
    ("hourly", _arrays(HOURLY_MEASURES)), ("daily", _arrays(DAILY_MEASURES, DAILY_TEXTS)))

ZONE_SCHEMA = _schema(("LocationID", _INT), ("Borough", _TEXT), ("Zone", _TEXT))

FORECAST_SCHEMA = _schema(
    ("ts_hour", _TIME), ("PUZone", _TEXT), ("PUBorough", _TEXT), ("rank", _INT),
    *[(c, _DOUBLE) for c in (
        "opportunity_score", "pred_demand", "pred_rph", "pred_competition", "pred_tip_prob",
        "score_demand", "score_profit", "score_competition", "score_tip")],
)

METRIC_SCHEMA = _schema(("run_id", _TEXT), ("run_ts", _TIME), ("metric", _TEXT), ("value", _DOUBLE))
