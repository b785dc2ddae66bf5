"""Scans of trip, weather and zone files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.schemas import (
    DAILY_MEASURES, DAILY_TEXTS, HOURLY_MEASURES, TRIP_SCHEMA, WEATHER_PAYLOAD_SCHEMA, WEATHER_SCHEMA, ZONE_SCHEMA,
)


class NoInputError(FileNotFoundError):
    """No file matches a scan's pattern."""


def _scan(spark: SparkSession, pattern: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    try:
        return reader.parquet(pattern)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise NoInputError(f"no parquet input matches {pattern}") from error
        raise


def trip_path(base: str, month: str, dataset: str = "yellow") -> str:
    return f"{base}/{dataset}_tripdata_{month}.parquet"


def weather_path(base: str, month: str) -> str:
    return f"{base}/weather_{month}.parquet"


def scan_trips(spark: SparkSession, base: str, schema: T.StructType | None = TRIP_SCHEMA) -> DataFrame:
    """All monthly trip files below ``base``. ``schema=None`` merges the schemas of all files instead,
    which reads every footer first."""
    return _scan(spark, f"{base}/*tripdata*.parquet", schema)


def scan_weather(spark: SparkSession, base: str, schema: T.StructType | None = WEATHER_SCHEMA) -> DataFrame:
    """All monthly weather files; the single legacy file only where there is no monthly one, since
    reading both would repeat hours."""
    try:
        return _scan(spark, f"{base}/weather_*.parquet", schema)
    except NoInputError:
        return _scan(spark, f"{base}/weather.parquet", schema)


def scan_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV; the text ``N/A`` is NULL."""
    return spark.read.schema(ZONE_SCHEMA).option("header", True).option("nullValue", "N/A").csv(path)


def weather_rows(payloads: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of weather API payloads: every position of the parallel arrays of a payload becomes one
    row, once for the hourly and once for the daily block."""
    parsed = payloads.select(*keep, F.from_json(payload, WEATHER_PAYLOAD_SCHEMA).alias("p"))

    def block(kind: str, doubles: tuple[str, ...], texts: tuple[str, ...] = ()) -> DataFrame:
        names = ("time", *doubles, *texts)
        # A measure that a block lacks is NULL at all its times; without times it has no rows.
        values = [F.coalesce(F.col(f"p.{kind}.{n}"), F.array()).alias(n) for n in names]
        zipped = F.when(F.col(f"p.{kind}.time").isNotNull(), F.arrays_zip(*values))
        rows = parsed.select(*keep, F.inline(zipped).alias(*names))
        return rows.select(
            F.col("time").cast("timestamp_ntz").alias("date"), F.lit(kind).alias("type"), *doubles, *texts, *keep
        )

    hourly = block("hourly", HOURLY_MEASURES)
    daily = block("daily", DAILY_MEASURES, DAILY_TEXTS)
    return hourly.unionByName(daily, allowMissingColumns=True)


def unique_weather(weather: DataFrame, kind: str, at: F.Column, measures: tuple[str, ...]) -> DataFrame:
    """One row per time step ``at`` of a kind, from the newest month file that has it. Overlapping
    files repeat time steps, and each repeat would multiply the trips of that step."""
    rows = weather.filter((F.col("type") == kind) & at.isNotNull())
    newest = rows.groupBy(at.alias("at")).agg(F.max(F.struct("trip_month", *measures)).alias("w"))
    return newest.select("at", *[F.col(f"w.{m}").alias(m) for m in measures])


def repeated_weather(weather: DataFrame) -> DataFrame:
    """Time steps that occur more than once, with how often."""
    return weather.groupBy("type", "date").agg(F.count("*").alias("copies")).filter("copies > 1")
