"""Reports on the hourly store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.config import PREVIEW_COLUMNS


def store_summary(store: DataFrame) -> DataFrame:
    return store.agg(
        F.count("*").alias("rows"),
        F.count_distinct("PUZone").alias("zones"),
        F.min("ts_hour").alias("min_ts"),
        F.max("ts_hour").alias("max_ts"),
        F.avg("target_rph").alias("avg_rph"),
        F.avg("trip_count").alias("avg_trip_count"),
    )


def store_preview(store: DataFrame, rows: int = 20) -> DataFrame:
    """First rows by hour, then zone and borough. A top-k, so no full sort takes place."""
    order = [F.col(c).asc_nulls_last() for c in ("ts_hour", "PUZone", "PUBorough")]
    return store.select(*PREVIEW_COLUMNS, "PUBorough").orderBy(*order).limit(rows).drop("PUBorough")


def repeated_cells(store: DataFrame) -> DataFrame:
    """(zone, hour) pairs with more than one row. The time-shift join needs them to be unique; a zone
    name shared by two boroughs breaks that."""
    return store.groupBy("PUZone", "ts_hour").agg(F.count("*").alias("copies")).filter("copies > 1")
