"""Month bookkeeping of the ingest: ranges, bounds, gaps, retention, newest snapshot."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.config import KEEP_MONTHS, parse_month


def month_of(ts: Column) -> Column:
    # By way of the date: formatting a time stamp would go through the session zone.
    return F.date_format(F.to_date(ts), "yyyy-MM")


def month_list(bounds: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """Every month between two dates, both included; one input row gives one range."""
    # A range that ends before it begins has no months; sequence would refuse it.
    steps = (f"explode(CASE WHEN {first} <= {last} THEN "
             f"sequence(trunc({first}, 'MM'), trunc({last}, 'MM'), INTERVAL 1 MONTH) END) AS day")
    return bounds.selectExpr(steps).select(month_of(F.col("day")).alias("month"))


def months_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    lo, hi = parse_month(first), parse_month(last)
    return month_list(spark.range(1).select(F.lit(lo).alias("first"), F.lit(hi).alias("last")))


def month_bounds(months: DataFrame, month: str = "month") -> DataFrame:
    """First and last day of each month."""
    first = F.to_date(F.concat(F.col(month), F.lit("-01")))
    return months.select(month, first.alias("first_day"), F.last_day(first).alias("last_day"))


def missing_months(wanted: DataFrame, present: DataFrame) -> DataFrame:
    return wanted.join(present, "month", "left_anti")


def file_listing(spark: SparkSession, base: str) -> DataFrame:
    """Names and modification times of the parquet files below ``base``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    return files.load(base).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "modificationTime")


def retention_plan(
    listing: DataFrame, run_month: str, keep_months: int = KEEP_MONTHS, dataset: str = "yellow",
    file_name: str = "file_name",
) -> DataFrame:
    """Trip files older than the kept window.

    The window ends at the newer of the run's month and the newest month present, so a back-fill of
    an old month never marks newer files as stale. Nothing is deleted here.
    """
    parse_month(run_month)
    # File name pattern (fixed format).
    pattern = rf"{re.escape(dataset)}_tripdata_(\d{{4}}-\d{{2}})\.parquet$"
    months = listing.withColumn("month", F.regexp_extract(file_name, pattern, 1)).filter("month <> ''")
    newest = months.agg(F.greatest(F.max("month"), F.lit(run_month)).alias("m")).scalar()
    oldest_kept = F.add_months(F.to_date(F.concat(newest, F.lit("-01"))), 1 - keep_months)
    return months.filter(F.col("month") < month_of(oldest_kept))


def latest_snapshot(snapshots: DataFrame, stamp: str = "run_ts") -> DataFrame:
    """Rows of the newest run only."""
    newest = snapshots.agg(F.max(stamp)).scalar()
    return snapshots.filter(F.col(stamp) == newest)


def forecast_runs(spark: SparkSession, base: str) -> DataFrame:
    """(run, written): every forecast below ``base`` and when its last part was written. A run is the folder
    of its parts, ``<name>.csv``, or a single CSV file elsewhere. Lists files and reads none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(base)
    folder = F.regexp_extract("path", r"^(.*\.csv)/[^/]+$", 1)
    run = F.when(folder != "", folder).otherwise(F.col("path")).alias("run")
    return files.groupBy(run).agg(F.max("modificationTime").alias("written"))


def read_latest_forecast(spark: SparkSession, base: str, schema) -> DataFrame:
    """All rows of the newest forecast below ``base``, however many parts it has; older runs are not read.
    Of runs written at the same instant the one whose path sorts last. No run, no rows."""
    newest = forecast_runs(spark, base).orderBy(F.desc("written"), F.desc("run")).first()
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(newest["run"])
