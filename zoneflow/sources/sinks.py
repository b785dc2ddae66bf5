"""Writers: month-partitioned tables and forecast output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.config import MonthWindow
from zoneflow.functions.calendar import ntz
from zoneflow.sources.months import month_of


def in_month(ts: str, window: MonthWindow):
    return (F.col(ts) >= ntz(window.start)) & (F.col(ts) < ntz(window.end))


def in_window(ts: str, window: MonthWindow):
    """The target month and its lookback."""
    return (F.col(ts) >= ntz(window.buffer_start)) & (F.col(ts) < ntz(window.end))


def upsert_month(existing: DataFrame | None, new: DataFrame, ts: str, window: MonthWindow, extra=None) -> DataFrame:
    """Rows of ``existing`` with the target month replaced by the new rows; columns match by name.
    Without an existing table the month stands alone. The pure form of :func:`write_month`."""
    fresh = new.filter(in_month(ts, window))
    if extra is not None:
        fresh = fresh.filter(extra)
    if existing is None:
        return fresh
    # A row without a time stamp is in no month, and a filter on NULL drops it, as NOT NULL does.
    return existing.filter(~in_month(ts, window)).unionByName(fresh, allowMissingColumns=True)


def write_month(df: DataFrame, path: str, ts: str, window: MonthWindow | None = None,
                order: tuple[str, ...] = ()) -> None:
    """Write into the month partitions of ``path``, replacing only the months written.

    With a window its month is replaced whatever the rows are: without any the month is empty afterwards. Cost is
    one month, whatever the table holds. Files keep the row order given, per task: a total order would need a
    range shuffle of the month for no reader's benefit.
    """
    if window:
        rows = df.filter(in_month(ts, window)).drop("trip_month")
        if order:
            rows = rows.sortWithinPartitions(*order)
        # The month's own folder: a plain overwrite replaces it with or without rows.
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/trip_month={window.month}")
        return
    rows = df.withColumn("trip_month", month_of(F.col(ts)))
    if order:
        rows = rows.sortWithinPartitions("trip_month", *order)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trip_month").parquet(path)


def read_months(spark, path: str, window: MonthWindow | None = None, schema=None) -> DataFrame:
    """Read a month-partitioned table; a window prunes the partitions of other months."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    table = reader.parquet(path).withColumn("trip_month", F.col("trip_month").cast("string"))
    if window is None:
        return table
    return table.filter(F.col("trip_month").isin(window.months))


def write_forecast(output: DataFrame, metadata: DataFrame, path: str, name: str) -> None:
    """Forecast rows as CSV and the run's facts as JSON beside it. The ranked output is bounded by
    zones x horizon hours, and the CSV parts stay as Spark partitions them; ``months.read_latest_forecast``
    reads all parts of the newest run."""
    output.write.mode("errorifexists").option("header", True).csv(f"{path}/{name}.csv")
    metadata.write.mode("errorifexists").json(f"{path}/{name}.meta.json")


def write_refused(rows: DataFrame, path: str, run_id: str) -> None:
    """Add a run's refused rows to a table partitioned by run; writing a run again replaces it, also by nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/run_id={run_id}")


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: tuple[str, ...] = ("PUZone",),
                   order: tuple[str, ...] = ("PUZone", "ts_hour")) -> DataFrame:
    """Write a catalog table bucketed by ``keys`` and sorted by ``order`` in each bucket, and read it.

    Windows, groups and joins on these keys then plan no shuffle, however often the table is read: the one shuffle is here, and
    leaves one file a bucket. Meant for the hourly store, where a zone has a row per hour; trips are partitioned by month.
    """
    rows = df.repartition(buckets, *keys).sortWithinPartitions(*order)
    rows.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*order).saveAsTable(name)
    return df.sparkSession.table(name)
