"""Taking up new trip files: each run reads only files that no run has read, and replaces their months.

A file source with a checkpoint knows what was read. A batch is given to :func:`replace_months`, which writes each month that the
batch has a file of; a batch that comes twice, after a failure between the write and the checkpoint, writes the same again. A
run ends when nothing new is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.schemas import TRIP_SCHEMA

MONTH_IN_NAME = r"tripdata_(\d{4}-\d{2})\.parquet"


def delivered_month() -> F.Column:
    """The month that a file's name tells, also where a writer made a folder of it; empty for other names."""
    return F.regexp_extract(F.col("_metadata.file_path"), MONTH_IN_NAME, 1)


def replace_months(batch: DataFrame, path: str) -> None:
    """Replace the months whose files are in the batch. A delivery is its month, whatever its trips' dates: the months of a
    month-partitioned table are those of the files' names."""
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trip_month").parquet(path)


def ingest_new_files(spark: SparkSession, source: str, path: str, checkpoint: str, schema: T.StructType = TRIP_SCHEMA,
                     files_at_once: int = 12) -> int:
    """Read what is new below ``source`` into the month-partitioned table at ``path``; returns how many rows it was.

    A month that is delivered again, under another name or folder, replaces what is there. Both files of a month must not
    lie in one batch of ``files_at_once`` files unless they are parts of one delivery.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(f"{source}/*tripdata*.parquet")
    named = stream.select("*", delivered_month().alias("trip_month")).filter("trip_month <> ''")
    read = 0

    def take(batch: DataFrame, number: int) -> None:
        replace_months(batch, path)

    query = named.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    for progress in query.recentProgress:
        read += progress["numInputRows"] if isinstance(progress, dict) else progress.numInputRows
    return read
