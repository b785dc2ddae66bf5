"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "zoneflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """A new path below the folder all executors share (``spark.checkpoint.dir``).

    Only a local session without that setting gets a folder of its own; on a cluster a missing
    setting is an error, since a machine-local folder would be invisible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="zoneflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/zoneflow-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives executor loss, and gives later
    scans column pruning and filter pushdown. For inputs that several passes read.

    Without a path of the caller's the table belongs to the driver, which deletes it when it ends."""
    owned = path is None
    path = path or work_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    if owned:
        _delete_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete_at_end(spark: SparkSession, path: str) -> None:
    """Leave the path to the driver's file system, which deletes what it was left when it closes."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a work table that nothing reads any more, such as one that a loop has replaced."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
