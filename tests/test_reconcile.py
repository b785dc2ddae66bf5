"""Files whose schemas changed, and payloads that are refused."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.schemas import TRIP_SCHEMA
from zoneflow.session import work_dir
from zoneflow.sources import files, payloads, reconcile


def write(spark, base, month, sql):
    spark.sql(f"SELECT {sql}").coalesce(1).write.parquet(files.trip_path(base, month))


SMALL = T.StructType([T.StructField("A", T.LongType()), T.StructField("b", T.DoubleType()), T.StructField("at", T.TimestampNTZType())])


def test_types_and_spellings_by_month(spark):
    base = work_dir(spark)
    write(spark, base, "2024-01", "1L AS A, 1.5D AS b, TIMESTAMP_NTZ '2024-01-01 10:00:00' AS at")
    write(spark, base, "2024-02", "CAST(2 AS INT) AS a, CAST(3 AS BIGINT) AS B, '2024-02-01 10:00:00' AS At")
    write(spark, base, "2024-03", "3.0D AS A, 'x' AS b, DATE '2024-03-01' AS at")
    write(spark, base, "2024-04", "4.5D AS A, ' 2.25' AS b, 'no time' AS at, 7 AS more")
    write(spark, base, "2024-05", "'5' AS A, 1.25BD AS b")
    write(spark, base, "2024-06", "'5.5' AS A, CAST('NaN' AS DOUBLE) AS b, TIMESTAMP_NTZ '2024-06-01 00:00:00' AS at")
    rows = {r.A if r.A is not None else str(r.at or r.b): r for r in reconcile.scan_trips_reconciled(spark, base, SMALL).collect()}
    assert [(rows[k].A, rows[k].b) for k in (1, 2, 3)] == [(1, 1.5), (2, 3.0), (3, None)]
    assert rows[2].at == dt.datetime(2024, 2, 1, 10) and rows[3].at == dt.datetime(2024, 3, 1)
    assert rows["2.25"].A is None and rows[5].b == 1.25 and rows[5].at is None
    assert str(rows["2024-06-01 00:00:00"].b) == "nan"
    assert reconcile.scan_trips_reconciled(spark, base, SMALL).schema == SMALL
    wide = reconcile.scan_trips_reconciled(spark, base, SMALL, keep_others=True)
    assert wide.columns == ["A", "b", "at", "more"] and wide.agg(F.sum("more")).first()[0] == 7


def test_zoned_times_keep_their_utc_time_in_any_session_zone(spark):
    base = work_dir(spark)
    write(spark, base, "2024-01", "1L AS A, 1.0D AS b, TIMESTAMP '2024-03-31 02:30:00.123456Z' AS at")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert reconcile.scan_trips_reconciled(spark, base, SMALL).first().at == dt.datetime(2024, 3, 31, 2, 30, 0, 123456)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_one_scan_a_schema_with_pruning_and_pushdown(spark, capsys):
    base = work_dir(spark)
    for month in ("2024-01", "2024-02", "2024-03"):
        write(spark, base, month, "1L AS A, 1.5D AS b")
    write(spark, base, "2024-04", "1L AS A, 2L AS b, 'x' AS c")
    assert [len(g.paths) for g in reconcile.file_groups(spark, base, "*tripdata*.parquet")] == [3, 1]
    reconcile.scan_trips_reconciled(spark, base, SMALL).filter("A > 1").select("A").explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 2 and plan.count("ReadSchema: struct<A:bigint>") == 2 and plan.count("GreaterThan(A,1)") == 2


def test_without_schema_columns_get_a_common_type(spark):
    base = work_dir(spark)
    write(spark, base, "2024-01", "CAST(1 AS INT) AS A, 1.5D AS b, 'x' AS c, DATE '2024-01-01' AS d")
    write(spark, base, "2024-02", "2L AS a, 2L AS b, 3 AS c, TIMESTAMP_NTZ '2024-01-02 01:00:00' AS d, true AS e")
    found = reconcile.scan_trips_reconciled(spark, base, None)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("A", "bigint"), ("b", "double"), ("c", "string"), ("d", "timestamp_ntz"), ("e", "boolean")]
    assert {(r.A, r.b, r.c, r.e) for r in found.collect()} == {(1, 1.5, "x", None), (2, 2.0, "3", True)}


def test_no_files_empty_files_and_drift_rows(spark):
    base = work_dir(spark)
    with pytest.raises(files.NoInputError):
        reconcile.scan_trips_reconciled(spark, base)
    spark.createDataFrame([], TRIP_SCHEMA).write.parquet(files.trip_path(base, "2024-01"))
    assert reconcile.scan_trips_reconciled(spark, base).count() == 0
    assert reconcile.schema_drift(spark, base).count() == 0
    write(spark, base, "2024-02", "1 AS vendorid, 2 AS other")
    drift = {r.column or r.found_name: r for r in reconcile.schema_drift(spark, base).collect()}
    assert drift["VendorID"].change == "renamed and retyped" and drift["other"].change == "added"
    assert drift["fare_amount"].change == "missing" and drift["VendorID"].file == "yellow_tripdata_2024-02.parquet"
    assert reconcile.scan_trips_reconciled(spark, base).first().VendorID == 1


def payload(**blocks):
    return json.dumps(blocks)


GOOD = payload(hourly={"time": ["2024-01-01T00:00"], "temperature_2m": [1.0], "precipitation": [None]}, daily={"time": [], "sunset": []})


@pytest.mark.parametrize("text, reason", [
    (GOOD, None),
    (payload(hourly={"time": ["2024-01-01T00:00", None]}), "hourly.time cannot be read"),
    (payload(daily={"time": ["2024-01-01"], "sunset": ["x"]}), None),
    (None, "no payload"), ("", "not readable as JSON"), ("{", "not readable as JSON"), ("[1]", "not readable as JSON"),
    ('{"hourly": {"time": "x"}}', "not readable as JSON"),
    ("{}", "no time axis"), (payload(hourly={"temperature_2m": [1.0]}), "no time axis"),
    (payload(hourly={"temperature_2m": [1.0]}, daily={"time": ["2024-01-01"]}), "hourly.temperature_2m without times"),
    (payload(hourly={"time": ["2024-01-01T00:00"], "precipitation": []}), "hourly.precipitation is not as long as its times"),
    (payload(daily={"time": ["2024-01-01"], "sunset": ["a", "b"]}), "daily.sunset is not as long as its times"),
    (payload(hourly={"time": ["soon"]}), "hourly.time cannot be read"),
    (payload(hourly={"time": ["2024-01-01T00:00"], "temperature_2m": ["warm"]}), "not readable as JSON"),
])
def test_reasons_of_refusal(spark, text, reason):
    frame = spark.createDataFrame([(text, 1)], "payload string, n int")
    row = payloads.judged_payloads(frame).first()
    assert row.reason == reason
    assert payloads.accepted_rows(frame).count() == (0 if reason else 1)
    assert payloads.refused_payloads(frame).count() == (1 if reason else 0)


def test_ingest_replaces_its_own_refusals_and_keeps_other_runs(spark):
    base = work_dir(spark)
    bad = spark.createDataFrame([("{", 1), (GOOD, 2)], "payload string, n int")
    rows, refused = f"{base}/rows", f"{base}/refused"
    assert [r.n for r in payloads.ingest_payloads(bad, rows, refused, "a").collect()] == [1]
    assert payloads.ingest_payloads(bad, rows, refused, "b").count() == 1
    assert payloads.ingest_payloads(bad.filter("n = 2"), rows, refused, "a").count() == 0
    assert [r.run_id for r in spark.read.parquet(refused).collect()] == ["b"]
    assert spark.read.parquet(rows).count() == 1
