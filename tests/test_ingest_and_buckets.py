"""Taking up new files, and the store as a bucketed table."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from zoneflow.operators.forecast import history_rolling
from zoneflow.plans.ingest import ingest_new_files
from zoneflow.session import work_dir
from zoneflow.sources import files, sinks


def deliver(make_trips, base, month, fares, day=5):
    year, number = map(int, month.split("-"))
    rows = [{"at": dt.datetime(year, number, day), "fare_amount": f} for f in fares]
    make_trips(*rows).coalesce(1).write.parquet(files.trip_path(base, month))


def fares(spark, path):
    return sorted((r.trip_month, r.fare_amount) for r in sinks.read_months(spark, path).collect())


def test_only_new_files_are_read_and_their_months_replaced(spark, make_trips):
    base = work_dir(spark)
    table, seen = f"{base}/table", f"{base}/seen"
    deliver(make_trips, f"{base}/in/1", "2024-01", [10.0, 11.0])
    deliver(make_trips, f"{base}/in/1", "2024-02", [20.0])
    assert ingest_new_files(spark, f"{base}/in/*", table, seen) == 3
    assert fares(spark, table) == [("2024-01", 10.0), ("2024-01", 11.0), ("2024-02", 20.0)]
    assert ingest_new_files(spark, f"{base}/in/*", table, seen) == 0
    deliver(make_trips, f"{base}/in/2", "2024-01", [12.0])
    deliver(make_trips, f"{base}/in/2", "2024-03", [30.0, 31.0])
    make_trips({"at": dt.datetime(2024, 4, 1)}).write.parquet(f"{base}/in/2/other.parquet")
    assert ingest_new_files(spark, f"{base}/in/*", table, seen) == 3
    assert fares(spark, table) == [("2024-01", 12.0), ("2024-02", 20.0), ("2024-03", 30.0), ("2024-03", 31.0)]


def test_a_delivery_is_its_month_and_a_run_without_checkpoint_writes_the_same(spark, make_trips):
    base = work_dir(spark)
    deliver(make_trips, f"{base}/in", "2024-01", [10.0])
    make_trips({"at": dt.datetime(2008, 12, 31, 23), "fare_amount": 1.0}).write.parquet(files.trip_path(f"{base}/in", "2024-02"))
    for seen in ("a", "b"):  # as after a failure before the checkpoint
        ingest_new_files(spark, f"{base}/in", f"{base}/table", f"{base}/{seen}", files_at_once=1)
        assert fares(spark, f"{base}/table") == [("2024-01", 10.0), ("2024-02", 1.0)]


def test_windows_and_groups_of_a_bucketed_store_plan_no_exchange(spark, make_cells, capsys):
    cells = make_cells([(z, h, h % 7 + 1, float(h)) for z in "ABCDE" for h in range(60)] + [(None, 1, 2, 3.0)])
    path = work_dir(spark)
    stored = sinks.write_bucketed(cells, f"cells_{uuid.uuid4().hex}", path, buckets=4)
    rolled = history_rolling(stored)
    rolled.explain()
    grouped = stored.groupBy("PUZone").agg(F.avg("trip_count").alias("mean"))
    joined = stored.join(grouped.hint("merge"), "PUZone")
    joined.explain()
    plans = capsys.readouterr().out
    assert "Exchange" not in plans and "Bucketed: true" in plans
    assert sorted(map(repr, rolled.collect())) == sorted(map(repr, history_rolling(cells).select(*rolled.columns).collect()))
    assert joined.count() == 300
    names = [p.name for p in __import__("pathlib").Path(path.removeprefix("file:")).glob("part-*")]
    assert len(names) <= 4
