import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from zoneflow.config import MonthWindow, StoreConfig
from zoneflow.operators import quality, store
from zoneflow.plans.month import Tables, build_month, feature_store
from zoneflow.schemas import TRIP_SCHEMA, WEATHER_SCHEMA
from zoneflow.session import work_dir
from zoneflow.sources import sinks

DECEMBER, JANUARY = MonthWindow("2023-12"), MonthWindow("2024-01")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(dt.datetime(2023, 12, 31, 23, 59), 1), (dt.datetime(2024, 1, 1), 2), (dt.datetime(2024, 1, 31, 23), 3),
         (dt.datetime(2024, 2, 1), 4)], "t timestamp_ntz, v int")


def test_upsert_replaces_only_its_month(spark, table):
    new = spark.createDataFrame([(30, dt.datetime(2024, 1, 5), "n"), (40, dt.datetime(2024, 2, 2), "n")],
                                "v int, t timestamp_ntz, extra string")
    once = sinks.upsert_month(table, new, "t", JANUARY)
    assert sorted((r.v, r.extra) for r in once.collect()) == [(1, None), (4, None), (30, "n")]
    assert rows(sinks.upsert_month(once, new, "t", JANUARY)) == rows(once)


def test_first_upsert_is_the_month_alone_and_extra_filter_applies(spark, table):
    assert sorted(r.v for r in sinks.upsert_month(None, table, "t", JANUARY).collect()) == [2, 3]
    assert [r.v for r in sinks.upsert_month(None, table, "t", JANUARY, F.col("v") > 2).collect()] == [3]


def test_stored_upsert_rewrites_one_partition(spark, table):
    path = work_dir(spark)
    sinks.write_month(table, path, "t")
    for _ in range(2):
        sinks.write_month(table.withColumn("v", F.col("v") * 10), path, "t", JANUARY)
    found = sinks.read_months(spark, path)
    assert sorted(r.v for r in found.collect()) == [1, 4, 20, 30]
    assert dict(found.dtypes)["trip_month"] == "string" and dict(found.dtypes)["t"] == "timestamp_ntz"


@pytest.mark.parametrize("nothing", [lambda df: df.filter("v > 100"), lambda df: df.limit(0), lambda df: df.filter("false")])
def test_a_month_without_rows_empties_its_partition(spark, table, nothing):
    path = work_dir(spark)
    sinks.write_month(table, path, "t")
    sinks.write_month(nothing(table), path, "t", JANUARY)
    assert sorted(r.v for r in sinks.read_months(spark, path).collect()) == [1, 4]


def test_reading_a_window_prunes_partitions(spark, table):
    path = work_dir(spark)
    sinks.write_month(table, path, "t")
    pruned = sinks.read_months(spark, path, JANUARY)
    assert sorted(r.v for r in pruned.collect()) == [1, 2, 3]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [trip_month" in plan


@pytest.fixture
def two_months(make_trips):
    """Dense trips: two zones, every hour of the last days of December and of early January."""
    rng = random.Random(7)
    first = dt.datetime(2023, 12, 24)
    return make_trips(*[
        {"at": first + dt.timedelta(hours=h, minutes=5 * i), "PULocationID": zone, "DOLocationID": 3 - zone,
         "minutes": rng.randint(5, 50), "fare_amount": rng.randint(8, 30) * 1.0, "tip_amount": rng.choice([0.0, 2.0])}
        for h in range(14 * 24) for zone in (1, 2) for i in range(rng.randint(1, 3))])


@pytest.fixture
def weather(spark):
    """A wet hour in each month; the other hours are unknown."""
    rows = [{"date": at, "type": "hourly", "precipitation": 0.4, "apparent_temperature": 3.0, "trip_month": at.strftime("%Y-%m")}
            for at in (dt.datetime(2023, 12, 28, 9), dt.datetime(2024, 1, 2, 9))]
    return spark.createDataFrame([tuple(r.get(c) for c in WEATHER_SCHEMA.names) for r in rows], WEATHER_SCHEMA)


def test_month_by_month_equals_the_full_run(spark, two_months, zones, weather):
    config = StoreConfig(min_trips=2)
    tables = Tables(work_dir(spark))
    for month in ("2023-12", "2024-01", "2023-12"):  # out of order and repeated
        build_month(spark, two_months, zones, weather, month, tables, config)
    built = sinks.read_months(spark, tables.store)
    both = feature_store(two_months, zones, weather, MonthWindow("2024-01", lookback_months=2), config)
    wanted = both.unionByName(feature_store(two_months, zones, weather, DECEMBER, config))
    columns = [c for c in wanted.columns]
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in wanted.dtypes]
    assert rows(built.select(*columns).select(*rounded)) == rows(wanted.select(*rounded))
    trips = sinks.read_months(spark, tables.trips)
    assert trips.groupBy("trip_month").count().count() == 2
    joined = sinks.read_months(spark, tables.enriched)
    assert joined.count() == two_months.count() and {"PUZone", "temperature_2m"} <= set(joined.columns)
    assert trips.select(*TRIP_SCHEMA.names).count() <= two_months.count()


def test_build_refuses_trips_without_required_columns(spark, make_trips, zones, no_weather):
    trips = make_trips({"at": dt.datetime(2024, 1, 1)}).drop("Airport_fee")
    with pytest.raises(quality.QualityError, match="has Airport_fee"):
        build_month(spark, trips, zones, no_weather, "2024-01", Tables(work_dir(spark)))


@pytest.mark.parametrize("change, group, rule", [
    ({"passenger_count": 11.0}, "ranges", "passenger_count"),
    ({"payment_type": 9}, "value_sets", "payment_type"),
])
def test_build_refuses_bad_trips_unless_the_group_is_left_out(spark, make_trips, zones, no_weather, change, group, rule):
    from zoneflow.plans.month import CHECKS, check_month

    trips = make_trips({"at": dt.datetime(2024, 1, 1, 3), **change})
    others = set(CHECKS) - {"schema", group}
    with pytest.raises(quality.QualityError, match=rule):
        check_month(trips, no_weather, JANUARY, {group})
    check_month(trips, no_weather, JANUARY, others)
    with pytest.raises(ValueError):
        check_month(trips, no_weather, JANUARY, {"colour"})


def test_build_refuses_many_copies_and_impossible_weather(spark, make_trips, zones):
    from zoneflow.plans.month import check_month

    trips = make_trips(*[{"at": dt.datetime(2024, 1, 1, 3)}] * 20)
    cold = spark.createDataFrame([{"date": dt.datetime(2024, 1, 1), "type": "hourly", "temperature_2m": -400.0}], WEATHER_SCHEMA)
    with pytest.raises(quality.QualityError, match="duplicates"):
        check_month(trips, cold, JANUARY, {"duplicates"})
    with pytest.raises(quality.QualityError, match="temperature_2m"):
        check_month(trips, cold, JANUARY, {"weather"})


def test_summary_and_preview(make_cells):
    from zoneflow.operators.hourly import store_features

    cells = store_features(make_cells([("B", 1, 4, 40.0), ("A", 1, 6, 60.0), ("A", 0, 5, 50.0)]))
    summary = store.store_summary(cells).first()
    assert (summary.rows, summary.zones, summary.avg_rph, summary.avg_trip_count) == (3, 2, 50.0, 5.0)
    preview = store.store_preview(cells, 2).collect()
    assert [(r.PUZone, r.ts_hour.hour) for r in preview] == [("A", 0), ("A", 1)] and len(preview[0]) == 15
    assert store.repeated_cells(cells).count() == 0
    assert store.repeated_cells(cells.unionByName(cells.limit(1))).count() == 1


# --- quality ------------------------------------------------------------------------------------

GOOD = {"at": dt.datetime(2024, 1, 1, 8)}


def failed(report):
    return sorted(r.rule for r in report.filter("NOT passed").collect())


def test_good_trips_pass_every_rule(make_trips):
    trips = make_trips(GOOD)
    reports = [quality.trip_rules(trips), quality.value_set_rules(trips), quality.trip_schema_rules(trips),
               quality.duplicate_check(trips)]
    assert [failed(r) for r in reports] == [[], [], [], []]
    quality.quality_gate(*reports)


@pytest.mark.parametrize("change,rule", [
    ({"passenger_count": 0.0}, "passenger_count > 0"), ({"passenger_count": 11.0}, "passenger_count <= 10"),
    ({"trip_distance": -0.1}, "trip_distance >= 0"), ({"trip_distance": 301.0}, "trip_distance <= 300"),
    ({"fare_amount": -1.0}, "fare_amount >= 0"), ({"extra": 5.5}, "extra <= 5"), ({"mta_tax": -0.5}, "mta_tax >= 0"),
    ({"tip_amount": -1.0}, "tip_amount >= 0"), ({"tolls_amount": -1.0}, "tolls_amount >= 0"),
    ({"total_amount": -1.0}, "total_amount >= 0"), ({"Airport_fee": -1.0}, "Airport_fee >= 0"),
    ({"PULocationID": 0}, "PULocationID > 0"), ({"DOLocationID": -3}, "DOLocationID > 0"),
])
def test_a_bad_trip_fails_its_rule_and_the_gate(make_trips, change, rule):
    report = quality.trip_rules(make_trips(GOOD, {**GOOD, **change}))
    assert failed(report) == [rule]
    assert report.filter(F.col("rule") == rule).first()[1:3] == (2, 1)
    with pytest.raises(quality.QualityError, match=rule.split()[0]):
        quality.quality_gate(report)


def test_null_breaks_value_sets_but_not_ranges(make_trips):
    trips = make_trips(GOOD, {**GOOD, "payment_type": None, "passenger_count": None, "RatecodeID": 6})
    assert failed(quality.trip_rules(trips)) == []
    assert failed(quality.value_set_rules(trips)) == ["RatecodeID in 1/2/3/4/5", "payment_type in 1/2/3/4"]


def test_schema_rules(spark, make_trips, no_weather):
    trips = make_trips(GOOD).withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("string")).drop("extra")
    assert failed(quality.trip_schema_rules(trips)) == ["has extra", "tpep_pickup_datetime is a timestamp"]
    assert failed(quality.weather_schema_rules(no_weather)) == ["not empty"]
    weather = spark.createDataFrame([(1.0,)], "temperature_2m double")
    assert failed(quality.weather_schema_rules(weather)) == ["has all hourly or all daily columns"]
    daily_only = no_weather.select("temperature_2m_max", "temperature_2m_min", "apparent_temperature_mean", "sunset",
                                   "sunrise", "precipitation_hours")
    assert failed(quality.weather_schema_rules(daily_only)) == ["not empty"]


def test_weather_rules_follow_the_column_names(spark):
    row = {"temperature_2m": 61.0, "apparent_temperature_mean": -61.0, "wind_speed_10m": -1.0,
           "precipitation_hours": -1.0, "relative_humidity_2m": 101.0}
    weather = spark.createDataFrame([tuple(row.get(c) for c in WEATHER_SCHEMA.names)], WEATHER_SCHEMA)
    assert failed(quality.weather_rules(weather)) == sorted([
        "temperature_2m <= 60", "apparent_temperature_mean >= -60", "wind_speed_10m >= 0", "precipitation_hours >= 0",
        "relative_humidity_2m <= 100"])


@pytest.mark.parametrize("copies,passed", [(11, True), (12, False)])
def test_ten_duplicates_are_always_allowed(spark, copies, passed):
    df = spark.createDataFrame([(1, None)] * copies + [(i, "x") for i in range(2, 20)], "a int, b string")
    row = quality.duplicate_check(df).first()
    assert (row.checked_rows, row.violations, row.passed) == (copies + 18, copies - 1, passed)


def test_one_percent_duplicates_are_allowed(spark):
    df = spark.range(2000).unionAll(spark.range(20))
    assert quality.duplicate_check(df).first().passed
    assert not quality.duplicate_check(df.unionAll(spark.range(3))).first().passed
    assert quality.duplicate_check(df.limit(0)).first()[1:] == (0, 0, True)
