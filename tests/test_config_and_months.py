import datetime as dt

import pytest

from zoneflow.config import MonthWindow, SCORE_WEIGHTS, StoreConfig, add_months, parse_month, resolve_month
from zoneflow.schemas import TRIP_SCHEMA, WEATHER_SCHEMA
from zoneflow.session import work_dir
from zoneflow.sources import files, months


def values(df, column):
    return sorted(r[column] for r in df.collect())


@pytest.mark.parametrize("bad", ["2024-13", "2024-1", "24-01", "2024-00", "", "2024-01-01", "January"])
def test_bad_month_is_an_error(bad):
    with pytest.raises(ValueError):
        parse_month(bad)


def test_month_is_the_requested_one_or_the_one_before_today():
    assert resolve_month("2024-02", dt.date(2025, 1, 5)) == "2024-02"
    assert resolve_month(None, dt.date(2025, 1, 5)) == "2024-12"
    assert resolve_month(" YYYY-MM ", dt.date(2024, 3, 31)) == "2024-02"
    with pytest.raises(ValueError):
        resolve_month("02/2024", dt.date(2025, 1, 5))


def test_window_covers_month_and_lookback():
    window = MonthWindow("2024-01", lookback_months=2)
    assert (window.buffer_start, window.start, window.end) == (dt.date(2023, 11, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    assert window.months == ["2023-11", "2023-12", "2024-01"]
    assert window.hours == (30 + 31 + 31) * 24
    assert add_months(dt.date(2024, 1, 1), -13) == dt.date(2022, 12, 1)


def test_weights_sum_to_one_and_lag_mode_is_checked():
    assert abs(sum(SCORE_WEIGHTS.values()) - 1.0) < 1e-12
    with pytest.raises(ValueError):
        StoreConfig(lag_mode="days")


def test_month_list_includes_both_ends(spark):
    assert values(months.months_between(spark, "2023-11", "2024-02"), "month") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert months.months_between(spark, "2024-03", "2024-02").count() == 0


def test_month_bounds_know_leap_years(spark):
    row = months.month_bounds(months.months_between(spark, "2024-02", "2024-02")).first()
    assert (row.first_day, row.last_day) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


def test_missing_months(spark):
    present = spark.createDataFrame([("2024-01",)], "month string")
    assert values(months.missing_months(months.months_between(spark, "2023-12", "2024-02"), present), "month") == [
        "2023-12", "2024-02"]


def listing(spark, names):
    return spark.createDataFrame([(n,) for n in names], "file_name string")


def test_retention_keeps_twelve_months_and_ignores_other_files(spark):
    names = [f"yellow_tripdata_2023-{m:02d}.parquet" for m in range(1, 13)] + [
        "yellow_tripdata_2022-12.parquet", "green_tripdata_2020-01.parquet", "weather_2020-01.parquet"]
    assert values(months.retention_plan(listing(spark, names), "2023-12"), "file_name") == ["yellow_tripdata_2022-12.parquet"]


def test_retention_of_a_backfill_run_is_anchored_at_the_newest_file(spark):
    names = ["yellow_tripdata_2024-06.parquet", "yellow_tripdata_2023-07.parquet", "yellow_tripdata_2023-06.parquet"]
    assert values(months.retention_plan(listing(spark, names), "2020-01"), "month") == ["2023-06"]
    assert values(months.retention_plan(listing(spark, names), "2025-07"), "month") == ["2023-06", "2023-07", "2024-06"]


def test_retention_of_nothing_is_nothing(spark):
    assert months.retention_plan(listing(spark, []), "2024-01").count() == 0


def test_scans_fail_without_files(spark):
    with pytest.raises(files.NoInputError):
        files.scan_trips(spark, work_dir(spark))


def test_trip_scan_reads_every_month_and_only_trip_files(spark, make_trips, no_weather):
    base = work_dir(spark)
    for month in (1, 2):
        make_trips({"at": dt.datetime(2024, month, 3)}).write.parquet(files.trip_path(base, f"2024-{month:02d}"))
    no_weather.write.parquet(files.weather_path(base, "2024-01"))
    trips = files.scan_trips(spark, base)
    assert values(trips, "tpep_pickup_datetime") == [dt.datetime(2024, 1, 3), dt.datetime(2024, 2, 3)]
    assert trips.columns == TRIP_SCHEMA.names
    assert files.scan_trips(spark, base, schema=None).count() == 2


def test_legacy_weather_is_only_a_fallback(spark):
    def hour(n):
        row = {"date": dt.datetime(2024, 1, 1, n), "type": "hourly", "trip_month": "2024-01"}
        return spark.createDataFrame([tuple(row.get(c) for c in WEATHER_SCHEMA.names)], WEATHER_SCHEMA)

    base = work_dir(spark)
    hour(1).write.parquet(f"{base}/weather.parquet")
    assert values(files.scan_weather(spark, base), "date") == [dt.datetime(2024, 1, 1, 1)]
    hour(2).write.parquet(files.weather_path(base, "2024-01"))
    assert values(files.scan_weather(spark, base), "date") == [dt.datetime(2024, 1, 1, 2)]


def test_lookup_text_na_is_null(spark):
    path = work_dir(spark)
    spark.createDataFrame([("LocationID,Borough,Zone",), ("1,Queens,N/A",), ('2,"Man, hattan",Midtown',)], "value string") \
        .coalesce(1).write.text(path)
    rows = {r.LocationID: (r.Borough, r.Zone) for r in files.scan_zones(spark, path).collect()}
    assert rows == {1: ("Queens", None), 2: ("Man, hattan", "Midtown")}


def test_payload_becomes_hourly_and_daily_rows(spark):
    payload = ('{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, null], '
               '"precipitation": [0, 0.2], "apparent_temperature": [0.5, 1], "wind_speed_100m": [9, 8], '
               '"wind_speed_10m": [5, 4], "relative_humidity_2m": [80, 81]}, '
               '"daily": {"time": ["2024-01-01"], "temperature_2m_max": [3], "temperature_2m_min": [-2], '
               '"apparent_temperature_mean": [0.1], "sunset": ["2024-01-01T16:38"], "sunrise": ["2024-01-01T07:20"], '
               '"precipitation_hours": [1]}}')
    rows = files.weather_rows(spark.createDataFrame([(payload,)], "payload string")).orderBy("type", "date").collect()
    assert [(r.type, r.date, r.temperature_2m, r.precipitation) for r in rows] == [
        ("daily", dt.datetime(2024, 1, 1), None, None),
        ("hourly", dt.datetime(2024, 1, 1, 0), 1.5, 0.0),
        ("hourly", dt.datetime(2024, 1, 1, 1), None, 0.2)]
    assert (rows[0].sunset, rows[0].precipitation_hours) == ("2024-01-01T16:38", 1.0)


def test_latest_snapshot_is_the_newest_run(spark):
    runs = spark.createDataFrame([(1, 10), (2, 20), (3, 20)], "id int, run_ts int")
    assert values(months.latest_snapshot(runs), "id") == [2, 3]


def test_latest_forecast_is_read_whole_and_alone(spark):
    import os

    from zoneflow.operators.ranking import forecast_output
    from zoneflow.schemas import FORECAST_SCHEMA
    from zoneflow.sources.sinks import write_forecast

    base = work_dir(spark)
    for name, zone, age in (("old", "A", 100), ("new", "B", 0)):
        rows = spark.createDataFrame(
            [(dt.datetime(2024, 1, 1, h), zone, "X", 1, *[0.5] * 9) for h in range(24)], FORECAST_SCHEMA)
        write_forecast(forecast_output(rows).repartition(8), spark.range(1), base, name)
        for i, entry in enumerate(os.scandir(f"{base}/{name}.csv")):
            stamp = entry.stat().st_mtime - age - i  # parts of one run end at different times
            os.utime(entry.path, (stamp, stamp))
    assert values(months.read_latest_forecast(spark, base, FORECAST_SCHEMA), "PUZone") == ["B"] * 24
    assert values(months.read_latest_forecast(spark, f"{base}/*.csv", FORECAST_SCHEMA), "PUZone") == ["B"] * 24
    assert {r.file_name.split(".")[-1] for r in months.file_listing(spark, base).collect()} <= {"parquet"}


def test_no_forecast_written_reads_as_no_rows(spark, tmp_path):
    from zoneflow.schemas import FORECAST_SCHEMA

    assert months.read_latest_forecast(spark, str(tmp_path), FORECAST_SCHEMA).count() == 0
