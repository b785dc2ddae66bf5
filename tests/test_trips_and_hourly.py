import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from zoneflow.config import MonthWindow, StoreConfig
from zoneflow.functions.calendar import hour_floor, microseconds_sql, with_calendar
from zoneflow.operators import hourly
from zoneflow.operators.enrich import enrich_trips
from zoneflow.operators.trips import trip_features, trip_quality_filter
from zoneflow.schemas import WEATHER_SCHEMA
from zoneflow.sources.files import repeated_weather

NOON = dt.datetime(2024, 1, 6, 12, 30)  # a Saturday
JANUARY = MonthWindow("2024-01")


def weather_rows(spark, *rows):
    return spark.createDataFrame([tuple(r.get(c) for c in WEATHER_SCHEMA.names) for r in rows], WEATHER_SCHEMA)


def features(trips, zones, weather, window=JANUARY):
    return trip_features(enrich_trips(trips, zones, weather, window))


def test_unknown_zone_and_weather_keep_the_trip(make_trips, zones, no_weather):
    row = features(make_trips({"at": NOON, "PULocationID": 99, "DOLocationID": 2}), zones, no_weather).first()
    assert (row.PUZone, row.PUBorough, row.DOZone, row.precipitation) == (None, None, "Midtown", None)
    assert (row.is_raining, row.is_cold, row.is_hot, row.is_airport_pickup) == (0, 0, 0, 0)


def test_repeated_weather_hours_do_not_multiply_trips(spark, make_trips, zones):
    hour = {"date": NOON.replace(minute=0), "type": "hourly", "precipitation": 0.5, "trip_month": "2024-01"}
    day = {"date": dt.datetime(2024, 1, 6), "type": "daily", "precipitation_hours": 3.0, "trip_month": "2024-01"}
    newer = {**hour, "precipitation": 0.7, "trip_month": "2024-02"}
    weather = weather_rows(spark, hour, newer, day, day)
    rows = features(make_trips({"at": NOON}), zones, weather).collect()
    assert [(r.precipitation, r.precipitation_hours, r.is_raining) for r in rows] == [(0.7, 3.0, 1)]
    assert repeated_weather(weather).count() == 2


def test_windowed_weather_is_broadcast_and_unbounded_weather_is_left_to_spark(make_trips, zones, no_weather):
    def plan(df):
        return df._jdf.queryExecution().analyzed().toString()

    trips = make_trips({"at": NOON})
    assert "strategy=broadcast" in plan(enrich_trips(trips, zones, no_weather, JANUARY))
    assert "strategy=broadcast" not in plan(enrich_trips(trips, zones, no_weather))


def test_calendar_and_flags(make_trips, zones, no_weather):
    row = features(make_trips({"at": NOON}), zones, no_weather).first()
    assert (row.hour, row.day_of_week, row.is_weekend, row.week_of_year, row.day_of_year) == (12, 6, 1, 1, 6)
    assert (row.is_rush, row.is_night, row.is_airport_pickup) == (0, 0, 1)
    assert row.hour_sin == pytest.approx(math.sin(math.pi)) and row.dow_cos == pytest.approx(math.cos(2 * math.pi * 6 / 7))


@pytest.mark.parametrize("hour,am,pm,night", [(5, 0, 0, 1), (6, 0, 0, 0), (7, 1, 0, 0), (9, 1, 0, 0), (10, 0, 0, 0),
                                              (17, 0, 1, 0), (19, 0, 1, 0), (20, 0, 0, 0), (21, 0, 0, 0), (22, 0, 0, 1)])
def test_rush_and_night_edges(make_trips, zones, no_weather, hour, am, pm, night):
    row = features(make_trips({"at": NOON.replace(hour=hour)}), zones, no_weather).first()
    assert (row.is_am_rush, row.is_pm_rush, row.is_rush, row.is_night) == (am, pm, am + pm, night)


def test_sunday_is_zero_in_training_and_six_ahead(spark):
    sunday = spark.createDataFrame([(dt.datetime(2024, 1, 7),)], "ts_hour timestamp_ntz")
    assert with_calendar(sunday).first().day_of_week == 0
    assert with_calendar(sunday, monday_first=True).first().day_of_week == 6


def test_hours_do_not_move_with_the_session_zone(spark):
    spring = dt.datetime(2024, 3, 10, 2, 30)  # does not exist in New York wall-clock time
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.createDataFrame([(spring, dt.datetime(2024, 3, 10, 4, 30, 0, 250000))], "t timestamp_ntz, u timestamp_ntz")
        row = frame.select(hour_floor("t"), F.expr(microseconds_sql("t", "u")), F.expr(microseconds_sql("u", "t"))).first()
        assert tuple(row) == (dt.datetime(2024, 3, 10, 2), 7_200_250_000, -7_200_250_000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("change,kept", [
    ({"minutes": 2}, True), ({"minutes": 1.99}, False), ({"minutes": 180, "fare_amount": 60.0}, True),
    ({"minutes": 181, "fare_amount": 60.0}, False), ({"trip_distance": 0.1}, True), ({"trip_distance": 0.09}, False),
    ({"trip_distance": 100.0}, True), ({"trip_distance": None}, False), ({"fare_amount": 2.99}, False),
    ({"fare_amount": 500.0, "minutes": 60}, True), ({"fare_amount": 501.0, "minutes": 60}, False),
    ({"fare_amount": 10.0, "minutes": 1}, False), ({"Airport_fee": None}, False), ({"fare_amount": -20.0}, False),
])
def test_quality_filter_edges(make_trips, zones, no_weather, change, kept):
    usual = {"at": NOON, "fare_amount": 10.0}
    found = trip_quality_filter(features(make_trips({**usual, **change}), zones, no_weather)).count()
    assert found == int(kept)


def test_trips_outside_the_window_are_not_read(make_trips, zones, no_weather):
    trips = make_trips(*[{"at": at} for at in (
        dt.datetime(2023, 11, 30, 23, 59), dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 31, 23), dt.datetime(2024, 2, 1))])
    assert enrich_trips(trips, zones, no_weather, JANUARY).count() == 2


def test_cells_and_flow(make_trips, zones, no_weather):
    at = NOON.replace(minute=5)
    trips = make_trips(
        {"at": at, "fare_amount": 10.0, "tip_amount": 2.0, "minutes": 10, "DOLocationID": 2},
        {"at": at, "fare_amount": 20.0, "minutes": 30, "DOLocationID": 2},
        {"at": at, "fare_amount": 30.0, "minutes": 60, "DOLocationID": 1},
        {"at": at + dt.timedelta(minutes=50), "minutes": 30, "PULocationID": 2, "DOLocationID": 1},
        {"at": at, "PULocationID": 99, "DOLocationID": 99, "fare_amount": 12.0})
    kept = trip_quality_filter(features(trips, zones, no_weather))
    cells = {r.PUZone: r for r in hourly.flow_cells(kept).collect()}
    jfk = cells["JFK Airport"]
    assert (jfk.trip_count, jfk.target_rph, jfk.median_rph) == (3, pytest.approx((72 + 40 + 30) / 3), pytest.approx(40))
    assert jfk.p75_rph == pytest.approx(56) and jfk.tip_rate == pytest.approx(1 / 3)
    assert jfk.frac_airport_dropoff == pytest.approx(1 / 3)
    # The trip that starts in the hour ends in it for the flow, whenever it arrives.
    assert (jfk.dropoff_count, jfk.net_pickup_flow, jfk.pickup_dropoff_ratio) == (2, 1, pytest.approx(1.5))
    assert (cells["Midtown"].dropoff_count, cells["Midtown"].net_pickup_flow) == (2, -1)
    # A zone nobody knows is one cell, and nothing arrives there.
    assert (cells[None].trip_count, cells[None].dropoff_count, cells[None].pickup_dropoff_ratio) == (1, 0, None)


def test_trip_counts_add_up_to_the_kept_trips(spark, sf_dir):
    from zoneflow.queries import _kept

    kept = _kept(spark, sf_dir)
    cells = hourly.flow_cells(kept)
    assert cells.agg(F.sum("trip_count")).first()[0] == kept.count()


def test_lags_step_over_rows_or_over_hours(make_cells):
    cells = make_cells([("A", 0, 10, 50.0), ("A", 1, 11, 51.0), ("A", 3, 13, 53.0)])
    by_row = {r.ts_hour.hour: r for r in hourly.store_features(cells).collect()}
    assert (by_row[3].lag_1h_trip_count, by_row[3].lag_2h_trip_count) == (11, 10)
    by_clock = {r.ts_hour.hour: r for r in hourly.store_features(cells, StoreConfig(lag_mode="time")).collect()}
    assert sorted(by_clock) == [0, 1, 3]
    assert (by_clock[3].lag_1h_trip_count, by_clock[3].lag_2h_trip_count) == (None, 11)


def test_clock_lags_serve_the_unknown_zone_too(make_cells):
    cells = make_cells([(None, 0, 4, 50.0), (None, 2, 6, 52.0), ("A", 1, 3, 40.0)])
    found = {(r.PUZone, r.ts_hour.hour): r.lag_2h_trip_count
             for r in hourly.store_features(cells, StoreConfig(lag_mode="time")).collect()}
    assert found == {(None, 0): None, (None, 2): 4, ("A", 1): None}


def test_rolling_values_exclude_the_current_hour(make_cells):
    rph = [40.0 + (7 * h) % 30 for h in range(200)]
    cells = make_cells([("A", h, h + 1, rph[h]) for h in range(200)])
    rows = hourly.store_features(cells).orderBy("ts_hour").collect()
    assert rows[0].rolling_24h_trip_mean is None and rows[1].rolling_24h_rph_std is None
    assert rows[1].rolling_24h_trip_mean == 1 and rows[2].rolling_24h_rph_std == pytest.approx(statistics.stdev(rph[:2]))
    last = rows[199]
    assert last.rolling_24h_trip_mean == pytest.approx(statistics.mean(range(176, 200)))
    assert last.rolling_168h_trip_mean == pytest.approx(statistics.mean(range(32, 200)))
    assert last.rolling_24h_rph_std == pytest.approx(statistics.stdev(rph[175:199]))
    assert last.lag_168h_rph == rph[31] and last.lag_24h_trip_count == 176


def test_derived_and_shifted_values(make_cells):
    rows = hourly.store_features(make_cells([("A", h, 10 + h, 50.0 + h) for h in range(4)])).orderBy("ts_hour").collect()
    r = rows[3]
    assert r.trip_count_delta_1h == 1 and r.rph_delta_1h == 1.0
    assert r.demand_vs_baseline == pytest.approx(13 / 11)
    assert r.rph_zscore == pytest.approx((53 - 51) / statistics.stdev([50, 51, 52]))
    assert (r.avg_speed_mph, r.congestion_score) == (pytest.approx(15.0), pytest.approx(1 / 15))
    assert r.precipitation_delta == pytest.approx(0.0 - 0.2)
    assert r.lag1h_demand_vs_baseline == pytest.approx(12 / 10.5) and r.lag1h_avg_speed_mph == pytest.approx(15.0)
    assert rows[0].lag1h_avg_revenue is None and rows[0].rph_cv is None
    corrected = hourly.store_features(make_cells([("A", h, 10 + h, 50.0 + h) for h in range(4)]), StoreConfig(compat=False))
    last = corrected.orderBy(F.desc("ts_hour")).first()
    assert last.rph_zscore == pytest.approx((52 - 51) / statistics.stdev([50, 51, 52]))


def test_store_has_75_columns_and_filters_last(make_trips, zones, no_weather):
    at = dt.datetime(2024, 1, 1)
    thin = [{"at": at - dt.timedelta(hours=1)}]
    trips = make_trips(*thin, *[{"at": at + dt.timedelta(minutes=i)} for i in range(5)])
    kept = trip_quality_filter(features(trips, zones, no_weather))
    rows = hourly.feature_store_month(kept, JANUARY).collect()
    assert len(rows) == 1 and len(rows[0]) == 75
    # The hour before is thin and in the lookback: it is not stored, but it is the lag.
    assert rows[0].lag_1h_trip_count == 1
