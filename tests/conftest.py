import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zoneflow.session import build_session  # noqa: E402

TESTDATA = os.environ.get("ZONEFLOW_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("test tables are not here")
    return path


@pytest.fixture
def make_trips(spark):
    """Trips from dicts; everything not given has a harmless value."""
    from zoneflow.schemas import TRIP_SCHEMA

    usual = dict(
        VendorID=1, passenger_count=1.0, trip_distance=2.0, RatecodeID=1, store_and_fwd_flag="N", PULocationID=1,
        DOLocationID=1, payment_type=1, fare_amount=10.0, extra=0.0, mta_tax=0.5, tip_amount=0.0, tolls_amount=0.0,
        total_amount=10.5, Airport_fee=0.0)

    def make(*rows):
        out = []
        for row in rows:
            row = {**usual, **row}
            start = row.pop("at")
            minutes = row.pop("minutes", 10.0)
            row["tpep_pickup_datetime"] = start
            row["tpep_dropoff_datetime"] = start + dt.timedelta(minutes=minutes)
            out.append(tuple(row[c] for c in TRIP_SCHEMA.names))
        return spark.createDataFrame(out, TRIP_SCHEMA)

    return make


@pytest.fixture
def zones(spark):
    from zoneflow.schemas import ZONE_SCHEMA

    return spark.createDataFrame(
        [(1, "Queens", "JFK Airport"), (2, "Manhattan", "Midtown"), (3, "Bronx", "Park")], ZONE_SCHEMA)


@pytest.fixture
def no_weather(spark):
    from zoneflow.schemas import WEATHER_SCHEMA

    return spark.createDataFrame([], WEATHER_SCHEMA)


@pytest.fixture
def make_cells(spark):
    """Flow cells from (zone, hour number, trip count, revenue per hour); measures follow from the count."""
    first = dt.datetime(2024, 1, 1)

    def make(rows, borough="B"):
        data = []
        for zone, hour, count, rph in rows:
            data.append((zone, borough if zone is not None else None, first + dt.timedelta(hours=hour), count, rph,
                         rph, rph * 1.5, 20.0, 2.0, 0.5, 3.0, 12.0, 0.1 * (hour % 3), 10.0 + hour % 5, 4.0, 0.0,
                         float(hour % 2), 0.0, count // 2, count - count // 2, 2.0))
        frame = spark.createDataFrame(data, (
            "PUZone string, PUBorough string, ts_hour timestamp_ntz, trip_count bigint, target_rph double, "
            "median_rph double, p75_rph double, avg_revenue double, avg_tip double, tip_rate double, "
            "avg_distance_mi double, avg_duration_min double, precipitation double, temperature double, "
            "wind_speed double, frac_raining double, frac_airport_pickup double, frac_airport_dropoff double, "
            "dropoff_count bigint, net_pickup_flow bigint, pickup_dropoff_ratio double"))
        from zoneflow.functions.calendar import with_calendar
        return with_calendar(frame)

    return make
