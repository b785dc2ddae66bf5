"""SQL of every registered query whose result SQL can state, for an independent engine.

One chain of named steps serves all queries; a query is the chain up to its step plus a final SELECT.
"""

from __future__ import annotations

AIRPORTS = "('JFK Airport', 'LaGuardia Airport', 'Newark Airport')"
CELL = ["PUZone", "PUBorough", "ts_hour"]
HOURLY = ["temperature_2m", "precipitation", "apparent_temperature", "wind_speed_100m", "wind_speed_10m",
          "relative_humidity_2m"]
DAILY = ["temperature_2m_max", "temperature_2m_min", "apparent_temperature_mean", "precipitation_hours"]


def d6(value: str) -> str:
    """A double at six decimals, as the registered queries present it: exact halves are moved off the
    rounding edge, and zero has no sign."""
    return f"round(CAST({value} AS DOUBLE) + CAST(1.7e-9 AS DOUBLE), 6) + 0"


def r6(*columns: str) -> str:
    return ", ".join(f"{d6(c)} AS {c}" for c in columns)


def whole(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)


def plain(*columns: str) -> str:
    return ", ".join(columns)


def _trips(pickup: str) -> str:
    tip = "CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE value * CAST(0.2 AS DOUBLE) END"
    tolls = "CASE WHEN event_id % 10 = 0 THEN 6.5 ELSE 0.0 END"
    return f"""
    SELECT event_id, 1 + event_id % 2 AS VendorID, {pickup} AS tpep_pickup_datetime,
        {pickup} + to_minutes(CAST((event_id * 37) % 200 AS BIGINT)) AS tpep_dropoff_datetime,
        CAST(event_id % 7 AS DOUBLE) AS passenger_count,
        CAST(0.5 AS DOUBLE) + CAST(event_id % 200 AS DOUBLE) / CAST(10 AS DOUBLE) AS trip_distance,
        1 + event_id % 6 AS RatecodeID,
        CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
        user_id % 5 AS PULocationID, (event_id * 7) % 5 AS DOLocationID, 1 + event_id % 5 AS payment_type,
        value AS fare_amount, CAST((event_id % 3) * 0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
        CAST({tip} AS DOUBLE) AS tip_amount, CAST({tolls} AS DOUBLE) AS tolls_amount,
        value + CAST((event_id % 3) * 0.5 AS DOUBLE) + 0.5 + ({tip}) + CAST({tolls} AS DOUBLE) AS total_amount,
        CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END AS Airport_fee
    FROM events"""


def _weather(trips: str) -> dict[str, str]:
    return {
        "weather_hours": f"""
    SELECT h AS date, strftime(h, '%Y-%m') AS trip_month,
        CAST(n % 40 - 5 AS DOUBLE) AS temperature_2m,
        CASE WHEN n % 7 = 0 THEN CAST(n % 5 AS DOUBLE) / CAST(10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS precipitation,
        CAST(n % 45 - 8 AS DOUBLE) AS apparent_temperature, CAST(n % 50 AS DOUBLE) AS wind_speed_100m,
        CAST(n % 30 AS DOUBLE) AS wind_speed_10m, CAST(n % 110 AS DOUBLE) AS relative_humidity_2m
    FROM (SELECT DISTINCT date_trunc('hour', tpep_pickup_datetime) AS h,
            date_diff('hour', TIMESTAMP '2020-01-01 00:00:00', date_trunc('hour', tpep_pickup_datetime)) AS n
          FROM {trips})""",
        "weather_days": """
    SELECT CAST(CAST(date AS DATE) AS TIMESTAMP) AS date, strftime(date, '%Y-%m') AS trip_month,
        max(temperature_2m) AS temperature_2m_max, min(temperature_2m) AS temperature_2m_min,
        avg(apparent_temperature) AS apparent_temperature_mean,
        CAST(sum(CASE WHEN precipitation > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS precipitation_hours,
        strftime(date, '%Y-%m-%d') || 'T16:45' AS sunset, strftime(date, '%Y-%m-%d') || 'T07:15' AS sunrise
    FROM weather_hours GROUP BY CAST(date AS DATE), strftime(date, '%Y-%m'), strftime(date, '%Y-%m-%d')""",
    }


_MEANS = {
    "target_rph": "revenue_per_hour", "avg_revenue": "revenue", "avg_tip": "tip_amount",
    "tip_rate": "CASE WHEN tip_amount > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "avg_distance_mi": "trip_distance", "avg_duration_min": "trip_duration_min", "precipitation": "precipitation",
    "temperature": "apparent_temperature", "wind_speed": "wind_speed_10m", "frac_raining": "is_raining",
    "frac_airport_pickup": "is_airport_pickup", "frac_airport_dropoff": "is_airport_dropoff",
}
_CALENDAR_INT = ["hour", "day_of_week", "week_of_year", "month", "quarter", "year", "day_of_year", "is_weekend",
                 "is_rush", "is_night"]
_CYCLIC = ["hour_sin", "hour_cos", "dow_sin", "dow_cos"]
_LAGS = {f"lag_{k}h_rph": ("target_rph", k) for k in (1, 2, 24, 168)}
_LAGS |= {f"lag_{k}h_trip_count": ("trip_count", k) for k in (1, 2, 24)}
_LAGS |= {"lag_1h_dropoff_count": ("dropoff_count", 1)}
_ROLLING = {
    "rolling_24h_trip_mean": ("avg", "trip_count", 24), "rolling_168h_trip_mean": ("avg", "trip_count", 168),
    "rolling_24h_rph_mean": ("avg", "target_rph", 24), "rolling_7d_rph_mean": ("avg", "target_rph", 168),
    "rolling_24h_rph_std": ("stddev_samp", "target_rph", 24),
    "rolling_airport_activity": ("avg", "frac_airport_pickup", 24),
}
_SAME_HOUR = [
    "frac_airport_pickup", "frac_airport_dropoff", "precipitation", "temperature", "wind_speed", "frac_raining",
    "demand_vs_baseline", "dropoff_count", "net_pickup_flow", "avg_revenue", "avg_tip", "tip_rate",
    "avg_distance_mi", "avg_duration_min", "avg_speed_mph", "congestion_score",
]
_DERIVED = ["trip_count_delta_1h", "demand_vs_baseline", "rph_delta_1h", "rph_zscore", "avg_speed_mph",
            "congestion_score", "precipitation_delta", "rph_cv", "relative_zone_activity"]
_FUTURE_ROLLING = ["rolling_24h_trip_mean", "rolling_168h_trip_mean", "rolling_24h_rph_mean", "rolling_7d_rph_mean",
                   "rolling_24h_rph_std"]


def _calendar(ts: str, monday_first: bool = False) -> str:
    day = f"CAST(isodow({ts}) - 1 AS BIGINT)" if monday_first else f"CAST(dayofweek({ts}) AS BIGINT)"
    angle = "2 * pi() * CAST({} AS DOUBLE) / {}"
    return f"""hour({ts}) AS hour, {day} AS day_of_week, weekofyear({ts}) AS week_of_year, month({ts}) AS month,
        quarter({ts}) AS quarter, year({ts}) AS year, dayofyear({ts}) AS day_of_year,
        CAST(isodow({ts}) >= 6 AS INTEGER) AS is_weekend,
        CAST(hour({ts}) IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS is_rush,
        CAST(hour({ts}) < 6 OR hour({ts}) > 21 AS INTEGER) AS is_night,
        sin({angle.format(f'hour({ts})', 24)}) AS hour_sin, cos({angle.format(f'hour({ts})', 24)}) AS hour_cos,
        sin({angle.format(day, 7)}) AS dow_sin, cos({angle.format(day, 7)}) AS dow_cos"""


def _window_steps(source: str, prefix: str) -> dict[str, str]:
    """Lags, rolling values, derived values and shifted values of a cell table."""
    over = "PARTITION BY PUZone ORDER BY ts_hour, PUBorough"
    lags = [f"lag({c}, {k}) OVER w AS {name}" for name, (c, k) in _LAGS.items()]
    rolls = [
        f"{agg}({c}) OVER ({over} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS {name}"
        for name, (agg, c, k) in _ROLLING.items()
    ]
    shifted = [f"lag({m}, 1) OVER w AS lag1h_{m}" for m in _SAME_HOUR]
    speed = "(avg_distance_mi / (avg_duration_min / 60))"
    return {
        f"{prefix}lagged": f"SELECT *, {', '.join(lags + rolls)} FROM {source} WINDOW w AS ({over})",
        f"{prefix}derived": f"""
    SELECT *, lag_1h_trip_count - lag_2h_trip_count AS trip_count_delta_1h,
        CASE WHEN rolling_24h_trip_mean > 0 THEN trip_count / rolling_24h_trip_mean END AS demand_vs_baseline,
        target_rph - lag_1h_rph AS rph_delta_1h,
        CASE WHEN rolling_24h_rph_std > 0 THEN (target_rph - rolling_24h_rph_mean) / rolling_24h_rph_std END AS rph_zscore,
        CASE WHEN avg_duration_min > 0 THEN {speed} END AS avg_speed_mph,
        CASE WHEN avg_duration_min > 0 AND avg_distance_mi > 0 THEN 1 / {speed} END AS congestion_score,
        precipitation - lag(precipitation) OVER ({over}) AS precipitation_delta,
        CASE WHEN rolling_24h_rph_mean > 0 THEN rolling_24h_rph_std / rolling_24h_rph_mean END AS rph_cv,
        CASE WHEN rolling_168h_trip_mean > 0 THEN lag_1h_trip_count / rolling_168h_trip_mean END AS relative_zone_activity
    FROM {prefix}lagged""",
        f"{prefix}shifted": f"SELECT *, {', '.join(shifted)} FROM {prefix}derived WINDOW w AS ({over})",
    }


def _steps() -> dict[str, str]:
    steps = {
        "trips": _trips("ts"),
        "trips2": _trips("(CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 1 MONTH ELSE ts END)"),
        "zones": """
    SELECT r_regionkey AS LocationID, CASE WHEN r_regionkey % 2 = 0 THEN 'East' ELSE 'West' END AS Borough,
        CASE r_regionkey WHEN 1 THEN 'JFK Airport' WHEN 3 THEN 'Newark Airport' ELSE r_name END AS Zone
    FROM region WHERE r_regionkey <> 4""",
        **_weather("trips"),
        "enriched": """
    SELECT t.*, p.Borough AS PUBorough, p.Zone AS PUZone, d.Borough AS DOBorough, d.Zone AS DOZone,
        h.temperature_2m, h.precipitation, h.apparent_temperature, h.wind_speed_10m, h.wind_speed_100m,
        h.relative_humidity_2m, w.apparent_temperature_mean, w.precipitation_hours, w.sunrise, w.sunset
    FROM trips t
    LEFT JOIN zones p ON p.LocationID = t.PULocationID
    LEFT JOIN zones d ON d.LocationID = t.DOLocationID
    LEFT JOIN weather_hours h ON h.date = date_trunc('hour', t.tpep_pickup_datetime)
    LEFT JOIN weather_days w ON CAST(w.date AS DATE) = CAST(t.tpep_pickup_datetime AS DATE)
    WHERE t.tpep_pickup_datetime >= TIMESTAMP '2023-12-01' AND t.tpep_pickup_datetime < TIMESTAMP '2024-02-01'""",
        "timed": """
    SELECT *, date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(6e7 AS DOUBLE)
            AS trip_duration_min,
        coalesce(greatest(fare_amount + extra + tip_amount + tolls_amount + Airport_fee, 0), 0) AS revenue
    FROM enriched""",
        "features": f"""
    SELECT *, CASE WHEN trip_duration_min > 1 THEN revenue / (trip_duration_min / 60) END AS revenue_per_hour,
        date_trunc('hour', tpep_pickup_datetime) AS ts_hour, CAST(tpep_pickup_datetime AS DATE) AS service_date,
        {_calendar('tpep_pickup_datetime')},
        CAST(hour(tpep_pickup_datetime) IN (7, 8, 9) AS INTEGER) AS is_am_rush,
        CAST(hour(tpep_pickup_datetime) IN (17, 18, 19) AS INTEGER) AS is_pm_rush,
        CAST(coalesce(precipitation > 0, false) AS INTEGER) AS is_raining,
        CAST(coalesce(apparent_temperature < 5, false) AS INTEGER) AS is_cold,
        CAST(coalesce(apparent_temperature > 30, false) AS INTEGER) AS is_hot,
        CAST(coalesce(PUZone IN {AIRPORTS}, false) AS INTEGER) AS is_airport_pickup,
        CAST(coalesce(DOZone IN {AIRPORTS}, false) AS INTEGER) AS is_airport_dropoff
    FROM timed""",
        "kept": """
    SELECT * FROM features
    WHERE trip_duration_min >= 2 AND trip_duration_min <= 180 AND trip_distance >= 0.1 AND trip_distance <= 100
        AND revenue >= 3 AND revenue <= 500 AND revenue_per_hour >= 5 AND revenue_per_hour <= 500""",
        "measures": f"""
    SELECT PUZone, PUBorough, ts_hour, count(*) AS trip_count,
        {', '.join(f'avg({source}) AS {name}' for name, source in _MEANS.items())},
        median(revenue_per_hour) AS median_rph, quantile_cont(revenue_per_hour, 0.75) AS p75_rph
    FROM kept GROUP BY PUZone, PUBorough, ts_hour""",
        "cells": f"SELECT *, CAST(ts_hour AS DATE) AS service_date, {_calendar('ts_hour')} FROM measures",
        "arrivals": "SELECT DOZone AS zone, ts_hour, count(*) AS dropoff_count FROM kept GROUP BY DOZone, ts_hour",
        "flow": """
    SELECT c.*, coalesce(a.dropoff_count, 0) AS dropoff_count,
        c.trip_count - coalesce(a.dropoff_count, 0) AS net_pickup_flow,
        CAST(c.trip_count AS DOUBLE) / nullif(a.dropoff_count, 0) AS pickup_dropoff_ratio
    FROM cells c LEFT JOIN arrivals a ON a.zone = c.PUZone AND a.ts_hour = c.ts_hour""",
        **_window_steps("flow", ""),
        "month_rows": "SELECT * FROM shifted WHERE ts_hour >= TIMESTAMP '2024-01-01' AND ts_hour < TIMESTAMP '2024-02-01'",
        "store": "SELECT * FROM month_rows WHERE trip_count >= 5",
        "delivered": "SELECT * FROM trips UNION ALL SELECT * FROM trips WHERE PULocationID % 3 = 0",
        "history": "SELECT * FROM month_rows WHERE trip_count >= 1 AND PUZone IS NOT NULL AND PUBorough IS NOT NULL",
        "clock": """
    SELECT g.PUZone, g.PUBorough, g.ts_hour, f.* EXCLUDE (PUZone, PUBorough, ts_hour)
    FROM (SELECT PUZone, PUBorough, unnest(generate_series(min(ts_hour), max(ts_hour), INTERVAL 1 HOUR)) AS ts_hour
          FROM flow GROUP BY PUZone, PUBorough) g
    LEFT JOIN flow f ON f.PUZone IS NOT DISTINCT FROM g.PUZone AND f.PUBorough IS NOT DISTINCT FROM g.PUBorough
        AND f.ts_hour = g.ts_hour""",
        **_window_steps("clock", "clock_"),
        "coded": """
    SELECT h.*, z.code AS PUZone_enc, b.code AS PUBorough_enc FROM history h
    JOIN (SELECT PUZone, row_number() OVER (ORDER BY PUZone) - 1 AS code FROM (SELECT DISTINCT PUZone FROM history)) z
        ON z.PUZone = h.PUZone
    JOIN (SELECT PUBorough, row_number() OVER (ORDER BY PUBorough) - 1 AS code
          FROM (SELECT DISTINCT PUBorough FROM history)) b ON b.PUBorough = h.PUBorough""",
        "numbered": """
    SELECT *, row_number() OVER (ORDER BY ts_hour, PUZone, PUBorough) AS position, count(*) OVER () AS n FROM history""",
        "limits": """
    SELECT *, CAST(floor(n * CAST(0.7 AS DOUBLE)) AS BIGINT) AS train_end,
        CAST(floor(n * CAST(0.7 AS DOUBLE)) AS BIGINT) + CAST(floor(n * CAST(0.15 AS DOUBLE)) AS BIGINT) AS valid_end
    FROM numbered""",
        "parts": """
    SELECT *, CASE WHEN position <= train_end THEN 'train' WHEN position <= valid_end THEN 'valid' ELSE 'test' END AS split,
        coalesce(CAST(lag_1h_trip_count AS DOUBLE), 0) + coalesce(rolling_24h_rph_std, 0) + coalesce(congestion_score, 0)
            AS competition
    FROM limits""",
        "labelled": """
    SELECT * EXCLUDE (tip_rate), coalesce(tip_rate, 0) AS tip_rate,
        CAST(coalesce(tip_rate, 0) > (SELECT median(coalesce(tip_rate, 0)) FROM parts WHERE split = 'train') AS BIGINT)
            AS high_tip_zone
    FROM parts""",
        "beginning": "SELECT max(ts_hour) + INTERVAL 1 HOUR AS first_hour FROM history",
        "grid": f"""
    SELECT *, {_calendar('ts_hour', monday_first=True)}
    FROM (SELECT DISTINCT PUZone, PUBorough, PUZone_enc, PUBorough_enc FROM coded),
        (SELECT first_hour + to_hours(k) AS ts_hour FROM beginning, range(24) AS steps(k))""",
        "rolled": f"""
    SELECT * EXCLUDE ({', '.join(_FUTURE_ROLLING)}),
        {', '.join(f"{agg}({c}) OVER (PARTITION BY PUZone ORDER BY ts_hour, PUBorough ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS {name}"
                   for name, (agg, c, k) in _ROLLING.items() if name in _FUTURE_ROLLING)}
    FROM history""",
        "ahead": f"SELECT g.*, {_lag_columns()} FROM grid g {_lag_joins('g')}",
        "ahead_derived": """
    SELECT *, lag_1h_trip_count - lag_2h_trip_count AS trip_count_delta_1h, lag_1h_rph - lag_2h_rph AS rph_delta_1h,
        (lag_1h_rph - rolling_24h_rph_mean) / (coalesce(rolling_24h_rph_std, 0) + CAST(1e-6 AS DOUBLE)) AS rph_zscore,
        coalesce(rolling_24h_rph_std, 0) / (coalesce(rolling_24h_rph_mean, 0) + CAST(1e-6 AS DOUBLE)) AS rph_cv,
        lag_1h_trip_count / nullif(rolling_168h_trip_mean, 0) AS relative_zone_activity
    FROM ahead""",
        "predicted": """
    SELECT *, coalesce(CAST(lag_24h_trip_count AS DOUBLE), rolling_168h_trip_mean, 0) AS pred_demand,
        coalesce(lag_24h_rph, lag_168h_rph, 0) AS pred_rph,
        coalesce(rolling_24h_trip_mean, 0) + CAST(hour AS DOUBLE) / 10 AS pred_competition,
        1 / (1 + exp(-coalesce(lag_168h_rph, 0) / 100)) AS pred_tip_prob
    FROM ahead_derived""",
        "scaled": """
    SELECT *, (pred_demand - min(pred_demand) OVER ()) / (max(pred_demand) OVER () - min(pred_demand) OVER () + 1e-9) AS score_demand,
        (pred_rph - min(pred_rph) OVER ()) / (max(pred_rph) OVER () - min(pred_rph) OVER () + 1e-9) AS score_profit,
        1 - (pred_competition - min(pred_competition) OVER ())
            / (max(pred_competition) OVER () - min(pred_competition) OVER () + 1e-9) AS score_competition,
        (pred_tip_prob - min(pred_tip_prob) OVER ())
            / (max(pred_tip_prob) OVER () - min(pred_tip_prob) OVER () + 1e-9) AS score_tip
    FROM predicted""",
        "scored": """
    SELECT *, CAST(0.35 AS DOUBLE) * score_demand + CAST(0.35 AS DOUBLE) * score_profit
        + CAST(0.20 AS DOUBLE) * score_competition + CAST(0.10 AS DOUBLE) * score_tip AS opportunity_score
    FROM scaled""",
        "ranked": f"""
    SELECT *, {', '.join(f"row_number() OVER (PARTITION BY ts_hour ORDER BY round({column}, 9) {way}, PUZone, PUBorough) AS rank_{signal}"
                         for signal, (column, way) in _SIGNALS.items())}
    FROM scored""",
        "view": """
    SELECT trim(v.PUZone) AS PUZone, v.pred_rph, v.pred_demand, v.pred_competition, v.opportunity_score, z.LocationID AS shape_id
    FROM (SELECT PUZone, avg(pred_rph) AS pred_rph, avg(pred_demand) AS pred_demand,
            avg(pred_competition) AS pred_competition, avg(opportunity_score) AS opportunity_score
          FROM scored WHERE ts_hour = TIMESTAMP '2024-01-31 08:00:00' AND PUZone IS NOT NULL GROUP BY PUZone) v
    LEFT JOIN zones z ON z.Zone = v.PUZone""",
    }
    return steps


_SIGNALS = {
    "demand": ("pred_demand", "DESC"), "profit": ("pred_rph", "DESC"), "competition": ("pred_competition", "ASC"),
    "tip": ("pred_tip_prob", "DESC"), "opportunity": ("opportunity_score", "DESC"),
}

# Feature -> (hours back, history column): one join per offset here.
_AHEAD = {
    "lag_1h_trip_count": (1, "trip_count"), "lag_2h_trip_count": (2, "trip_count"),
    "lag_24h_trip_count": (24, "trip_count"), "rolling_24h_trip_mean": (24, "rolling_24h_trip_mean"),
    "rolling_168h_trip_mean": (24, "rolling_168h_trip_mean"), "lag_1h_rph": (1, "target_rph"),
    "rolling_24h_rph_mean": (1, "rolling_24h_rph_mean"), "rolling_7d_rph_mean": (1, "rolling_7d_rph_mean"),
    "rolling_24h_rph_std": (1, "rolling_24h_rph_std"), "lag_2h_rph": (2, "target_rph"),
    "lag_24h_rph": (24, "target_rph"), "lag_168h_rph": (168, "target_rph"),
    **{f"lag1h_{m}": (1, m) for m in _SAME_HOUR},
}
_AHEAD_WHOLE = ["lag_1h_trip_count", "lag_2h_trip_count", "lag_24h_trip_count", "lag1h_dropoff_count",
                "lag1h_net_pickup_flow"]
_AHEAD_DOUBLE = [c for c in _AHEAD if c not in _AHEAD_WHOLE]


def _lag_columns() -> str:
    return ", ".join(f"b{k}.{c} AS {name}" for name, (k, c) in _AHEAD.items())


def _lag_joins(grid: str) -> str:
    return " ".join(
        f"LEFT JOIN rolled b{k} ON b{k}.PUZone = {grid}.PUZone AND b{k}.ts_hour = {grid}.ts_hour - to_hours({k})"
        for k in (1, 2, 24, 168))


def _rules(source: str, rules: dict[str, str]) -> str:
    """One row per rule from the condition that breaks it."""
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) AS checked_rows, "
        f"CAST(coalesce(sum(CASE WHEN {broken} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations, "
        f"coalesce(sum(CASE WHEN {broken} THEN 1 ELSE 0 END), 0) = 0 AS passed FROM {source}"
        for rule, broken in rules.items())


_OPPOSITE = {">": "<=", ">=": "<", "<=": ">"}


def _range_rules(ranges: dict[str, list[tuple[str, int]]]) -> dict[str, str]:
    return {f"{c} {t} {x}": f"{c} {_OPPOSITE[t]} {x}" for c, tests in ranges.items() for t, x in tests}


_TRIP_RANGES = {
    "passenger_count": [(">", 0), ("<=", 10)], "trip_distance": [(">=", 0), ("<=", 300)], "fare_amount": [(">=", 0)],
    "extra": [(">=", 0), ("<=", 5)], "mta_tax": [(">=", 0), ("<=", 5)], "tip_amount": [(">=", 0)],
    "tolls_amount": [(">=", 0)], "total_amount": [(">=", 0)], "Airport_fee": [(">=", 0)],
    "PULocationID": [(">", 0)], "DOLocationID": [(">", 0)],
}
_WEATHER_RANGES = {
    **{c: [(">=", -60), ("<=", 60)] for c in (
        "temperature_2m", "apparent_temperature", "temperature_2m_max", "temperature_2m_min", "apparent_temperature_mean")},
    **{c: [(">=", 0)] for c in ("wind_speed_100m", "wind_speed_10m", "precipitation", "precipitation_hours")},
    "relative_humidity_2m": [(">=", 0), ("<=", 100)],
}
_TRIP_COLUMNS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
                 "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type", "fare_amount",
                 "extra", "mta_tax", "tip_amount", "tolls_amount", "total_amount", "Airport_fee"]
_TRIP_TIMES = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
_TRIP_KEY = [*_TRIP_TIMES, "PULocationID", "DOLocationID"]
_TRIP_WHOLE = ["VendorID", "RatecodeID", "PULocationID", "DOLocationID", "payment_type"]
_TRIP_DOUBLE = ["passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                "total_amount", "Airport_fee"]
_WEATHER_ON_TRIP = ["temperature_2m", "precipitation", "apparent_temperature", "wind_speed_10m", "wind_speed_100m",
                    "relative_humidity_2m", "apparent_temperature_mean", "precipitation_hours"]
_ZONE_NAMES = ["PUBorough", "PUZone", "DOBorough", "DOZone"]

_FLAGS = ["is_am_rush", "is_pm_rush", "is_raining", "is_cold", "is_hot", "is_airport_pickup", "is_airport_dropoff"]
_MEASURES = list(_MEANS) + ["median_rph", "p75_rph"]
_STORE_WHOLE = ["trip_count", *_CALENDAR_INT, "dropoff_count", "net_pickup_flow", "lag_1h_trip_count",
                "lag_2h_trip_count", "lag_24h_trip_count", "lag_1h_dropoff_count", "trip_count_delta_1h",
                "lag1h_dropoff_count", "lag1h_net_pickup_flow"]
_STORE_DOUBLE = [*_MEASURES, *_CYCLIC, "pickup_dropoff_ratio",
                 *[c for c in _LAGS if c not in _STORE_WHOLE], *_ROLLING,
                 *[c for c in _DERIVED if c not in _STORE_WHOLE],
                 *[f"lag1h_{m}" for m in _SAME_HOUR if f"lag1h_{m}" not in _STORE_WHOLE]]

_FILLED = ["lag1h_temperature", "lag1h_tip_rate", "rolling_airport_activity", "lag_1h_trip_count", "lag_24h_trip_count",
           "lag_1h_rph", "lag_168h_rph", "rph_zscore", "rph_cv", "not_in_history"]
_IMPUTED = ["lag_1h_rph", "lag_24h_rph", "lag_168h_rph", "rolling_24h_rph_std", "lag1h_precipitation", "rph_zscore"]
_CLIMATE_ZONE = ["avg_revenue", "avg_tip", "tip_rate", "avg_distance_mi", "avg_duration_min", "avg_speed_mph",
                 "congestion_score", "frac_airport_pickup", "frac_airport_dropoff", "rolling_airport_activity",
                 "dropoff_count", "net_pickup_flow", "demand_vs_baseline", "relative_zone_activity", "median_rph",
                 "p75_rph", "pickup_dropoff_ratio"]
_CLIMATE_HOUR = ["precipitation", "temperature", "wind_speed", "frac_raining", "precipitation_delta"]
_OUTPUT_DOUBLE = ["opportunity_score", "pred_demand", "pred_rph", "pred_competition", "pred_tip_prob", "score_demand",
                  "score_profit", "score_competition", "score_tip"]


def _weather_union() -> str:
    hourly = ", ".join(HOURLY)
    return f"""
    SELECT date, 'hourly' AS type, trip_month, {hourly}, {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in DAILY)},
        CAST(NULL AS VARCHAR) AS sunset, CAST(NULL AS VARCHAR) AS sunrise FROM weather_hours
    UNION ALL
    SELECT date, 'daily' AS type, trip_month, {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in HOURLY)},
        {', '.join(DAILY)}, sunset, sunrise FROM weather_days"""


def _filled_select() -> str:
    future = [c for c in _FILLED if c in _AHEAD or c in ("rph_zscore", "rph_cv")]
    known = [c for c in _FILLED if c != "not_in_history"]
    columns = []
    for c in _FILLED:
        options = [f"CAST(f.{c} AS DOUBLE)"] if c in future else []
        options += [f"z.{c}", f"o.{c}"] if c in known else []
        columns.append(f"{d6('coalesce(' + ', '.join([*options, '0']) + ')')} AS {c}")
    medians = ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in known)
    return f"""
    SELECT f.PUZone, f.PUBorough, f.ts_hour, {', '.join(columns)} FROM ahead_derived f
    LEFT JOIN (SELECT PUZone, {medians} FROM history GROUP BY PUZone) z ON z.PUZone = f.PUZone,
    (SELECT {medians} FROM history) o"""


def _finals() -> dict[str, str]:
    order_months = "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders"
    weather = (f"SELECT date, type, trip_month, {r6(*HOURLY)}, {r6(*DAILY)}, sunset, sunrise FROM ({_weather_union()})")
    cell = plain(*CELL)
    drift_runs = """
    SELECT date_trunc('day', ts_hour) AS run_ts, avg(abs(trip_count - coalesce(lag_1h_trip_count, 0))) AS mae,
        sqrt(avg((target_rph - coalesce(lag_1h_rph, 0)) * (target_rph - coalesce(lag_1h_rph, 0)))) AS rmse
    FROM history GROUP BY 1"""
    errors = {
        "demand_{}_mae": "avg(abs(trip_count - coalesce(lag_24h_trip_count, lag_1h_trip_count, 0)))",
        "profit_{}_rmse": "sqrt(avg((target_rph - coalesce(lag_1h_rph, 0)) * (target_rph - coalesce(lag_1h_rph, 0))))",
        "competition_{}_rmse": "sqrt(avg((competition - coalesce(rolling_24h_rph_mean, 0)) "
                               "* (competition - coalesce(rolling_24h_rph_mean, 0))))",
        "tip_{}_accuracy": "avg(CAST(high_tip_zone = CASE WHEN lag1h_tip_rate > 0.75 THEN 1 ELSE 0 END AS DOUBLE))",
    }
    hidden = {"pred_rph": "CASE WHEN rank_opportunity = 1 THEN 0 ELSE pred_rph END",
              "pred_demand": "CASE WHEN rank_opportunity = 2 THEN 0 ELSE pred_demand END"}
    output = (f"SELECT ts_hour, PUZone, PUBorough, CAST(rank_opportunity AS BIGINT) AS rank, "
              f"{', '.join(f'round_even({c}, 4) AS {c}' for c in _OUTPUT_DOUBLE)} FROM ranked WHERE rank_opportunity <= 3")
    presence = [f"SELECT 'trips' AS dataset, 'has {c}' AS rule, count(*) AS checked_rows, "
                f"CAST({int(c == 'Airport_fee')} AS BIGINT) AS violations, {c != 'Airport_fee'} AS passed FROM trips"
                for c in _TRIP_COLUMNS]
    presence += [f"SELECT 'trips', '{c} is a timestamp', count(*), CAST(0 AS BIGINT), true FROM trips" for c in _TRIP_TIMES]
    presence += ["SELECT 'trips', 'not empty', count(*), CAST(count(*) = 0 AS BIGINT), count(*) > 0 FROM trips"]
    all_weather = "((SELECT date FROM weather_hours) UNION ALL (SELECT date FROM weather_days))"
    presence += [f"SELECT 'weather', 'has all hourly or all daily columns', count(*), CAST(0 AS BIGINT), true FROM {all_weather}",
                 f"SELECT 'weather', 'not empty', count(*), CAST(count(*) = 0 AS BIGINT), count(*) > 0 FROM {all_weather}"]
    return {
        "scan_trips": f"SELECT {whole(*_TRIP_WHOLE)}, {plain(*_TRIP_TIMES)}, store_and_fwd_flag, {r6(*_TRIP_DOUBLE)} FROM trips2",
        "scan_trips_drifted": f"""
    SELECT {whole(*_TRIP_WHOLE)}, {plain(*_TRIP_TIMES)},
        CASE WHEN strftime(tpep_pickup_datetime, '%Y-%m') <> '2023-12' THEN store_and_fwd_flag END AS store_and_fwd_flag, {r6(*_TRIP_DOUBLE)}
    FROM trips2""",
        "trip_schema_drift": """
    SELECT * FROM (VALUES
        ('yellow_tripdata_2023-12.parquet', 'VendorID', 'vendorid', 'bigint', 'bigint', 'renamed'),
        ('yellow_tripdata_2023-12.parquet', 'tpep_pickup_datetime', 'tpep_pickup_datetime', 'string', 'timestamp_ntz', 'retyped'),
        ('yellow_tripdata_2023-12.parquet', 'passenger_count', 'passenger_count', 'bigint', 'double', 'retyped'),
        ('yellow_tripdata_2023-12.parquet', 'RatecodeID', 'RatecodeID', 'string', 'bigint', 'retyped'),
        ('yellow_tripdata_2023-12.parquet', 'store_and_fwd_flag', NULL, NULL, 'string', 'missing'),
        ('yellow_tripdata_2023-12.parquet', 'PULocationID', 'PULocationID', 'int', 'bigint', 'retyped'),
        ('yellow_tripdata_2023-12.parquet', 'payment_type', 'payment_type', 'double', 'bigint', 'retyped'),
        ('yellow_tripdata_2023-12.parquet', 'Airport_fee', 'airport_fee', 'double', 'double', 'renamed'),
        ('yellow_tripdata_2023-12.parquet', NULL, 'cbd_fee', 'double', NULL, 'added'),
        ('yellow_tripdata_2024-01.parquet', 'extra', 'extra', 'float', 'double', 'retyped'))
        AS t("file", "column", found_name, found_type, wanted_type, change)""",
        "scan_weather": weather,
        "weather_payload_rows": weather,
        "weather_payloads_refused": f"""
    SELECT strftime(date, '%Y-%m-%d') AS day, CASE day(date) % 5 WHEN 1 THEN 'not readable as JSON' WHEN 2 THEN 'no time axis'
        WHEN 3 THEN 'hourly.wind_speed_10m is not as long as its times' ELSE 'hourly.time cannot be read' END AS reason
    FROM ({weather}) WHERE type = 'daily' AND day(date) % 5 <> 0""",
        "weather_payloads_accepted": f"""
    SELECT type, count(*) AS rows, round(sum(temperature_2m), 6) AS temperatures FROM ({weather}) WHERE day(date) % 5 = 0 GROUP BY type
    UNION ALL SELECT 'refused', count(*), NULL FROM ({weather}) WHERE type = 'daily' AND day(date) % 5 <> 0""",
        "zone_lookup": """
    SELECT CAST(r_regionkey AS BIGINT) AS LocationID, CASE WHEN r_regionkey % 2 = 0 THEN 'East' ELSE 'West' END AS Borough,
        CASE WHEN r_regionkey <> 4 THEN r_name END AS Zone, p.pickups
    FROM region LEFT JOIN (SELECT PULocationID, count(*) AS pickups FROM trips GROUP BY 1) p ON p.PULocationID = r_regionkey""",
        "month_list": """
    SELECT strftime(m, '%Y-%m') AS month FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
        date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)""",
        "month_bounds": f"""
    SELECT month, month || '-01' AS first_day,
        strftime(last_day(CAST(month || '-01' AS DATE)), '%Y-%m-%d') AS last_day FROM ({order_months})""",
        "missing_months": f"""
    SELECT month FROM (SELECT strftime(m, '%Y-%m') AS month FROM (SELECT unnest(generate_series(
        date_trunc('month', least((SELECT min(o_orderdate) FROM orders), (SELECT min(ts) FROM events))),
        date_trunc('month', greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(ts) FROM events))),
        INTERVAL 1 MONTH)) AS m))
    WHERE month NOT IN ({order_months}) AND month NOT IN (SELECT strftime(ts, '%Y-%m') FROM events)""",
        "retention_plan": f"""
    SELECT 'raw/yellow_tripdata_' || month || '.parquet' AS file_name, month FROM ({order_months})
    WHERE CAST(month || '-01' AS DATE) < (SELECT CAST(greatest(max(month), '1996-06') || '-01' AS DATE) FROM ({order_months}))
        - INTERVAL 11 MONTH""",
        "latest_snapshot": f"""
    SELECT {cell}, trip_count, {r6('target_rph')}, date_trunc('day', ts_hour) AS run_ts FROM cells
    WHERE CAST(ts_hour AS DATE) = (SELECT CAST(max(ts_hour) AS DATE) FROM cells)""",
        "month_window": """
    SELECT count(*) AS n_total, min(tpep_pickup_datetime) AS first_pickup, max(tpep_pickup_datetime) AS last_pickup
    FROM trips2 WHERE tpep_pickup_datetime >= TIMESTAMP '2023-11-01' AND tpep_pickup_datetime < TIMESTAMP '2024-01-01'""",
        "enrich_trips": f"""
    SELECT {whole(*_TRIP_WHOLE)}, {plain(*_TRIP_TIMES, 'store_and_fwd_flag', *_ZONE_NAMES, 'sunrise', 'sunset')},
        {r6(*_TRIP_DOUBLE, *_WEATHER_ON_TRIP)} FROM enriched""",
        "trip_features": f"""
    SELECT {plain(*_TRIP_TIMES, *_ZONE_NAMES)}, {whole('PULocationID', 'DOLocationID', *_CALENDAR_INT, *_FLAGS)},
        {r6(*_WEATHER_ON_TRIP, 'trip_duration_min', 'revenue', 'revenue_per_hour', *_CYCLIC)},
        ts_hour, CAST(service_date AS VARCHAR) AS service_date FROM features""",
        "trip_quality_filter": f"""
    SELECT {plain(*_TRIP_TIMES)}, {whole('PULocationID', 'DOLocationID')},
        {r6('trip_distance', 'trip_duration_min', 'revenue', 'revenue_per_hour')} FROM kept""",
        "hourly_pickups": f"""
    SELECT {cell}, CAST(service_date AS VARCHAR) AS service_date, {whole('trip_count', *_CALENDAR_INT)},
        {r6(*_MEASURES, *_CYCLIC)} FROM cells""",
        "hourly_dropoffs": "SELECT * FROM arrivals",
        "pickup_dropoff_flow": f"""
    SELECT {cell}, {whole('trip_count', 'dropoff_count', 'net_pickup_flow')}, {r6('pickup_dropoff_ratio')} FROM flow""",
        "lag_features": f"""
    SELECT {cell}, {whole(*[c for c in _LAGS if c in _STORE_WHOLE])},
        {r6(*[c for c in _LAGS if c not in _STORE_WHOLE])} FROM lagged""",
        "lag_features_by_clock": f"""
    SELECT {cell}, {whole('trip_count', *[c for c in _LAGS if c in _STORE_WHOLE])},
        {r6(*[c for c in _LAGS if c not in _STORE_WHOLE], *_ROLLING)} FROM clock_lagged WHERE trip_count IS NOT NULL""",
        "rolling_features": f"SELECT {cell}, {r6(*_ROLLING)} FROM lagged",
        "derived_features": f"""
    SELECT {cell}, {whole('trip_count_delta_1h')}, {r6(*[c for c in _DERIVED if c != 'trip_count_delta_1h'])} FROM derived""",
        "shifted_features": f"""
    SELECT {cell}, {whole('lag1h_dropoff_count', 'lag1h_net_pickup_flow')},
        {r6(*[f'lag1h_{m}' for m in _SAME_HOUR if m not in ('dropoff_count', 'net_pickup_flow')])} FROM shifted""",
        "feature_store_month": f"""
    SELECT {cell}, CAST(service_date AS VARCHAR) AS service_date, {whole(*_STORE_WHOLE)}, {r6(*_STORE_DOUBLE)} FROM store""",
        "ingest_new_months": f"""
    SELECT {plain(*_TRIP_KEY)}, {d6("fare_amount + CASE WHEN tpep_pickup_datetime >= TIMESTAMP '2024-01-01' THEN 1 ELSE 0 END")} AS fare_amount,
        strftime(tpep_pickup_datetime, '%Y-%m') AS trip_month FROM trips2
    WHERE tpep_pickup_datetime >= TIMESTAMP '2023-12-01' AND tpep_pickup_datetime < TIMESTAMP '2024-02-01'""",
        "bucketed_store_windows": f"SELECT {cell}, {whole('trip_count')}, {r6('target_rph', *_FUTURE_ROLLING)} FROM rolled",
        "store_by_carried_tails": f"""
    SELECT {cell}, CAST(service_date AS VARCHAR) AS service_date, {whole(*_STORE_WHOLE)}, {r6(*_STORE_DOUBLE)} FROM month_rows""",
        "release_history": """
    SELECT CAST(number AS BIGINT) AS number, "table", month, 'build ' || month AS note
    FROM (SELECT dense_rank() OVER (ORDER BY month) AS number, month FROM (SELECT DISTINCT strftime(tpep_pickup_datetime, '%Y-%m') AS month FROM trips2)),
        (SELECT unnest(['hourly_zone_store', 'zone_tails', 'trip_features', 'enriched_trips']) AS "table")
    WHERE month IN ('2023-12', '2024-01')""",
        "upsert_month": f"""
    SELECT {plain(*_TRIP_KEY)}, {r6('fare_amount')}, CAST(NULL AS BIGINT) AS corrected FROM trips2
    WHERE NOT (tpep_pickup_datetime >= TIMESTAMP '2023-12-01' AND tpep_pickup_datetime < TIMESTAMP '2024-01-01')
    UNION ALL
    SELECT {plain(*_TRIP_KEY)}, {d6('fare_amount + 1')} AS fare_amount, CAST(1 AS BIGINT) AS corrected FROM trips2
    WHERE tpep_pickup_datetime >= TIMESTAMP '2023-12-01' AND tpep_pickup_datetime < TIMESTAMP '2024-01-01'
        AND fare_amount + 1 > 5""",
        "upsert_month_stored": f"""
    SELECT {plain(*_TRIP_KEY)}, {r6('fare_amount')}, strftime(tpep_pickup_datetime, '%Y-%m') AS trip_month FROM trips2
    WHERE NOT (tpep_pickup_datetime >= TIMESTAMP '2023-12-01' AND tpep_pickup_datetime < TIMESTAMP '2024-01-01')
    UNION ALL
    SELECT {plain(*_TRIP_KEY)}, {d6('fare_amount + 1')} AS fare_amount, '2023-12' AS trip_month FROM trips2
    WHERE tpep_pickup_datetime >= TIMESTAMP '2023-12-01' AND tpep_pickup_datetime < TIMESTAMP '2024-01-01'
        AND fare_amount + 1 > 5""",
        "store_summary": f"""
    SELECT count(*) AS rows, count(DISTINCT PUZone) AS zones, min(ts_hour) AS min_ts, max(ts_hour) AS max_ts,
        {d6('avg(target_rph)')} AS avg_rph, {d6('avg(trip_count)')} AS avg_trip_count FROM store""",
        "store_preview": f"""
    SELECT PUZone, ts_hour, {whole('trip_count', 'dropoff_count', 'net_pickup_flow')},
        {r6('target_rph', 'lag_1h_rph', 'rolling_24h_rph_mean', 'pickup_dropoff_ratio', 'avg_speed_mph', 'congestion_score',
            'rph_zscore', 'rph_cv', 'precipitation', 'temperature')}
    FROM (SELECT * FROM store ORDER BY ts_hour, PUZone NULLS LAST, PUBorough NULLS LAST LIMIT 20)""",
        "dq_schema": " UNION ALL ".join(presence),
        "dq_trip_rules": _rules("trips", _range_rules(_TRIP_RANGES)),
        "dq_value_sets": _rules("trips", {
            "payment_type in 1/2/3/4": "payment_type IS NULL OR payment_type NOT IN (1, 2, 3, 4)",
            "RatecodeID in 1/2/3/4/5": "RatecodeID IS NULL OR RatecodeID NOT IN (1, 2, 3, 4, 5)",
            "store_and_fwd_flag in Y/N": "store_and_fwd_flag IS NULL OR store_and_fwd_flag NOT IN ('Y', 'N')",
        }),
        "duplicate_check": """
    SELECT 'full-row duplicates' AS rule, checked_rows, violations,
        violations <= greatest(floor(checked_rows * CAST(0.01 AS DOUBLE)), 10) AS passed
    FROM (SELECT (SELECT count(*) FROM trips) AS checked_rows, (SELECT count(*) FROM trips) - (SELECT count(*) FROM
        (SELECT DISTINCT PULocationID, DOLocationID, payment_type, fare_amount, extra FROM trips)) AS violations)""",
        "full_duplicate_check": """
    SELECT 'full-row duplicates' AS rule, checked_rows, violations,
        violations <= greatest(floor(checked_rows * CAST(0.01 AS DOUBLE)), 10) AS passed
    FROM (SELECT (SELECT count(*) FROM delivered) AS checked_rows,
        (SELECT count(*) FROM delivered) - (SELECT count(*) FROM (SELECT DISTINCT * FROM delivered)) AS violations)""",
        "enriched_month_stored": f"""
    SELECT {whole(*_TRIP_WHOLE)}, {plain(*_TRIP_TIMES, 'store_and_fwd_flag', *_ZONE_NAMES, 'sunrise', 'sunset')},
        {r6(*_TRIP_DOUBLE, *_WEATHER_ON_TRIP)} FROM enriched
    WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-01' AND tpep_pickup_datetime < TIMESTAMP '2024-02-01'""",
        "dq_weather_rules": _rules(f"({_weather_union()})", _range_rules(_WEATHER_RANGES)),
        "encode_categoricals": f"SELECT {cell}, {whole('PUZone_enc', 'PUBorough_enc', 'trip_count')} FROM coded",
        "known_category_filter": """
    SELECT PUZone, count(*) AS rows, CAST(sum(trip_count) AS BIGINT) AS trips,
        CASE WHEN PUZone IN (SELECT Zone FROM zones WHERE Borough = 'East') AND PUBorough = 'East' THEN 'kept'
            ELSE 'dropped' END AS status
    FROM month_rows WHERE trip_count >= 1 GROUP BY PUZone, PUBorough""",
        "known_category_rows": """
    SELECT PUZone, count(*) AS rows, CAST(sum(trip_count) AS BIGINT) AS trips FROM month_rows
    WHERE trip_count >= 1 AND PUBorough = 'East' AND PUZone IN (SELECT Zone FROM zones WHERE Borough = 'East')
    GROUP BY PUZone""",
        "time_split": f"SELECT {cell}, {whole('trip_count')}, split FROM parts",
        "tip_label": f"SELECT {cell}, split, {r6('tip_rate')}, high_tip_zone FROM labelled",
        "competition_target": f"SELECT {cell}, {r6('competition')} FROM parts",
        "median_impute": f"""
    SELECT {cell}, split, {', '.join(
        d6(f"coalesce({c}, (SELECT median({c}) FROM parts WHERE split = 'train'))") + f" AS {c}" for c in _IMPUTED)}
    FROM parts""",
        "regression_metrics": " UNION ALL ".join(
            f"SELECT split, replace('{name}', '{{}}', split) AS metric, {d6(e)} AS value FROM labelled GROUP BY split"
            for name, e in errors.items()),
        "metric_drift": f"""
    SELECT strftime(run_ts, '%Y%m%d') AS run_id, run_ts, metric, {r6('value', 'previous', 'change_pct')},
        CASE WHEN metric = 'demand_valid_mae' AND change_pct > 15 THEN 'DEGRADED' ELSE 'OK' END AS status
    FROM (SELECT *, (value - previous) / (previous + CAST(1e-9 AS DOUBLE)) * 100 AS change_pct
          FROM (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY run_ts) AS previous
                FROM (SELECT run_ts, 'demand_valid_mae' AS metric, mae AS value FROM ({drift_runs})
                      UNION ALL SELECT run_ts, 'profit_valid_rmse', rmse FROM ({drift_runs}))))""",
        "drift_after_training": f"""
    SELECT 'second' AS run_id, TIMESTAMP '2024-01-02' AS run_ts, metric, {d6('value * 1.2')} AS value, {d6('value')} AS previous,
        {d6('(value * 1.2 - value) / (value + 1e-9) * 100')} AS change_pct,
        CASE WHEN metric = 'demand_valid_mae' AND value > 0 THEN 'DEGRADED' ELSE 'OK' END AS status
    FROM ({' UNION ALL '.join(f"SELECT replace('{name}', '{{}}', split) AS metric, CAST({e} AS DOUBLE) AS value FROM labelled GROUP BY split"
                              for name, e in errors.items())})""",
        "forecast_start": """
    SELECT min(ts_hour) AS data_min_ts_hour, max(ts_hour) AS data_max_ts_hour, count(*) AS history_rows,
        max(ts_hour) + INTERVAL 1 HOUR AS forecast_start FROM history""",
        "future_grid": f"""
    SELECT {cell}, {whole('PUZone_enc', 'PUBorough_enc', *[c for c in _CALENDAR_INT if c != 'year'])}, {r6(*_CYCLIC)} FROM grid""",
        "hist_rolling": f"SELECT {cell}, {whole('trip_count')}, {r6('target_rph', *_FUTURE_ROLLING)} FROM rolled",
        "time_lag_join": f"""
    SELECT g.PUZone, g.PUBorough, g.ts_hour, {', '.join(
        f"CAST(b{k}.{c} AS BIGINT) AS {name}" if name in _AHEAD_WHOLE else f"{d6(f'b{k}.{c}')} AS {name}"
        for name, (k, c) in _AHEAD.items())}
    FROM (SELECT z.PUZone, z.PUBorough, first_hour + to_hours(k) AS ts_hour
          FROM (SELECT DISTINCT PUZone, PUBorough FROM history) z, beginning, range(48) AS steps(k)) g {_lag_joins('g')}""",
        "forecast_derived": f"""
    SELECT {cell}, {whole('trip_count_delta_1h')}, {r6('rph_delta_1h', 'rph_zscore', 'rph_cv', 'relative_zone_activity')}
    FROM ahead_derived""",
        "zone_hour_stats": f"""
    SELECT g.PUZone, g.PUBorough, g.ts_hour, CAST(g.hour AS BIGINT) AS hour,
        {', '.join(f"{d6('z.' + c)} AS {c}" for c in _CLIMATE_ZONE)}, {', '.join(f"{d6('h.' + c)} AS {c}" for c in _CLIMATE_HOUR)}
    FROM grid g
    LEFT JOIN (SELECT PUZone, hour, {', '.join(f'avg({c}) AS {c}' for c in _CLIMATE_ZONE)} FROM history GROUP BY 1, 2) z
        ON z.PUZone = g.PUZone AND z.hour = g.hour
    LEFT JOIN (SELECT hour, {', '.join(f'avg({c}) AS {c}' for c in _CLIMATE_HOUR)} FROM history GROUP BY 1) h ON h.hour = g.hour""",
        "forecast_frame_online": f"""
    SELECT g.PUZone, g.PUBorough, g.ts_hour, {', '.join(
        f"CAST(b{k}.{c} AS BIGINT) AS {name}" if name in _AHEAD_WHOLE else f"{d6(f'b{k}.{c}')} AS {name}"
        for name, (k, c) in _AHEAD.items() if not name.startswith('lag1h_') and name != 'rolling_168h_trip_mean')},
        {', '.join(f"{d6('z.' + c)} AS {c}" for c in _CLIMATE_ZONE)}, {', '.join(f"{d6('h.' + c)} AS {c}" for c in _CLIMATE_HOUR)}
    FROM grid g {_lag_joins('g')}
    LEFT JOIN (SELECT PUZone, hour, {', '.join(f'avg({c}) AS {c}' for c in _CLIMATE_ZONE)} FROM history GROUP BY 1, 2) z
        ON z.PUZone = g.PUZone AND z.hour = g.hour
    LEFT JOIN (SELECT hour, {', '.join(f'avg({c}) AS {c}' for c in _CLIMATE_HOUR)} FROM history GROUP BY 1) h ON h.hour = g.hour""",
        "fill_missing": _filled_select(),
        "fill_missing_from_parts": _filled_select(),
        "forecast_window_check": """
    SELECT first_hour AS expected_first, min(ts_hour) AS actual_first, first_hour + INTERVAL 23 HOUR AS expected_last,
        max(ts_hour) AS actual_last,
        first_hour = min(ts_hour) AND first_hour + INTERVAL 23 HOUR = max(ts_hour) AS ok
    FROM grid, beginning GROUP BY first_hour""",
        "opportunity_score": f"SELECT {cell}, {r6(*_OUTPUT_DOUBLE)} FROM scored",
        "rank_zones": f"SELECT {cell}, {whole(*[f'rank_{s}' for s in _SIGNALS])} FROM ranked",
        "topn_per_hour": f"""
    SELECT {cell}, CAST(rank_opportunity AS BIGINT) AS rank, {r6('opportunity_score')} FROM ranked WHERE rank_opportunity <= 3""",
        "first_hour_top": f"""
    SELECT CAST(rank_opportunity AS BIGINT) AS rank, PUZone, PUBorough,
        {r6('opportunity_score', 'pred_demand', 'pred_rph', 'pred_tip_prob')}
    FROM ranked WHERE ts_hour = (SELECT min(ts_hour) FROM ranked) AND rank_opportunity <= 15""",
        "forecast_output": output,
        "forecast_written_and_read": output,
        "clean_output": f"""
    SELECT ts_hour, PUZone, PUBorough, CAST(rank_opportunity AS BIGINT) AS rank, {', '.join(
        f"round_even({hidden.get(c, c)}, 4) AS {c}" for c in _OUTPUT_DOUBLE)} FROM ranked WHERE rank_opportunity <= 3""",
        "train_forecast_checks": """
    SELECT 'rows' AS check, 24 * count(DISTINCT PUZone) AS found FROM history
    UNION ALL SELECT 'zone hours', 24 * count(DISTINCT PUZone) FROM history UNION ALL SELECT 'hours', 24 UNION ALL SELECT 'ranks outside 1..n', 0 UNION ALL SELECT 'ranks twice in an hour', 0
    UNION ALL SELECT 'scores outside 0..1', 0 UNION ALL SELECT 'better scores ranked lower', 0""",
        "tune_checks": """
    SELECT unnest(['demand', 'profit', 'competition', 'tip']) AS layer, CAST(20 AS BIGINT) AS points, CAST(20 AS BIGINT) AS last_place,
        CAST(0 AS BIGINT) AS outside_ranges, CAST(0 AS BIGINT) AS out_of_order, CAST(0 AS BIGINT) AS without_error""",
        "forecast_run_metadata": """
    SELECT 'hourly_zone_store' AS data_table, strftime(min(ts_hour), '%Y-%m-%d %H:%M:%S') AS data_min_ts_hour,
        strftime(max(ts_hour), '%Y-%m-%d %H:%M:%S') AS data_max_ts_hour,
        strftime(max(ts_hour) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS forecast_start,
        strftime(max(ts_hour) + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') AS forecast_end,
        CAST(24 AS BIGINT) AS forecast_hours, CAST(3 AS BIGINT) AS top_n, 'auto_last_hour_plus_one' AS start_mode
    FROM history""",
        "forecast_summary": """
    SELECT min(ts_hour) AS forecast_start, max(ts_hour) AS forecast_end, CAST(24 AS BIGINT) AS hours, 'profit' AS rank_by,
        count(*) AS row_count FROM ranked WHERE rank_profit <= 3""",
        "zone_hour_view": f"""
    SELECT PUZone, {r6('pred_rph', 'pred_demand', 'pred_competition', 'opportunity_score')}, {whole('shape_id')} FROM view""",
        "zone_kpis": f"""
    SELECT {d6('avg(pred_rph)')} AS avg_rph, {d6('avg(pred_demand)')} AS avg_demand,
        {d6('avg(pred_competition)')} AS avg_competition, {d6('avg(opportunity_score)')} AS avg_opportunity FROM view""",
        "zone_ranking_table": f"""
    SELECT PUZone, {r6('pred_rph', 'pred_demand', 'pred_competition', 'opportunity_score')}, {whole('shape_id')},
        row_number() OVER (ORDER BY round(opportunity_score, 9) DESC, PUZone) AS position FROM view""",
    }


# Queries whose trips are spread over two months: their weather covers those trips.
#: Over trips of which half lie a month earlier, the whole chain.
_MOVED = ("store_by_carried_tails",)
_TWO_MONTHS = ("scan_weather", "weather_payload_rows", "weather_payloads_refused", "weather_payloads_accepted")


def oracle_sql() -> dict[str, str]:
    steps = _steps()
    two_months = {**steps, **_weather("trips2")}
    moved = {**steps, "trips": steps["trips2"], **_weather("trips2")}

    def chain(named: dict[str, str]) -> str:
        return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in named.items())

    return {
        name: f"{chain(two_months if name in _TWO_MONTHS else moved if name in _MOVED else steps)}\n{final}" for name, final in _finals().items()
    }
