"""Settings of the feature store and of the forecast ranker.

Everything a job may want to vary is a field of a frozen dataclass; the constants below are
fixed values that results depend on.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field

# --- Fixed values: names, ranges and weights that results must agree on -----------------------

AIRPORT_ZONES = ("JFK Airport", "LaGuardia Airport", "Newark Airport")

# Inclusive limits of a usable trip.
TRIP_LIMITS = {
    "trip_duration_min": (2.0, 180.0),
    "trip_distance": (0.1, 100.0),
    "revenue": (3.0, 500.0),
    "revenue_per_hour": (5.0, 500.0),
}

SCORE_WEIGHTS = {"demand": 0.35, "profit": 0.35, "competition": 0.20, "tip": 0.10}

# Ranking signal -> column it ranks by. Only competition ranks the smallest first.
RANK_SIGNALS = {
    "demand": "pred_demand",
    "profit": "pred_rph",
    "competition": "pred_competition",
    "tip": "pred_tip_prob",
    "opportunity": "opportunity_score",
}

# Same-hour measures a model may only see one hour late, under the prefix "lag1h_".
SAME_HOUR_MEASURES = (
    "frac_airport_pickup", "frac_airport_dropoff",
    "precipitation", "temperature", "wind_speed", "frac_raining",
    "demand_vs_baseline", "dropoff_count", "net_pickup_flow",
    "avg_revenue", "avg_tip", "tip_rate",
    "avg_distance_mi", "avg_duration_min", "avg_speed_mph", "congestion_score",
)

FEATURES = (
    "PUZone_enc", "PUBorough_enc",
    "hour", "day_of_week", "week_of_year", "month", "quarter", "day_of_year",
    "is_weekend", "is_rush", "is_night",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "lag1h_precipitation", "lag1h_temperature", "lag1h_wind_speed", "lag1h_frac_raining",
    "lag1h_frac_airport_pickup", "lag1h_frac_airport_dropoff",
    "rolling_airport_activity",
    "lag_1h_trip_count", "lag_24h_trip_count",
    "rolling_24h_trip_mean", "trip_count_delta_1h",
    "lag1h_demand_vs_baseline",
    "lag_1h_rph", "lag_2h_rph", "lag_24h_rph", "lag_168h_rph",
    "rolling_24h_rph_mean", "rolling_7d_rph_mean", "rolling_24h_rph_std",
    "rph_delta_1h", "rph_zscore", "rph_cv",
    "lag1h_dropoff_count", "lag1h_net_pickup_flow",
    "lag1h_avg_revenue", "lag1h_avg_tip", "lag1h_tip_rate",
    "lag1h_avg_distance_mi", "lag1h_avg_duration_min", "lag1h_avg_speed_mph",
    "lag1h_congestion_score",
    "relative_zone_activity",
)

FORECAST_COLUMNS = (
    "ts_hour", "PUZone", "PUBorough", "rank", "opportunity_score",
    "pred_demand", "pred_rph", "pred_competition", "pred_tip_prob",
    "score_demand", "score_profit", "score_competition", "score_tip",
)

# Store columns averaged per (zone, hour of day) and per hour of day by the online forecast.
ZONE_HOUR_MEANS = (
    "avg_revenue", "avg_tip", "tip_rate", "avg_distance_mi", "avg_duration_min", "avg_speed_mph",
    "congestion_score", "frac_airport_pickup", "frac_airport_dropoff", "rolling_airport_activity",
    "dropoff_count", "net_pickup_flow", "demand_vs_baseline", "relative_zone_activity",
    "median_rph", "p75_rph", "pickup_dropoff_ratio",
)
HOUR_WEATHER_MEANS = (
    "precipitation", "temperature", "wind_speed", "is_raining", "is_cold", "is_hot",
    "frac_raining", "precipitation_delta",
)

PREVIEW_COLUMNS = (
    "PUZone", "ts_hour", "trip_count", "dropoff_count", "net_pickup_flow", "target_rph", "lag_1h_rph",
    "rolling_24h_rph_mean", "pickup_dropoff_ratio", "avg_speed_mph", "congestion_score", "rph_zscore",
    "rph_cv", "precipitation", "temperature",
)

MAX_HORIZON_HOURS = 168
DEGRADED_PCT = 15.0
KEEP_MONTHS = 12

# ------------------------------------------------------------------------------------------------

_MONTH = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


def parse_month(month: str) -> dt.date:
    """First day of a ``YYYY-MM`` month; raises ``ValueError`` for anything else."""
    if not _MONTH.fullmatch(month):
        raise ValueError(f"month must look like YYYY-MM, got {month!r}")
    return dt.date(int(month[:4]), int(month[5:]), 1)


def add_months(first: dt.date, n: int) -> dt.date:
    years, zero_based = divmod(first.year * 12 + first.month - 1 + n, 12)
    return dt.date(years, zero_based + 1, 1)


def resolve_month(requested: str | None, today: dt.date) -> str:
    """The month a job works on: the requested one, or the calendar month before ``today``."""
    text = (requested or "").strip()
    if text and text.upper() != "YYYY-MM":
        return parse_month(text).strftime("%Y-%m")
    return add_months(today.replace(day=1), -1).strftime("%Y-%m")


@dataclass(frozen=True)
class MonthWindow:
    """A target month and the history before it that its windows look back on."""

    month: str
    lookback_months: int = 1

    @property
    def start(self) -> dt.date:
        return parse_month(self.month)

    @property
    def end(self) -> dt.date:
        return add_months(self.start, 1)

    @property
    def buffer_start(self) -> dt.date:
        return add_months(self.start, -self.lookback_months)

    @property
    def months(self) -> list[str]:
        """Every month the window reads, oldest first."""
        return [add_months(self.buffer_start, i).strftime("%Y-%m") for i in range(self.lookback_months + 1)]

    @property
    def hours(self) -> int:
        return (self.end - self.buffer_start).days * 24


@dataclass(frozen=True)
class StoreConfig:
    """How the hourly store is built.

    ``lag_mode``: "row" steps over the hours a zone has rows for, "time" over clock hours.
    ``compat``: True keeps the known train/forecast differences (see README); False removes them.
    """

    min_trips: int = 5
    lookback_months: int = 1
    lag_mode: str = "row"
    compat: bool = True
    airport_zones: tuple[str, ...] = AIRPORT_ZONES
    limits: dict = field(default_factory=lambda: dict(TRIP_LIMITS))

    def __post_init__(self) -> None:
        if self.lag_mode not in ("row", "time"):
            raise ValueError(f"lag_mode must be 'row' or 'time', got {self.lag_mode!r}")


@dataclass(frozen=True)
class SplitConfig:
    train_ratio: float = 0.70
    valid_ratio: float = 0.15
