"""Forecast of the coming hours from a trained bundle and the hourly store."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Row

from zoneflow.operators.forecast import (
    CORRECTED_LAG_PLAN, HISTORY_ROLLING, LAG_PLAN, ONLINE_LAG_PLAN, assert_forecast_window, check_online_request,
    check_request, fill_missing, future_grid, history_rolling, lag_derived, recent_history,
    start_column, time_lag_join, zone_hour_stats,
)
from zoneflow.operators.prep import encode_categoricals, encoder_labels, known_category_filter
from zoneflow.operators.ranking import forecast_output, forecast_summary, opportunity_score, rank_zones
from zoneflow.operators.store import repeated_cells
from zoneflow.plans.training import ModelBundle, predict, with_model_input
from zoneflow.session import materialize

MODES = ("batch", "online")


def forecast_frame(history: DataFrame, first: Column, hours: int, mode: str = "batch", compat: bool = True
                   ) -> DataFrame:
    """Future rows with every feature that history gives them.

    ``mode`` is the batch job or the online answer, which differ in the lags they know. ``compat=False``
    counts days as training does, ends rolling windows at the last known hour, and computes airport
    activity instead of leaving it to medians.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    grid = future_grid(history, first, hours, compat)
    recent = recent_history(history, first, hours)
    if mode == "online":
        rolled = history_rolling(recent)
        lagged = lag_derived(time_lag_join(grid, rolled, first, hours, ONLINE_LAG_PLAN), weekly_activity=False)
        return zone_hour_stats(lagged, history)
    if compat:
        return lag_derived(time_lag_join(grid, history_rolling(recent), first, hours, LAG_PLAN))
    rolled = history_rolling(recent, (*HISTORY_ROLLING, "rolling_airport_activity"), include_current=True)
    return lag_derived(time_lag_join(grid, rolled, first, hours, CORRECTED_LAG_PLAN))


def generate_forecast(history: DataFrame, bundle: ModelBundle, hours: int = 24, start: dt.datetime | None = None,
                      top: int | None = None, rank_by: str = "opportunity", mode: str = "batch",
                      compat: bool = True, check: bool = False) -> DataFrame:
    """Ranked forecast rows, in no order; ``(zone, hour)`` must be unique in the history.

    The online mode limits the horizon, drops zones that training did not know and cleans unknown values;
    the batch mode takes unknown zones as an error. ``check`` verifies the hours of the result.
    """
    (check_online_request if mode == "online" else check_request)(hours, top, rank_by)
    if mode == "online":
        spark = history.sparkSession
        # Names of the zone lookup's size, as the encoders hold them on the driver.
        labels = {c: spark.createDataFrame([(n,) for n in names], f"{c} string")
                  for c, names in encoder_labels(bundle.encoders).items()}
        history = known_category_filter(history, labels)
    coded = encode_categoricals(history.dropna(subset=["PUZone", "PUBorough"]), bundle.encoders)
    if not repeated_cells(coded).isEmpty():
        raise ValueError("a zone has several rows for one hour; its lags would be ambiguous")
    first = start_column(coded, start)
    frame = fill_missing(forecast_frame(coded, first, hours, mode, compat), coded, bundle.features)
    predicted = predict(with_model_input(frame, bundle.features, bundle.medians), bundle.models)
    # Zones x hours rows, read twice: for the limits of the scores and for the scores.
    predicted = materialize(predicted.drop("raw", "imputed"))
    ranked = rank_zones(opportunity_score(predicted), rank_by)
    if check:
        assert_forecast_window(ranked, first, hours)
    return forecast_output(ranked, top, clean=mode == "online")


def answer_request(history: DataFrame, bundle: ModelBundle, hours: int = 24, start: dt.datetime | None = None,
                   top: int | None = None, rank_by: str = "opportunity") -> tuple[Row, DataFrame]:
    """An online answer: its header row and its rows. ``ValueError`` for a request outside the limits,
    ``LookupError`` when no zone is left to rank."""
    rows = generate_forecast(history, bundle, hours, start, top, rank_by, mode="online")
    header = forecast_summary(rows, hours, rank_by).first()
    if header.row_count == 0:
        raise LookupError("no forecast rows for the requested window")
    return header, rows
