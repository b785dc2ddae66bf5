"""Tables of the forecast view: one hour by zone, headline means, ranking."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.functions.calendar import ntz

VIEW_MEASURES = ("pred_rph", "pred_demand", "pred_competition", "opportunity_score")


def forecast_hours(forecast: DataFrame) -> DataFrame:
    """The hours one can choose from, in order."""
    return forecast.select("ts_hour").distinct().orderBy("ts_hour")


def zone_hour_view(forecast: DataFrame, hour: dt.datetime | None = None, shapes: DataFrame | None = None
                   ) -> DataFrame:
    """Mean predictions per zone in one hour, by default the last. ``shapes`` adds the attributes of a
    zone table by zone name; zones without shape stay."""
    at = ntz(hour) if hour is not None else forecast.agg(F.max("ts_hour")).scalar()
    rows = forecast.filter(F.col("ts_hour") == at).dropna(subset=["PUZone"])
    # Names are trimmed after grouping: two spellings stay two rows.
    view = rows.groupBy("PUZone").agg(*[F.avg(m).alias(m) for m in VIEW_MEASURES])
    view = view.withColumn("PUZone", F.trim("PUZone"))
    return view if shapes is None else view.join(shapes, "PUZone", "left")


def zone_kpis(view: DataFrame) -> DataFrame:
    """Means over zones of the zone means."""
    names = {"pred_rph": "avg_rph", "pred_demand": "avg_demand", "pred_competition": "avg_competition",
             "opportunity_score": "avg_opportunity"}
    return view.agg(*[F.avg(m).alias(name) for m, name in names.items()])


def zone_ranking_table(view: DataFrame) -> DataFrame:
    """Zones by opportunity, numbered from 1. The table holds one row per zone, so its one-partition
    window is bounded by the zone lookup."""
    order = [F.round("opportunity_score", 9).desc_nulls_last(), F.col("PUZone").asc()]
    return view.withColumn("position", F.row_number().over(Window.orderBy(*order)))
