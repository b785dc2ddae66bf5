"""Scores, ranks, output and request summary of a forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.config import FORECAST_COLUMNS, RANK_SIGNALS, SCORE_WEIGHTS
from zoneflow.functions.calendar import plus_hours, with_sql
from zoneflow.functions.scalar import finite_or_zero, scaled_sql

# Score -> (prediction it scales, whether a small prediction is good).
SCORES = {
    "demand": ("pred_demand", False),
    "profit": ("pred_rph", False),
    "competition": ("pred_competition", True),
    "tip": ("pred_tip_prob", False),
}


def opportunity_score(predicted: DataFrame) -> DataFrame:
    """Each prediction scaled to 0..1 over the whole horizon, and their weighted sum.

    The limits come from one aggregation, read as a one-row scalar subquery: no unpartitioned window,
    no join.
    """
    limits = predicted.agg(F.struct(*[
        F.expr(f"{end}({pred}) AS {name}_{end}") for name, (pred, _) in SCORES.items() for end in ("min", "max")
    ])).scalar()

    def score(name: str, pred: str, small_is_good: bool) -> str:
        share = scaled_sql(pred, f"_limits.{name}_min", f"_limits.{name}_max")
        return f"1 - {share}" if small_is_good else share

    scored = with_sql(predicted.withColumn("_limits", limits), {
        f"score_{name}": score(name, *spec) for name, spec in SCORES.items()})
    weighted = " + ".join(f"{w}D * score_{name}" for name, w in SCORE_WEIGHTS.items())
    return with_sql(scored.drop("_limits"), {"opportunity_score": weighted})


def rank_order(rank_by: str) -> list[Column]:
    """Best first; equal values by zone. Nine decimals are compared, so that rounding noise of a
    different summation order cannot swap two zones."""
    value = F.round(RANK_SIGNALS[rank_by], 9)
    return [value.asc_nulls_last() if rank_by == "competition" else value.desc_nulls_last(),
            F.col("PUZone").asc_nulls_last(), F.col("PUBorough").asc_nulls_last()]


def rank_zones(scored: DataFrame, rank_by: str = "opportunity") -> DataFrame:
    """Rank 1..n within every hour. A partition holds the zones of one hour."""
    if rank_by not in RANK_SIGNALS:
        raise ValueError(f"no signal to rank by among {list(RANK_SIGNALS)}, got {rank_by!r}")
    hour = Window.partitionBy("ts_hour").orderBy(*rank_order(rank_by))
    return scored.withColumn("rank", F.row_number().over(hour))


def topn_per_hour(ranked: DataFrame, n: int | None) -> DataFrame:
    return ranked if n is None else ranked.filter(F.col("rank") <= n)


def first_hour_top(ranked: DataFrame, n: int = 15) -> DataFrame:
    first = ranked.agg(F.min("ts_hour")).scalar()
    return ranked.filter(F.col("ts_hour") == first).orderBy("rank").limit(n)


def forecast_output(ranked: DataFrame, top: int | None = None, clean: bool = False) -> DataFrame:
    """The output columns, measures at four decimals (ties to even). ``clean`` also turns unknown and
    infinite measures into 0, as the online answer does."""
    kept = topn_per_hour(ranked, top)
    doubles = {f.name for f in kept.schema if f.dataType.typeName() in ("double", "float")}

    def shown(c: str) -> Column:
        if c not in doubles:
            return F.col(c)
        rounded = F.bround(c, 4)
        return (finite_or_zero(rounded) if clean else rounded).alias(c)

    return kept.select(*[shown(c) for c in FORECAST_COLUMNS if c in kept.columns])


def forecast_run_metadata(history: DataFrame, first: Column, hours: int, top: int | None, manual: bool,
                          table: str) -> DataFrame:
    """One row of facts about a run, for the JSON file beside its output."""
    last = plus_hours(first, hours - 1)
    return history.agg(
        F.min("ts_hour").alias("data_min_ts_hour"), F.max("ts_hour").alias("data_max_ts_hour")
    ).select(
        F.lit(table).alias("data_table"),
        F.col("data_min_ts_hour").cast("string").alias("data_min_ts_hour"),
        F.col("data_max_ts_hour").cast("string").alias("data_max_ts_hour"),
        first.cast("string").alias("forecast_start"),
        last.cast("string").alias("forecast_end"),
        F.lit(hours).alias("forecast_hours"),
        F.lit(top).cast("int").alias("top_n"),
        F.lit("manual" if manual else "auto_last_hour_plus_one").alias("start_mode"),
    )


def forecast_summary(output: DataFrame, hours: int, rank_by: str) -> DataFrame:
    """Header of an online answer."""
    return output.agg(
        F.min("ts_hour").alias("forecast_start"),
        F.max("ts_hour").alias("forecast_end"),
        F.lit(hours).alias("hours"),
        F.lit(rank_by).alias("rank_by"),
        F.count("*").alias("row_count"),
    )
