"""Training preparation: encoding, chronological split, labels and targets, imputation, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.config import DEGRADED_PCT, FEATURES, SplitConfig
from zoneflow.functions.calendar import with_sql
from zoneflow.operators.quantiles import column_medians, exact_quantiles

CATEGORIES = {"PUZone": "PUZone_enc", "PUBorough": "PUBorough_enc"}


def known_categories(df: DataFrame) -> DataFrame:
    """Rows with a zone and a borough. An encoder has no place for NULL."""
    return df.dropna(subset=list(CATEGORIES))


def fit_encoders(df: DataFrame) -> StringIndexerModel:
    """Index of every zone and borough in the sorted order of their names."""
    indexer = StringIndexer(
        inputCols=list(CATEGORIES), outputCols=list(CATEGORIES.values()),
        stringOrderType="alphabetAsc", handleInvalid="error",
    )
    return indexer.fit(df)


def encode_categoricals(df: DataFrame, encoders: StringIndexerModel) -> DataFrame:
    """Adds the integer codes; a name the encoders do not know is an error."""
    coded = encoders.transform(df)
    return coded.withColumns({c: F.col(c).cast("int") for c in CATEGORIES.values()})


def encoder_labels(encoders: StringIndexerModel) -> dict[str, list[str]]:
    return dict(zip(CATEGORIES, encoders.labelsArray))


def split_known(df: DataFrame, labels: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Rows whose categories are all among the labels, and the other rows.

    ``labels`` gives, per column, a one-column frame of known names; the sides are dimensions, so Spark's
    size check broadcasts them. One flag per row decides, so the two parts are a partition of ``df``.
    """
    flagged = flag_known(df, labels)
    return flagged.filter("_known").drop("_known"), flagged.filter("NOT _known").drop("_known")


def flag_known(df: DataFrame, labels: dict[str, DataFrame]) -> DataFrame:
    """``df`` with ``_known``: whether all its categories are among the labels."""
    flagged, flags = df, []
    for column, names in labels.items():
        flags.append(f"_known_{column}")
        side = names.select(F.col(column).alias("_label"), F.lit(True).alias(flags[-1])).distinct()
        flagged = flagged.join(side, F.col(column) == F.col("_label"), "left").drop("_label")
    known = F.lit(True)
    for flag in flags:
        known &= F.coalesce(F.col(flag), F.lit(False))
    return flagged.withColumn("_known", known).drop(*flags)


def known_category_filter(df: DataFrame, labels: dict[str, DataFrame]) -> DataFrame:
    """Rows whose categories the labels know, as semi joins: nothing is added to the row."""
    for column, names in labels.items():
        df = df.join(names.select(column), column, "left_semi")
    return df


def _cutoffs(df: DataFrame, split: SplitConfig) -> DataFrame:
    """One row: for both cutoffs the hour they fall into and the number of rows before that hour."""
    per_hour = df.groupBy("ts_hour").agg(F.count("*").alias("c"))
    # Unpartitioned, but over distinct hours only (8,760 a year), never over rows.
    running = per_hour.withColumn("upto", F.sum("c").over(Window.orderBy("ts_hour"))).withColumn(
        "n", F.sum("c").over(Window.orderBy("ts_hour").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)))
    n = F.col("n")
    train_end = F.floor(n * F.lit(split.train_ratio))
    valid_end = train_end + F.floor(n * F.lit(split.valid_ratio))
    picks = []
    for name, end in (("train", train_end), ("valid", valid_end)):
        holds = (F.col("upto") - F.col("c") < end) & (end <= F.col("upto"))
        picks += [
            F.max(F.when(holds, F.col("ts_hour"))).alias(f"{name}_hour"),
            F.max(F.when(holds, end - F.col("upto") + F.col("c"))).alias(f"{name}_take"),
        ]
    return running.agg(*picks)


def time_split(df: DataFrame, split: SplitConfig = SplitConfig(), order: Sequence[str] = ("PUZone", "PUBorough")
               ) -> DataFrame:
    """Adds ``split``: the first 70 % of the rows by hour are train, the next 15 % valid, the rest test.

    Rows are not sorted or shuffled: the hour alone decides, except in the two hours that a cutoff falls
    into, whose rows are numbered by zone.
    """
    cut = _cutoffs(df, split).select(F.struct("*")).scalar()
    placed = df.withColumn("_cut", cut)

    # A cutoff at 0 rows has no hour: comparing with it is unknown, and nothing lies before it.
    def before(cutoff: str, numbered: bool) -> str:
        return f"ts_hour < _cut.{cutoff}_hour" + (
            f" OR (ts_hour = _cut.{cutoff}_hour AND _row <= _cut.{cutoff}_take)" if numbered else "")

    def label(numbered: bool) -> str:
        return (f"CASE WHEN {before('train', numbered)} THEN 'train' WHEN {before('valid', numbered)} THEN 'valid' "
                "ELSE 'test' END AS split")

    edge = "coalesce(ts_hour = _cut.train_hour, false) OR coalesce(ts_hour = _cut.valid_hour, false)"
    inside = placed.filter(f"NOT ({edge})").selectExpr("*", label(numbered=False))
    by_name = Window.partitionBy("ts_hour").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    on_edge = placed.filter(edge).withColumn("_row", F.row_number().over(by_name)).selectExpr("*", label(numbered=True))
    return inside.unionByName(on_edge.drop("_row")).drop("_cut")


def tip_label(parts: DataFrame) -> DataFrame:
    """Adds ``high_tip_zone``: tip rate (unknown = 0) above the median of the train part."""
    filled = parts.withColumn("tip_rate", F.coalesce("tip_rate", F.lit(0.0)))
    train = filled.filter(F.col("split") == "train")
    median = exact_quantiles(train, [], "tip_rate", {"m": 0.5}, 0.0, 1.0).scalar()
    return filled.withColumn("high_tip_zone", F.when(F.col("tip_rate") > median, 1).otherwise(0))


def competition_target() -> Column:
    parts = ("lag_1h_trip_count", "rolling_24h_rph_std", "congestion_score")
    return F.expr(" + ".join(f"coalesce(double({c}), 0D)" for c in parts))


def existing(df: DataFrame, names: Sequence[str] = FEATURES) -> list[str]:
    """The listed columns that the frame has, in list order."""
    return [c for c in names if c in df.columns]


def median_impute(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs of ``columns`` become the exact median of the train part, in every part."""
    medians = column_medians(parts.filter(F.col("split") == "train"), columns)
    known = parts.withColumn("_train", medians.select(F.struct(*columns)).scalar())
    return with_sql(known, {c: f"coalesce(double({c}), _train.{c})" for c in columns}).drop("_train")


# Layer -> (metric, target, prediction).
LAYERS = {
    "demand": ("mae", "trip_count", "pred_demand"),
    "profit": ("rmse", "target_rph", "pred_rph"),
    "competition": ("rmse", "competition", "pred_competition"),
    "tip": ("accuracy", "high_tip_zone", "pred_tip"),
}


def regression_metrics(scored: DataFrame) -> DataFrame:
    """One row per layer and split: mean absolute error, root mean squared error or accuracy, in one
    pass over the scored rows."""
    def measure(kind: str, target: str, predicted: str) -> Column:
        error = F.col(target) - F.col(predicted)
        return {
            "mae": lambda: F.avg(F.abs(error)),
            "rmse": lambda: F.sqrt(F.avg(error * error)),
            "accuracy": lambda: F.avg(F.when(F.col(target) == F.col(predicted), 1.0).otherwise(0.0)),
        }[kind]()

    wide = scored.groupBy("split").agg(*[measure(*spec).alias(layer) for layer, spec in LAYERS.items()])
    rows = [
        F.struct(F.concat(F.lit(f"{layer}_"), F.col("split"), F.lit(f"_{kind}")).alias("metric"),
                 F.col(layer).alias("value"))
        for layer, (kind, _, _) in LAYERS.items()
    ]
    return wide.select("split", F.inline(F.array(*rows)))


def metric_drift(history: DataFrame, watched: str = "demand_valid_mae", limit_pct: float = DEGRADED_PCT) -> DataFrame:
    """Change of every metric against the run before, in percent. The watched metric is DEGRADED when it
    grew by more than the limit; a degraded run is reported, not blocked."""
    by_run = Window.partitionBy("metric").orderBy("run_ts", "run_id")
    previous = F.lag("value").over(by_run)
    change = F.when(previous != -1e-9, (F.col("value") - previous) / (previous + 1e-9) * 100.0)
    worse = (F.col("metric") == watched) & (F.col("change_pct") > limit_pct)
    return history.withColumns({"previous": previous, "change_pct": change}).withColumn(
        "status", F.when(worse, "DEGRADED").otherwise("OK"))
