"""Training of the four layers: boosted trees for demand, profit and competition, logistic regression for tip."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from zoneflow.config import SplitConfig
from zoneflow.functions.calendar import ntz
from zoneflow.operators import boosting
from zoneflow.operators.boosting import BoostedTrees, BoostParams, fit_boosted
from zoneflow.operators.prep import (
    competition_target, encode_categoricals, existing, fit_encoders, known_categories, metric_drift, regression_metrics,
    time_split, tip_label,
)
from zoneflow.operators.quantiles import column_medians
from zoneflow.schemas import METRIC_SCHEMA
from zoneflow.session import materialize, work_dir

# Target column of every layer.
TARGETS = {"demand": "trip_count", "profit": "target_rph", "competition": "competition", "tip": "high_tip_zone"}

PREDICTIONS = {"demand": "pred_demand", "profit": "pred_rph", "competition": "pred_competition"}


@dataclass(frozen=True)
class TreeParams:
    trees: int = 100  # the least that a search tries
    learning_rate: float = 0.1
    depth: int = 5
    subsample: float = 0.8
    feature_share: float = 0.8
    #: Of the leaf-wise layers.
    leaves: int = 31

    # Search ranges (fixed values).
    RANGES = {"trees": (100, 800), "learning_rate": (0.01, 0.3), "depth": (3, 10), "leaves": (20, 150), "subsample": (0.5, 1.0),
              "feature_share": (0.5, 1.0)}


@dataclass(frozen=True)
class Style:
    """How a layer's trees grow: leaf by leaf to a number of leaves, or as far as their depth allows."""

    leafwise: bool
    min_rows: int
    l2: float


STYLES = {"demand": Style(True, 20, 0.0), "profit": Style(False, 1, 1.0), "competition": Style(True, 20, 0.0)}


@dataclass(frozen=True)
class TipParams:
    c: float = 1.0
    max_iter: int = 1000

    RANGES = {"c": (1e-3, 1e2)}


@dataclass
class ModelBundle:
    """What a forecast needs: encoders, feature list, train medians, four models."""

    encoders: StringIndexerModel
    features: list[str]
    medians: dict[str, float]
    models: dict[str, Model | BoostedTrees]
    train_rows: int = 0


def with_model_input(df: DataFrame, features: list[str], medians: dict[str, float]) -> DataFrame:
    """What models read of a row: ``raw`` has every feature as it is, NULL included, for the trees; ``imputed`` has the train
    median for NULL, for the tip layer."""
    imputed = [f"coalesce(double({c}), {medians[c]!r}D) AS f_{c}" for c in features]
    wide = df.selectExpr("*", f"array({', '.join(f'double({c})' for c in features)}) AS raw", *imputed)
    values = [f"f_{c}" for c in features]
    return VectorAssembler(inputCols=values, outputCol="imputed").transform(wide).drop(*values)


def training_frame(store: DataFrame, split: SplitConfig = SplitConfig()
                   ) -> tuple[DataFrame, StringIndexerModel, list[str]]:
    """Encoded, labelled, split rows with the competition target. The store's rows are written once: encoders, cutoffs and
    the rows themselves are passes of their own, and each would build a store that is not a table from its trips again."""
    known = materialize(known_categories(store))
    encoders = fit_encoders(known)
    coded = encode_categoricals(known, encoders).withColumn("competition", competition_target())
    parts = tip_label(time_split(coded, split))
    return parts, encoders, existing(parts)


def boost_params(layer: str, params: TreeParams, seed: int) -> BoostParams:
    style = STYLES[layer]
    return BoostParams(
        trees=params.trees, learning_rate=params.learning_rate, leaves=params.leaves if style.leafwise else 2 ** params.depth, depth=params.depth,
        subsample=params.subsample, feature_share=params.feature_share, min_rows=style.min_rows, l2=style.l2, seed=seed)


def row_key():
    """Tells rows apart, however they are partitioned."""
    return F.xxhash64("PUZone", "ts_hour")


def _classifier(params: TipParams, rows: int) -> LogisticRegression:
    return LogisticRegression(
        labelCol="high_tip_zone", featuresCol="imputed", maxIter=params.max_iter,
        regParam=1.0 / (params.c * max(rows, 1)),
    )


def _medians(train: DataFrame, features: list[str]) -> dict[str, float]:
    """Train medians, one number per feature; a feature without any value gets 0."""
    row = column_medians(train, features).first()
    return {c: (row[c] if row is not None and row[c] is not None else 0.0) for c in features}


def prepare(store: DataFrame, split: SplitConfig = SplitConfig()
            ) -> tuple[DataFrame, StringIndexerModel, list[str], dict[str, float]]:
    """The feature frame, written once: four fits and their metrics read it many times."""
    parts, encoders, features = training_frame(store, split)
    parts = materialize(parts)
    medians = _medians(parts.filter(F.col("split") == "train"), features)
    return with_model_input(parts, features, medians), encoders, features, medians


def _side_by_side(spark: SparkSession, task: Callable, items: Iterable, at_once: int) -> list:
    """Run driver-side chains of Spark jobs at the same time; one chain alone leaves executors idle."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(task), items))


def fit_models(frame: DataFrame, features: list[str], trees: dict[str, TreeParams] | None = None, tip: TipParams = TipParams(),
               seed: int = 42) -> tuple[dict[str, Model | BoostedTrees], int]:
    """The four fits: the tree layers in shared passes over binned rows, the tip layer beside them."""
    trees = trees or {}
    spark = frame.sparkSession

    def fit_trees() -> dict[str, BoostedTrees]:
        return fit_boosted(frame, features, {layer: (TARGETS[layer], boost_params(layer, trees.get(layer, TreeParams()), seed))
                                             for layer in PREDICTIONS}, key=row_key())

    def fit_tip() -> tuple[LogisticRegressionModel, int]:
        train = frame.filter(F.col("split") == "train").select("imputed", "high_tip_zone").persist()
        try:
            rows = train.count()
            fitted = _classifier(tip, rows).fit(train)
        finally:
            train.unpersist()
        # A fitted model holds a summary, which holds the session, and a prediction would ship both; a saved one does not.
        path = f"{work_dir(spark)}/tip"
        fitted.write().save(path)
        return LogisticRegressionModel.load(path), rows

    models, (tip_model, rows) = _side_by_side(spark, lambda fit: fit(), [fit_trees, fit_tip], 2)
    return {**models, "tip": tip_model}, rows


def predict(df: DataFrame, models: dict[str, Model | BoostedTrees]) -> DataFrame:
    """Four predictions per row of a frame that has the models' input."""
    df = df.withColumns({column: models[layer].prediction("raw") for layer, column in PREDICTIONS.items()})
    scored = models["tip"].transform(df).withColumn("pred_tip_prob", vector_to_array("probability")[1])
    return scored.withColumnRenamed("prediction", "pred_tip").drop("rawPrediction", "probability")


def train_models(store: DataFrame, trees: dict[str, TreeParams] | None = None, tip: TipParams = TipParams(),
                 split: SplitConfig = SplitConfig(), seed: int = 42) -> tuple[ModelBundle, DataFrame]:
    """Fit the four layers and measure them on train, valid and test."""
    frame, encoders, features, medians = prepare(store, split)
    models, rows = fit_models(frame, features, trees, tip, seed)
    metrics = regression_metrics(predict(frame, models))
    return ModelBundle(encoders, features, medians, models, rows), metrics


def train_tuned(store: DataFrame, trials: int = 20, split: SplitConfig = SplitConfig(), seed: int = 42,
                max_trees: int | None = None) -> tuple[ModelBundle, DataFrame, dict[str, TreeParams | TipParams]]:
    """Search each layer's parameters, then fit the four layers with the best on all rows. The frame is prepared once."""
    frame, encoders, features, medians = prepare(store, split)
    best = {layer: tried[0][0] for layer, tried in search_layers(frame, features, trials, seed, max_trees).items()}
    models, rows = fit_models(frame, features, {layer: best[layer] for layer in PREDICTIONS}, best["tip"], seed)
    metrics = regression_metrics(predict(frame, models))
    return ModelBundle(encoders, features, medians, models, rows), metrics, best


def metric_history(metrics: DataFrame, run_id: str, run_ts: dt.datetime) -> DataFrame:
    """Metrics of a run as rows of the metric table that drift is computed on."""
    stamped = {"run_id": F.lit(run_id), "run_ts": ntz(run_ts)}
    return metrics.withColumns(stamped).select(*METRIC_SCHEMA.names)


def record_metrics(metrics: DataFrame, path: str, run_id: str, run_ts: dt.datetime) -> DataFrame:
    """Append a run's metrics to the metric table at ``path`` and compare them with the run before: the drift rows of this
    run. A degraded run is reported, not refused."""
    metric_history(metrics, run_id, run_ts).write.mode("append").parquet(path)
    history = metrics.sparkSession.read.schema(METRIC_SCHEMA).parquet(path)
    return metric_drift(history).filter(F.col("run_id") == run_id)


def train_and_record(store: DataFrame, path: str, run_id: str, run_ts: dt.datetime, **options) -> tuple[ModelBundle, DataFrame]:
    """:func:`train_models`, with its metrics recorded: the bundle and the run's drift rows."""
    bundle, metrics = train_models(store, **options)
    return bundle, record_metrics(metrics, path, run_id, run_ts)


def save_bundle(bundle: ModelBundle, path: str) -> None:
    """Encoders and models with their Spark ML writers, the rest as a one-row JSON table."""
    spark = SparkSession.active()
    bundle.encoders.write().overwrite().save(f"{path}/encoders")
    for layer in PREDICTIONS:
        bundle.models[layer].save(f"{path}/models/{layer}")
    bundle.models["tip"].write().overwrite().save(f"{path}/models/tip")
    row = (bundle.features, [bundle.medians[c] for c in bundle.features], bundle.train_rows)
    metadata = spark.createDataFrame([row], "features array<string>, medians array<double>, train_rows bigint")
    metadata.write.mode("overwrite").json(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str) -> ModelBundle:
    schema = "features array<string>, medians array<double>, train_rows bigint"
    row = spark.read.schema(schema).json(f"{path}/metadata").first()
    models = {layer: BoostedTrees.load(spark, f"{path}/models/{layer}") for layer in PREDICTIONS}
    models["tip"] = LogisticRegressionModel.load(f"{path}/models/tip")
    encoders = StringIndexerModel.load(f"{path}/encoders")
    return ModelBundle(encoders, list(row.features), dict(zip(row.features, row.medians)), models, row.train_rows)


def search_layers(frame: DataFrame, features: list[str], trials: int = 20, seed: int = 42, max_trees: int | None = None
                  ) -> dict[str, list[tuple[TreeParams | TipParams, float]]]:
    """Every layer's points with their valid error, best first; the three tree layers try the same points."""
    points = draw_trees(trials, seed, max_trees)
    both = _side_by_side(frame.sparkSession, lambda search: search(), [
        lambda: tune_trees(frame, features, list(PREDICTIONS), points, seed), lambda: {"tip": tune_tip(frame, draw_tips(trials, seed))}], 2)
    return {**both[0], **both[1]}


def draw_trees(n: int, seed: int, max_trees: int | None = None) -> list[TreeParams]:
    """Random points of the search space; the learning rate is drawn on a log scale. ``trees`` is the most that a point may
    grow, as its error is known after each tree: the end of the range, or ``max_trees``."""
    rng = random.Random(seed)
    ranges = TreeParams.RANGES
    return [TreeParams(
        trees=min(ranges["trees"][1], max_trees or ranges["trees"][1]),
        learning_rate=math.exp(rng.uniform(*map(math.log, ranges["learning_rate"]))),
        depth=rng.randint(*ranges["depth"]),
        subsample=rng.uniform(*ranges["subsample"]),
        feature_share=rng.uniform(*ranges["feature_share"]),
        leaves=rng.randint(*ranges["leaves"]),
    ) for _ in range(n)]


def draw_tips(n: int, seed: int) -> list[TipParams]:
    rng = random.Random(seed)
    return [TipParams(c=math.exp(rng.uniform(*map(math.log, TipParams.RANGES["c"])))) for _ in range(n)]


def _best_first(tried: Iterable[tuple]) -> list[tuple]:
    return sorted(tried, key=lambda point: math.inf if point[1] is None else point[1])


def search_sample(frame: DataFrame, rows: int) -> DataFrame:
    """All train and valid rows where they are no more than ``rows`` each, else about so many of each, by a hash. For a caller's
    own trials: the search here reads all rows."""
    counts = {r["split"]: r["n"] for r in frame.groupBy("split").agg(F.count("*").alias("n")).collect()}
    place = F.xxhash64("PUZone", "ts_hour", F.lit("search")) / F.lit(2.0 ** 64) + 0.5
    share = {part: min(1.0, rows / max(1, counts.get(part, 0))) for part in ("train", "valid")}
    return frame.filter(F.col("split").isin("train", "valid") & (place < F.when(F.col("split") == "train", share["train"]).otherwise(share["valid"])))


def tune_trees(frame: DataFrame, features: list[str], layers: list[str], points: list[TreeParams], seed: int = 42
               ) -> dict[str, list[tuple[TreeParams, float]]]:
    """Points of every layer with their valid mean absolute error, best first; ``trees`` of a point is its best number.

    A fit's error is known after every tree, so the numbers of trees of a point cost one fit. Every point of every layer is fitted
    on all train rows up to its last tree and measured on all valid rows; no point is dropped or ends before. The chronological valid
    part is used as it is, never a random one.
    """
    rows = frame.filter(F.col("split").isin("train", "valid"))
    prepared = boosting.frame_of(rows, features, [TARGETS[layer] for layer in layers], key=row_key())
    models = [(i, boost_params(layer, p, seed)) for i, layer in enumerate(layers) for p in points]
    errors = boosting.staged_errors(prepared, len(features), models)
    least = min(TreeParams.RANGES["trees"][0], min(p.trees for p in points))
    found = {}
    for i, layer in enumerate(layers):
        own = errors[i * len(points):(i + 1) * len(points)]
        staged = [(p, *_staged(e, least)) for p, e in zip(points, own)]
        found[layer] = _best_first((replace(p, trees=count), error) for p, count, error in staged)
    return found


def _staged(errors: list[float], least: int) -> tuple[int, float]:
    """The best number of trees from ``least`` on, and its error; a fit that ended before has its last."""
    least = min(least, len(errors) - 1)
    known = [(math.inf if math.isnan(e) else e, n) for n, e in enumerate(errors) if n >= least]
    error, count = min(known)
    return count, error


def tune_tip(frame: DataFrame, points: list[TipParams], at_once: int = 4) -> list[tuple[TipParams, float]]:
    """1 - valid accuracy of every point, best first."""
    train = frame.filter(F.col("split") == "train").persist()
    valid = frame.filter(F.col("split") == "valid")
    wrong = F.avg((F.col("prediction") != F.col("high_tip_zone")).cast("double"))
    try:
        rows = train.count()

        def attempt(params: TipParams) -> tuple[TipParams, float]:
            return params, _classifier(params, rows).fit(train).transform(valid).agg(wrong).first()[0]

        return _best_first(_side_by_side(frame.sparkSession, attempt, points, at_once))
    finally:
        train.unpersist()
