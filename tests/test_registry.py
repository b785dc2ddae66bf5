"""The model registry: whole bundles, promotion, going back."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from zoneflow.plans import forecasting, registry, training
from zoneflow.session import work_dir


@pytest.fixture
def history(make_cells):
    from zoneflow.config import StoreConfig
    from zoneflow.operators.hourly import store_features

    rows = [(z, h, 10 + h % 24 + i, 40.0 + (h % 24) * 2 + i) for i, z in enumerate("AB") for h in range(216)]
    return store_features(make_cells(rows), StoreConfig())


QUICK = {layer: training.TreeParams(trees=2, depth=2) for layer in training.PREDICTIONS}


def test_runs_are_registered_promoted_and_taken_back(spark, history):
    models = registry.ModelRegistry(spark, work_dir(spark))
    with pytest.raises(LookupError):
        models.promoted()
    bundle, metrics = training.train_models(history, QUICK, training.TipParams(max_iter=5))
    first = models.register(bundle, metrics, "a", dt.datetime(2024, 1, 1))
    assert {r.previous for r in first.collect()} == {None} and models.runs() == ["a"]
    with pytest.raises(LookupError):
        models.load()
    assert models.promote("a", first) == 1

    worse = metrics.withColumn("value", F.col("value") * 2)
    drift = models.register(bundle, worse, "b", dt.datetime(2024, 1, 2))
    assert [r.metric for r in drift.filter("status = 'DEGRADED'").collect()] == ["demand_valid_mae"]
    with pytest.raises(registry.DegradedModel):
        models.promote("b", drift, refuse_degraded=True)
    assert models.promoted() == "a"
    models.promote("b", drift)
    models.register(bundle, metrics, "c", dt.datetime(2024, 1, 3))
    models.promote("c")
    assert [models.roll_back(), models.roll_back()] == ["b", "a"] and models.promoted() == "a"
    with pytest.raises(LookupError):
        models.roll_back()
    assert [tuple(r) for r in models.history().orderBy("number").collect()] == [
        (1, "a", "promote", False), (2, "b", "promote", True), (3, "c", "promote", False), (4, "b", "roll back", False), (5, "a", "roll back", False)]
    assert models.metrics().select("run_id").distinct().count() == 3

    rows = forecasting.generate_forecast(history, models.load(), hours=2).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, forecasting.generate_forecast(history, bundle, hours=2).collect()))


def test_a_run_that_fails_is_not_registered_and_may_come_again(spark, history, monkeypatch):
    models = registry.ModelRegistry(spark, work_dir(spark))
    bundle, metrics = training.train_models(history, QUICK, training.TipParams(max_iter=5))
    broken = metrics.withColumn("value", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        models.register(bundle, broken, "a", dt.datetime(2024, 1, 1))
    assert models.runs() == [] and models.metrics().count() == 0
    with pytest.raises(LookupError):
        models.promote("a")
    models.register(bundle, metrics, "a", dt.datetime(2024, 1, 1))
    assert models.metrics().count() == metrics.count()
    with pytest.raises(ValueError):
        models.register(bundle, metrics, "a", dt.datetime(2024, 1, 2))
    for name in ("", "../x", "a/b", "_a"):
        with pytest.raises(ValueError):
            models.register(bundle, metrics, name, dt.datetime(2024, 1, 1))
