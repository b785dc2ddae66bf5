import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from zoneflow.config import SplitConfig
from zoneflow.operators import prep

FIRST = dt.datetime(2024, 1, 1)


def hours(spark, cells, schema="PUZone string, PUBorough string, ts_hour timestamp_ntz, tip_rate double"):
    return spark.createDataFrame([(z, b, FIRST + dt.timedelta(hours=h), *rest) for z, b, h, *rest in cells], schema)


@pytest.mark.parametrize("n,hour_count,seed", [(1, 1, 0), (2, 1, 1), (7, 2, 2), (20, 3, 3), (100, 40, 4), (101, 1, 5)])
def test_split_equals_positions_in_time_order(spark, n, hour_count, seed):
    rng = random.Random(seed)
    cells = [(f"z{i:03d}", "b", rng.randrange(hour_count), 0.0) for i in range(n)]
    ordered = sorted(cells, key=lambda c: (c[2], c[0]))
    train, valid = int(n * 0.70), int(n * 0.15)
    wanted = {c[0]: "train" if i < train else "valid" if i < train + valid else "test" for i, c in enumerate(ordered)}
    found = {r.PUZone: r.split for r in prep.time_split(hours(spark, cells)).collect()}
    assert found == wanted


def test_split_never_shuffles_the_rows(spark, tmp_path):
    cells = [(f"z{i}", "b", i % 50, 0.0) for i in range(500)]
    path = str(tmp_path / "rows")
    hours(spark, cells).write.parquet(path)
    df = prep.time_split(spark.read.parquet(path), SplitConfig(0.5, 0.2))
    assert {r.split: r["count"] for r in df.groupBy("split").count().collect()} == {"train": 250, "valid": 100, "test": 150}


def test_tip_label_uses_the_train_median(spark):
    rates = [0.1, 0.2, None, 0.4, 0.5, 0.6, 0.3, 0.9, 0.2, 0.9]
    parts = prep.time_split(hours(spark, [("z", "b", h, r) for h, r in enumerate(rates)]))
    found = {r.ts_hour.hour: (r.tip_rate, r.high_tip_zone) for r in prep.tip_label(parts).collect()}
    median = statistics.median(r or 0.0 for r in rates[:7])
    assert found == {h: (r or 0.0, int((r or 0.0) > median)) for h, r in enumerate(rates)}


def test_encoders_sort_names_and_refuse_unknown_ones(spark):
    df = hours(spark, [("b", "Y", 0, 0.0), ("a", "X", 1, 0.0), ("C", "Y", 2, 0.0), (None, None, 3, 0.0)])
    known = prep.known_categories(df)
    encoders = prep.fit_encoders(known)
    assert prep.encoder_labels(encoders) == {"PUZone": ["C", "a", "b"], "PUBorough": ["X", "Y"]}
    coded = {r.PUZone: (r.PUZone_enc, r.PUBorough_enc) for r in prep.encode_categoricals(known, encoders).collect()}
    assert coded == {"C": (0, 1), "a": (1, 0), "b": (2, 1)}
    with pytest.raises(Exception, match="Unseen label|unseen"):
        prep.encode_categoricals(hours(spark, [("d", "X", 0, 0.0)]), encoders).collect()


def test_known_category_filter_and_its_rest(spark):
    df = hours(spark, [("a", "X", 0, 0.0), ("a", "W", 1, 0.0), ("q", "X", 2, 0.0), (None, "X", 3, 0.0)])
    labels = {"PUZone": spark.createDataFrame([("a",)], "PUZone string"),
              "PUBorough": spark.createDataFrame([("X",), ("X",)], "PUBorough string")}
    kept, dropped = prep.split_known(df, labels)
    assert [r.ts_hour.hour for r in kept.collect()] == [0]
    assert sorted(r.ts_hour.hour for r in dropped.collect()) == [1, 2, 3]
    assert [r.ts_hour.hour for r in prep.known_category_filter(df, labels).collect()] == [0]
    assert kept.columns == df.columns == dropped.columns


def test_impute_uses_the_train_median_in_all_parts(spark):
    df = spark.createDataFrame(
        [("train", 1.0, None), ("train", 2.0, 4), ("train", None, 6), ("train", 10.0, None), ("valid", None, None),
         ("test", 99.0, None)], "split string, x double, n int")
    found = sorted((r.split, r.x, r.n) for r in prep.median_impute(df, ["x", "n"]).collect())
    assert found == sorted([("train", 1.0, 5.0), ("train", 2.0, 4.0), ("train", 2.0, 6.0), ("train", 10.0, 5.0),
                            ("valid", 2.0, 5.0), ("test", 99.0, 5.0)])


def test_competition_target_counts_unknown_as_zero(spark):
    df = spark.createDataFrame([(3, None, 0.5), (None, None, None)],
                               "lag_1h_trip_count bigint, rolling_24h_rph_std double, congestion_score double")
    assert [r[0] for r in df.select(prep.competition_target()).collect()] == [3.5, 0.0]


def test_metrics(spark):
    scored = spark.createDataFrame(
        [("train", 10, 8.0, 1.0, 4.0, 2.0, 2.0, 1, 1.0), ("train", 10, 13.0, 1.0, 1.0, 2.0, 4.0, 0, 1.0)],
        "split string, trip_count int, pred_demand double, target_rph double, pred_rph double, competition double, "
        "pred_competition double, high_tip_zone int, pred_tip double")
    found = {r.metric: r.value for r in prep.regression_metrics(scored).collect()}
    assert found == pytest.approx({"demand_train_mae": 2.5, "profit_train_rmse": 4.5 ** 0.5,
                                   "competition_train_rmse": 2 ** 0.5, "tip_train_accuracy": 0.5})


def test_drift_compares_with_the_run_before(spark):
    def run(i, metric, value):
        return (f"r{i}", FIRST + dt.timedelta(days=i), metric, value)

    history = spark.createDataFrame(
        [run(0, "demand_valid_mae", 10.0), run(1, "demand_valid_mae", 11.5), run(2, "demand_valid_mae", 13.3),
         run(3, "demand_valid_mae", 1.0), run(0, "profit_valid_rmse", 1.0), run(1, "profit_valid_rmse", 9.0),
         run(4, "demand_valid_mae", 0.0), run(5, "demand_valid_mae", 1.0)],
        "run_id string, run_ts timestamp_ntz, metric string, value double")
    found = {(r.run_id, r.metric): (r.change_pct, r.status) for r in prep.metric_drift(history).collect()}
    assert found[("r0", "demand_valid_mae")] == (None, "OK")
    assert found[("r1", "demand_valid_mae")] == (pytest.approx(15.0, abs=1e-6), "OK")
    assert found[("r2", "demand_valid_mae")][1] == "DEGRADED"
    assert found[("r3", "demand_valid_mae")][1] == "OK"
    assert found[("r1", "profit_valid_rmse")] == (pytest.approx(800.0), "OK")
    assert found[("r5", "demand_valid_mae")][1] == "DEGRADED"


def test_feature_list_has_47_names_and_uses_what_exists(spark):
    from zoneflow.config import FEATURES

    assert len(FEATURES) == len(set(FEATURES)) == 47
    df = spark.range(1).withColumns({"hour": F.lit(1), "PUZone_enc": F.lit(0)})
    assert prep.existing(df) == ["PUZone_enc", "hour"]
