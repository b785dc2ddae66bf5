import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from zoneflow.config import FORECAST_COLUMNS, StoreConfig
from zoneflow.functions.calendar import ntz, plus_hours
from zoneflow.operators import forecast as fc
from zoneflow.operators import ranking, report
from zoneflow.operators.hourly import store_features
from zoneflow.plans import forecasting, training
from zoneflow.schemas import METRIC_SCHEMA
from zoneflow.session import work_dir

FIRST = dt.datetime(2024, 1, 1)


@pytest.fixture
def history(make_cells):
    """Nine days of two zones, one of them with gaps."""
    rows = [("A", h, 10 + h % 24, 50.0 + h % 7) for h in range(216)]
    rows += [("B", h, 5 + h % 5, 30.0 + h % 11) for h in range(216) if h % 9]
    return store_features(make_cells(rows))


def chained(grid, history, plan):
    """One join per offset, as the definition says."""
    for k, columns in plan.items():
        present = {s: f for s, f in columns.items() if s in history.columns}
        side = history.select(F.col("PUZone"), plus_hours(F.col("ts_hour"), k).alias("ts_hour"),
                              *[F.col(s).alias(f) for s, f in present.items()])
        grid = grid.join(side, ["PUZone", "ts_hour"], "left")
    return grid


@pytest.mark.parametrize("plan", [fc.LAG_PLAN, fc.ONLINE_LAG_PLAN])
@pytest.mark.parametrize("start_hour", [216, 100, 500])
def test_one_lag_join_equals_one_join_per_offset(history, plan, start_hour):
    first, hours = ntz(FIRST + dt.timedelta(hours=start_hour)), 30
    rolled = fc.history_rolling(history)
    grid = fc.future_grid(history, first, hours).select("PUZone", "PUBorough", "ts_hour")
    one, many = fc.time_lag_join(grid, rolled, first, hours, plan), chained(grid, rolled, plan)
    names = sorted(many.columns)
    assert sorted(one.columns) == names

    def rows(df):
        return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)

    assert rows(one) == rows(many)


@pytest.mark.parametrize("start_hour", [216, 120, 400])
def test_recent_rows_give_the_same_lags_as_all_rows(make_cells, start_hour):
    # A sparse zone, whose windows reach far back in time, and a dense one.
    rows = [("A", h, 10 + h % 24, 50.0 + h % 7) for h in range(216)] + [("S", h, 5, 30.0 + h % 11) for h in range(0, 216, 50)]
    history = store_features(make_cells(rows))
    first, hours = ntz(FIRST + dt.timedelta(hours=start_hour)), 12
    grid = fc.future_grid(history, first, hours).select("PUZone", "PUBorough", "ts_hour")
    recent = fc.recent_history(history, first, hours, rows_back=168)
    whole = fc.time_lag_join(grid, fc.history_rolling(history), first, hours)
    found = fc.time_lag_join(grid, fc.history_rolling(recent), first, hours)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))


def test_old_rows_are_dropped_before_the_shuffle(history):
    recent = fc.recent_history(history, fc.start_column(history), 12, rows_back=24, hours_back=24)
    assert recent.groupBy("PUZone").count().agg(F.max("count")).first()[0] == 60
    assert "WindowGroupLimit" in recent._jdf.queryExecution().executedPlan().toString()


def test_grid_is_zones_times_hours(history):
    grid = fc.future_grid(history, fc.start_column(history), 5)
    rows = grid.collect()
    assert len(rows) == 10
    assert {r.ts_hour for r in rows} == {FIRST + dt.timedelta(hours=216 + i) for i in range(5)}
    assert "CartesianProduct" not in grid._jdf.queryExecution().executedPlan().toString()
    # January 10 2024 is a Wednesday.
    assert {r.day_of_week for r in rows} == {2}
    assert {r.day_of_week for r in fc.future_grid(history, fc.start_column(history), 1, compat=False).collect()} == {3}


def test_grid_and_clock_lags_ignore_daylight_saving(spark, make_cells):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        march = make_cells([("A", 24 * 69 + h, 10 + h, 50.0 + h) for h in (1, 2, 4)])  # March 10, 2024
        first = ntz(dt.datetime(2024, 3, 10, 0))
        assert [r.ts_hour.hour for r in fc.future_grid(march, first, 5).orderBy("ts_hour").collect()] == [0, 1, 2, 3, 4]
        found = store_features(march, StoreConfig(lag_mode="time")).orderBy("ts_hour").collect()
        assert [(r.ts_hour.hour, r.lag_1h_trip_count, r.lag_2h_trip_count) for r in found] == [
            (1, None, None), (2, 11, None), (4, None, 12)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_start_is_the_hour_after_the_last_or_the_given_one(history):
    row = fc.forecast_start(history).first()
    assert (row.data_min_ts_hour, row.data_max_ts_hour) == (FIRST, FIRST + dt.timedelta(hours=215))
    assert row.forecast_start == FIRST + dt.timedelta(hours=216) and row.history_rows == history.count()
    given = dt.datetime(2024, 6, 1, 8)
    assert fc.forecast_start(history, given).first().forecast_start == given


def test_rolling_history_equals_the_definition(history):
    rows = fc.history_rolling(history).filter("PUZone = 'B'").orderBy("ts_hour").collect()
    counts, rph = [r.trip_count for r in rows], [r.target_rph for r in rows]
    for i in (0, 1, 2, 30, 190):
        before = slice(max(0, i - 24), i)
        assert rows[i].rolling_24h_trip_mean == (pytest.approx(statistics.mean(counts[before])) if i else None)
        assert rows[i].rolling_24h_rph_std == (pytest.approx(statistics.stdev(rph[before])) if i > 1 else None)
        assert rows[i].rolling_7d_rph_mean == (pytest.approx(statistics.mean(rph[max(0, i - 168):i])) if i else None)


def test_derived_values_guard_unknown_and_zero(spark):
    df = spark.createDataFrame([(4, 2, 10.0, 8.0, 9.0, None, 0.0), (None, None, None, None, None, None, None)],
                               "lag_1h_trip_count int, lag_2h_trip_count int, lag_1h_rph double, lag_2h_rph double, "
                               "rolling_24h_rph_mean double, rolling_24h_rph_std double, rolling_168h_trip_mean double")
    first, second = fc.lag_derived(df).collect()
    assert (first.trip_count_delta_1h, first.rph_delta_1h, first.rph_zscore, first.rph_cv, first.relative_zone_activity) == (
        2, 2.0, pytest.approx(1e6), 0.0, None)
    assert (second.rph_zscore, second.rph_cv) == (None, 0.0)


def test_fill_uses_zone_then_overall_then_zero(spark):
    history = spark.createDataFrame(
        [("A", 1.0, None), ("A", 3.0, None), ("B", 10.0, None), ("C", None, None)], "PUZone string, x double, y double")
    future = spark.createDataFrame([("A", None), ("A", 7.0), ("C", None), ("D", None)], "PUZone string, x double")
    found = sorted((r.PUZone, r.x, r.y, r.z) for r in fc.fill_missing(future, history, ["x", "y", "z"]).collect())
    assert found == [("A", 2.0, 0.0, 0.0), ("A", 7.0, 0.0, 0.0), ("C", 3.0, 0.0, 0.0), ("D", 3.0, 0.0, 0.0)]


def test_climatology(history):
    grid = fc.future_grid(history, fc.start_column(history), 3).select("PUZone", "PUBorough", "ts_hour", "hour")
    rows = {(r.PUZone, r.hour): r for r in fc.zone_hour_stats(grid, history).collect()}
    assert len(rows) == 6
    mine = [r.dropoff_count for r in history.filter("PUZone = 'B' AND hour = 2").collect()]
    assert rows[("B", 2)].dropoff_count == pytest.approx(statistics.mean(mine))
    weather = [r.temperature for r in history.filter("hour = 1").collect()]
    assert rows[("A", 1)].temperature == rows[("B", 1)].temperature == pytest.approx(statistics.mean(weather))


def test_window_check_fails_fast(history):
    first = fc.start_column(history)
    future = fc.future_grid(history, first, 4)
    fc.assert_forecast_window(future, first, 4)
    with pytest.raises(ValueError, match="asked for"):
        fc.assert_forecast_window(future, first, 5)
    with pytest.raises(ValueError, match="asked for"):
        fc.assert_forecast_window(future.limit(0), first, 4)


@pytest.mark.parametrize("args", [(0, None, "opportunity"), (169, None, "tip"), (24, 0, "tip"), (24, 1, "fare")])
def test_request_limits(args):
    with pytest.raises(ValueError):
        fc.check_online_request(*args)


def test_good_requests():
    fc.check_online_request(168, 1, "competition")
    fc.check_request(1000)


# --- ranking --------------------------------------------------------------------------------------


@pytest.fixture
def predicted(spark):
    rows = [(FIRST, "A", 1.0, 10.0, 5.0, 0.1), (FIRST, "B", 3.0, 30.0, 1.0, 0.3), (FIRST, "C", 3.0, 30.0, 1.0, 0.3),
            (FIRST + dt.timedelta(hours=1), "A", 2.0, 20.0, 3.0, 0.2)]
    return spark.createDataFrame(
        [(t, z, "X", *p) for t, z, *p in rows],
        "ts_hour timestamp_ntz, PUZone string, PUBorough string, pred_demand double, pred_rph double, "
        "pred_competition double, pred_tip_prob double")


def test_scores_span_zero_to_one_over_the_whole_horizon(predicted):
    rows = {(r.ts_hour.hour, r.PUZone): r for r in ranking.opportunity_score(predicted).collect()}
    assert rows[(0, "B")].opportunity_score == pytest.approx(1.0, abs=1e-8)
    assert rows[(0, "A")].opportunity_score == pytest.approx(0.0, abs=1e-8)
    assert rows[(1, "A")].opportunity_score == pytest.approx(0.5)
    assert rows[(0, "B")].score_competition == pytest.approx(1.0)


def test_equal_predictions_score_zero_without_error(predicted):
    flat = predicted.withColumn("pred_demand", F.lit(4.0))
    assert {r.score_demand for r in ranking.opportunity_score(flat).collect()} == {0.0}


def test_ranks_are_one_to_n_and_ties_go_by_zone(predicted):
    ranked = ranking.rank_zones(ranking.opportunity_score(predicted))
    assert {(r.ts_hour.hour, r.PUZone): r["rank"] for r in ranked.collect()} == {
        (0, "B"): 1, (0, "C"): 2, (0, "A"): 3, (1, "A"): 1}
    by_competition = ranking.rank_zones(ranking.opportunity_score(predicted), "competition")
    assert by_competition.filter("rank = 1 AND ts_hour = TIMESTAMP_NTZ '2024-01-01'").first().PUZone == "B"
    with pytest.raises(ValueError):
        ranking.rank_zones(predicted, "fare")


def test_output_columns_top_and_cleaning(predicted):
    ranked = ranking.rank_zones(ranking.opportunity_score(predicted))
    broken = ranked.withColumn("pred_rph", F.lit(float("inf"))).withColumn("pred_demand", F.lit(float("nan"))) \
        .withColumn("pred_tip_prob", F.lit(None).cast("double"))
    rows = ranking.forecast_output(broken, top=1, clean=True).collect()
    assert len(rows) == 2 and tuple(rows[0].__fields__) == FORECAST_COLUMNS
    assert {(r.pred_rph, r.pred_demand, r.pred_tip_prob) for r in rows} == {(0.0, 0.0, 0.0)}
    half = ranked.withColumn("pred_rph", F.lit(0.00025))
    assert {r.pred_rph for r in ranking.forecast_output(half).collect()} == {0.0002}


def test_first_hour_and_summary(predicted):
    ranked = ranking.rank_zones(ranking.opportunity_score(predicted))
    assert [r.PUZone for r in ranking.first_hour_top(ranked, 2).collect()] == ["B", "C"]
    summary = ranking.forecast_summary(ranked, 2, "opportunity").first()
    assert tuple(summary) == (FIRST, FIRST + dt.timedelta(hours=1), 2, "opportunity", 4)


def test_view_kpis_and_table(spark, predicted):
    scored = ranking.opportunity_score(predicted.withColumn("PUZone", F.concat(F.lit(" "), "PUZone")))
    extra = scored.limit(1).withColumn("PUZone", F.lit(None).cast("string"))
    shapes = spark.createDataFrame([("A", 7)], "PUZone string, shape_id int")
    view = report.zone_hour_view(scored.unionByName(extra), FIRST, shapes)
    assert {(r.PUZone, r.shape_id) for r in view.collect()} == {("A", 7), ("B", None), ("C", None)}
    assert report.zone_kpis(view).first().avg_demand == pytest.approx(7 / 3)
    assert [(r.PUZone, r.position) for r in report.zone_ranking_table(view).orderBy("position").collect()] == [
        ("B", 1), ("C", 2), ("A", 3)]
    assert [r.ts_hour.hour for r in report.forecast_hours(scored).collect()] == [0, 1]
    assert report.zone_hour_view(scored).count() == 1  # the last hour


# --- models ---------------------------------------------------------------------------------------


@pytest.fixture
def bundle(history):
    trees = {layer: training.TreeParams(trees=5, depth=4, learning_rate=0.3) for layer in training.PREDICTIONS}
    return training.train_models(history, trees, training.TipParams(max_iter=20))


def test_models_beat_the_mean_and_forecasts_are_whole(spark, history, bundle):
    models, metrics = bundle
    found = {r.metric: r.value for r in metrics.collect()}
    parts = training.training_frame(history)[0]
    mean = parts.filter("split = 'train'").agg(F.avg("trip_count")).first()[0]
    naive = parts.filter("split = 'valid'").agg(F.avg(F.abs(F.col("trip_count") - mean))).first()[0]
    assert found["demand_valid_mae"] < naive
    assert {"profit_test_rmse", "competition_train_rmse", "tip_valid_accuracy"} <= set(found)

    rows = forecasting.generate_forecast(history, models, hours=6, check=True).collect()
    assert len(rows) == 12 and tuple(rows[0].__fields__) == FORECAST_COLUMNS
    assert all(0.0 <= r.opportunity_score <= 1.0 for r in rows)
    assert {r["rank"] for r in rows} == {1, 2}

    stranger = history.filter("PUZone = 'A'").withColumn("PUZone", F.lit("Z"))
    online = forecasting.generate_forecast(history.unionByName(stranger), models, hours=3, top=1, rank_by="profit",
                                           mode="online").collect()
    assert len(online) == 3 and {r.PUZone for r in online} <= {"A", "B"}
    with pytest.raises(Exception, match="(?i)unseen"):
        forecasting.generate_forecast(history.unionByName(stranger), models, hours=3).collect()

    path = work_dir(spark)
    training.save_bundle(models, path)
    loaded = training.load_bundle(spark, path)
    assert (loaded.features, loaded.medians, loaded.train_rows) == (models.features, models.medians, models.train_rows)
    again = forecasting.generate_forecast(history, loaded, hours=6).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))

    header, answer = forecasting.answer_request(history, models, hours=2, top=1, rank_by="tip")
    assert (header.hours, header.rank_by, header.row_count) == (2, "tip", 2) and answer.count() == 2
    with pytest.raises(LookupError):
        forecasting.answer_request(stranger, models, hours=2, start=dt.datetime(2024, 1, 10))
    stored = training.metric_history(metrics, "r1", dt.datetime(2024, 2, 1))
    assert stored.columns == METRIC_SCHEMA.names and stored.filter("run_id = 'r1'").count() == 12


def test_corrected_frame_attaches_the_last_window(history):
    first = fc.start_column(history)
    compatible = forecasting.forecast_frame(history, first, 1).filter("PUZone = 'A'").first()
    corrected = forecasting.forecast_frame(history, first, 1, compat=False).filter("PUZone = 'A'").first()
    counts = [10 + h % 24 for h in range(216)]
    # Compatible: the window that ended a row before the hour 24 hours back. Corrected: the last 24 hours.
    assert compatible.rolling_24h_trip_mean == pytest.approx(statistics.mean(counts[168:192]))
    assert corrected.rolling_24h_trip_mean == pytest.approx(statistics.mean(counts[192:216]))
    assert corrected.rolling_airport_activity == pytest.approx(0.5)
    assert "rolling_airport_activity" not in compatible.__fields__


def test_online_frame_has_climatology_instead_of_same_hour_lags(history):
    frame = forecasting.forecast_frame(history, fc.start_column(history), 2, mode="online")
    assert {"avg_revenue", "temperature", "lag_168h_rph"} <= set(frame.columns)
    assert not {"lag1h_avg_revenue", "rolling_168h_trip_mean"} & set(frame.columns)
    with pytest.raises(ValueError):
        forecasting.forecast_frame(history, fc.start_column(history), 2, mode="stream")


def test_search_points_lie_in_their_ranges_and_the_best_comes_first(history):
    points = training.draw_trees(50, seed=1)
    for name, (low, high) in training.TreeParams.RANGES.items():
        assert all(low <= getattr(p, name) <= high for p in points)
    assert points == training.draw_trees(50, seed=1) != training.draw_trees(50, seed=2)
    frame, _, features, _ = training.prepare(history)
    tried = training.tune_trees(frame, features, ["demand", "profit"], [
        training.TreeParams(trees=2, depth=2, learning_rate=0.01), training.TreeParams(trees=40, depth=4, learning_rate=0.3),
        training.TreeParams(trees=40, depth=3, learning_rate=0.2)])
    for own in tried.values():
        assert [e for _, e in own] == sorted(e for _, e in own) and len(own) == 3
    assert tried["demand"][0][0].learning_rate > 0.01
    tips = training.tune_tip(frame, training.draw_tips(2, seed=1))
    assert tips[0][1] <= tips[1][1] <= 1.0
    models, metrics, best = training.train_tuned(history, trials=1, max_trees=2)
    assert set(best) == set(models.models) == {"demand", "profit", "competition", "tip"}
    assert metrics.count() == 12 and best["demand"].trees <= 2
    assert {p.trees for p in training.draw_trees(50, seed=1, max_trees=20)} == {20}


def test_preparing_builds_a_lazy_store_once(spark, history):
    """A store that is no table yet is its trips' aggregation: each pass over it would be a pass over all trips."""
    built, rows = spark.sparkContext.accumulator(0), history.count()

    def counted(hour):
        built.add(1)
        return hour

    hour = F.udf(counted, "int").asNondeterministic()("hour")
    lazy = history.withColumn("hour", hour)
    frame, *_ = training.prepare(lazy)
    assert frame.count() == rows == built.value


def test_best_number_of_trees_comes_from_the_staged_errors():
    nan = float("nan")
    assert training._staged([9.0, 3.0, 5.0, 4.0, 6.0], 2) == (3, 4.0)
    assert training._staged([9.0, 3.0], 5) == (1, 3.0)
    assert training._staged([nan, nan], 1) == (1, float("inf"))


def _staged_by_whole_fits(frame, features, layer, points, least):
    """The best number of trees and its error of fits of all train rows that grow to their last tree."""
    from zoneflow.operators.boosting import fit_boosted

    models = {str(i): (training.TARGETS[layer], training.boost_params(layer, p, 42)) for i, p in enumerate(points)}
    fits = fit_boosted(frame.filter("split <> 'test'"), features, models, key=training.row_key())
    return [training._staged(fits[str(i)].errors, least) for i in range(len(points))]


def test_search_drops_no_point_and_grows_each_to_its_last_tree(history):
    """A point that learns slowly is best at its last tree; one that learns fast is best long before."""
    frame, _, features, _ = training.prepare(history)
    points = [training.TreeParams(trees=115, depth=3, learning_rate=0.3, leaves=8), training.TreeParams(trees=115, depth=2, learning_rate=0.01, leaves=4)]
    tried = training.tune_trees(frame, features, ["demand"], points)["demand"]
    want = _staged_by_whole_fits(frame, features, "demand", points, 100)
    found = {p.learning_rate: (p.trees, error) for p, error in tried}
    for point, (trees, error) in zip(points, want):
        assert found[point.learning_rate] == (trees, pytest.approx(error, abs=1e-9))
    assert found[0.01][0] == 115


def test_search_reads_all_rows_of_train_and_valid(spark):
    """More rows than the search once took of each part."""
    n = F.col("id")
    frame = spark.range(64_000).select(
        F.concat(F.lit("Z"), n % 7).alias("PUZone"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, CAST(id / 7 AS INT))").alias("ts_hour"),
        F.when(n < 60_000, "train").otherwise("valid").alias("split"), F.array((n % 97).cast("double"), (n % 13).cast("double")).alias("raw"),
        ((n * n) % 101 + F.when(n % 97 > 40, 50).otherwise(0)).cast("double").alias("trip_count"))
    points = [training.TreeParams(trees=2, depth=3, learning_rate=0.5, subsample=0.7)]
    tried = training.tune_trees(frame, ["a", "b"], ["demand"], points)["demand"]
    (trees, error), = _staged_by_whole_fits(frame, ["a", "b"], "demand", points, 2)
    assert (tried[0][0].trees, tried[0][1]) == (trees, pytest.approx(error, abs=1e-9))


def test_search_sample_is_whole_or_bounded(history):
    frame = training.training_frame(history)[0]
    both = frame.filter("split <> 'test'").count()
    assert training.search_sample(frame, 10 ** 6).count() == both
    assert 0 < training.search_sample(frame, both // 8).count() < both


def test_metadata(history):
    row = ranking.forecast_run_metadata(history, fc.start_column(history), 24, None, False, "store").first()
    assert row.forecast_start == "2024-01-10 00:00:00" and row.forecast_end == "2024-01-10 23:00:00"
    assert (row.top_n, row.start_mode) == (None, "auto_last_hour_plus_one")


def test_lag_mode_of_the_store_is_independent_of_the_forecast(make_cells):
    cells = make_cells([("A", h, h + 1, 40.0) for h in (0, 2)])
    found = [r.lag_1h_trip_count for r in store_features(cells, StoreConfig(lag_mode="time")).orderBy("ts_hour").collect()]
    assert found == [None, None]


def test_history_of_a_name_in_three_boroughs_reaches_all_lags(spark, make_cells):
    cells = make_cells([("A", h, h + 1, float(h)) for h in range(504)], "X")
    for borough in ("Y", "Z"):
        cells = cells.unionByName(make_cells([("A", h, h + 1, float(h)) for h in range(504)], borough))
    first = fc.start_column(cells)
    recent = fc.recent_history(cells, first, 1)
    assert recent.agg({"ts_hour": "min"}).first()[0] == dt.datetime(2024, 1, 1) + dt.timedelta(hours=504 - 337)
    assert recent.count() == 3 * 337


def test_month_writes_training_and_forecast_in_one_session(spark, history):
    from zoneflow.config import MonthWindow
    from zoneflow.session import work_dir
    from zoneflow.sources.sinks import read_months, write_month

    path = work_dir(spark)
    write_month(history, path, "ts_hour", MonthWindow("2024-01"))
    stored = read_months(spark, path).drop("trip_month")
    quick = {layer: training.TreeParams(trees=1, depth=2) for layer in training.PREDICTIONS}
    bundle, _ = training.train_models(stored, quick, training.TipParams(max_iter=5))
    rows = forecasting.generate_forecast(stored, bundle, hours=2)
    write_month(history, path, "ts_hour", MonthWindow("2024-01"))
    assert rows.count() == 2 * history.select("PUZone").distinct().count()
    with pytest.raises(ValueError, match="several rows"):
        forecasting.generate_forecast(history.unionByName(history.limit(1)), bundle, hours=2)


def test_registered_search_tries_whole_budgets_on_all_layers(spark, sf_dir, monkeypatch):
    from zoneflow import queries

    seen = []

    def tried(frame, features, layers, points, seed=42):
        seen.extend(points)
        return {layer: [(p, 0.5) for p in points] for layer in layers}

    monkeypatch.setattr(training, "tune_trees", tried)
    monkeypatch.setattr(training, "tune_tip", lambda frame, points: [(p, 0.5) for p in points])
    rows = queries.tune_demand(spark, sf_dir).collect()
    by_layer = {layer: [r for r in rows if r.layer == layer] for layer in training.TARGETS}
    assert {layer: len(own) for layer, own in by_layer.items()} == dict.fromkeys(training.TARGETS, 20)
    low, high = training.TreeParams.RANGES["trees"]
    assert len(seen) == 20 and {p.trees for p in seen} == {high}
    assert all(r.trees is None and r.c > 0 for r in by_layer["tip"])
    assert low <= training.TreeParams().trees <= high
