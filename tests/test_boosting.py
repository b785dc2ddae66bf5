"""Boosted trees against hand-computed stumps and a plain leaf-wise grower."""

import math

import numpy as np
import pytest

from zoneflow.operators import boosting
from zoneflow.operators.boosting import Block, BoostedTrees, BoostParams, Growing, LocalFit, binned, fit_boosted, frame_of
from zoneflow.session import materialize, work_dir


def make_rows(spark, rows, parts=1):
    frame = spark.createDataFrame(rows, "raw array<double>, y double, z double, split string, id long")
    return materialize(frame.repartition(parts))


def random_rows(n, seed=1):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = draw.normal(), float(draw.integers(5)), draw.normal()
        y = (3.0 if a > 0.2 else -1.0) + b + (2.0 if draw.random() < 0.1 else 0.0)
        gone = draw.random() < 0.25
        rows.append(([float(a), b, None if gone else float(c)], y + (4.0 if gone else 0.0), y * 2, "train" if i % 4 else "valid", i))
    return rows


def plain_tree(bins, y, edges, params):
    """Leaf-wise growth with every split of every leaf tried by itself: (feature, bin, NULL left) and leaf members, best first."""
    def best(rows):
        found = (0.0, None)
        g, n = y[rows].sum(), len(rows)
        for f in range(bins.shape[1]):
            own = bins[rows, f]
            for b in range(len(edges[f])):
                for side in (False, True):
                    left = np.where(own == boosting.MISSING, side, own <= b)
                    l, r = rows[left], rows[~left]
                    if min(len(l), len(r)) < params.min_rows:
                        continue
                    gain = y[l].sum() ** 2 / (len(l) + params.l2) + y[r].sum() ** 2 / (len(r) + params.l2) - g ** 2 / (n + params.l2)
                    if gain > found[0] + 1e-9:
                        found = (gain, (l, r))
        return found

    leaves = [(np.arange(len(y)), 0, best(np.arange(len(y))))]
    while len(leaves) < params.leaves:
        open_ = [i for i, (_, depth, (gain, split)) in enumerate(leaves) if split and depth < params.depth and gain > 1e-6]
        if not open_:
            break
        i = max(open_, key=lambda k: leaves[k][2][0])
        _, depth, (_, (l, r)) = leaves.pop(i)
        leaves += [(l, depth + 1, best(l)), (r, depth + 1, best(r))]
    out = np.empty(len(y))
    for rows, *_ in leaves:
        out[rows] = params.learning_rate * y[rows].sum() / (len(rows) + params.l2)
    return out, len(leaves)


@pytest.mark.parametrize("leaves, depth, l2", [(2, 5, 0.0), (7, 10, 0.0), (12, 3, 1.0), (64, 4, 0.5)])
def test_a_tree_grown_by_levels_equals_the_leaf_wise_one(leaves, depth, l2):
    rows = random_rows(400)
    values = np.array([[math.nan if x is None else x for x in r[0]] for r in rows])
    edges = [np.unique(np.quantile(values[~np.isnan(values[:, f]), f], np.linspace(0.1, 0.9, 9))) for f in range(3)]
    bins, y = binned(values, edges), np.array([r[1] for r in rows])
    y = y - y.mean()
    params = BoostParams(leaves=leaves, depth=depth, l2=l2, min_rows=15)
    growing = Growing(params, edges, np.arange(3), 2.0 ** 26 / np.abs(y).max())
    block = Block(bins, y[:, None], np.zeros((len(y), 1)), np.full(len(y), boosting.TRAIN, np.uint8), np.arange(len(y)))
    passes = 0
    while growing.wanted:
        growing.give(block.histograms(growing, 0, np.zeros(len(y)), 0))
        passes += 1
    tree = growing.finished()
    want, count = plain_tree(bins, y, edges, params)
    assert passes <= depth and (tree.feature < 0).sum() == count
    assert tree.value[tree.leaves_of_bins(bins)] == pytest.approx(want, abs=1e-6)
    assert tree.predict(values) == pytest.approx(want, abs=1e-6)


def test_a_stump_by_hand_and_its_null_side(spark):
    # 1, 2 -> 0; 3, 4 -> 10; NULL -> 10: the best split is between 2 and 3 with NULL to the right.
    rows = [([float(x)] if x else [None], y, 0.0, "train", i) for i, (x, y) in enumerate([(1, 0.0), (2, 0.0), (3, 10.0), (4, 10.0), (None, 10.0)])]
    params = BoostParams(trees=1, learning_rate=0.5, leaves=2, depth=1, min_rows=1)
    model = fit_boosted(make_rows(spark, rows), ["x"], {"m": ("y", params)}, key=None)["m"]
    tree = model.trees[0]
    assert (model.base, tree.feature[0], tree.threshold[0], bool(tree.null_left[0])) == (6.0, 0, 2.0, False)
    assert model.predict(np.array([[1.0], [2.0], [2.5], [math.nan]])) == pytest.approx([3.0, 3.0, 8.0, 8.0])
    with_l2 = fit_boosted(make_rows(spark, rows), ["x"], {"m": ("y", BoostParams(trees=1, learning_rate=1.0, leaves=2, depth=1, min_rows=1, l2=1.0))})["m"]
    assert with_l2.predict(np.array([[1.0], [9.0]])) == pytest.approx([6 - 12 / 3, 6 + 12 / 4])


def test_models_do_not_depend_on_partitions_and_equal_a_fit_in_one_task(spark, monkeypatch):
    rows = random_rows(600)
    models = {"a": ("y", BoostParams(trees=25, leaves=6, depth=4, subsample=0.7, feature_share=0.7, min_rows=5)),
              "b": ("z", BoostParams(trees=7, leaves=16, depth=4, min_rows=1, l2=1.0))}
    values = np.array([[math.nan if x is None else x for x in r[0]] for r in rows])
    one = fit_boosted(make_rows(spark, rows), ["p", "q", "r"], models)
    frame = frame_of(make_rows(spark, rows), ["p", "q", "r"], ["y", "z"])
    block = Block.of(list(frame.blocks.first()), 3, 2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "DIRECT_PARTS", 2)
    monkeypatch.setattr(boosting, "INTERVAL", 4)
    edges = frame.edges
    monkeypatch.setattr(boosting, "bin_edges", lambda *a, **k: edges)
    many = fit_boosted(make_rows(spark, rows, 6), ["p", "q", "r"], models)
    for i, (name, (_, params)) in enumerate(models.items()):
        assert len(one[name].trees) == params.trees and len(one[name].errors) == params.trees + 1
        local = LocalFit(block, i, params, frame.edges, frame.scales[i])
        local.grow(params.trees, params.trees + 1)
        for other in (many[name], BoostedTrees(["p", "q", "r"], frame.bases[i], local.trees)):
            assert other.predict(values) == pytest.approx(one[name].predict(values), abs=1e-5)
        assert local.errors == pytest.approx(one[name].errors, abs=1e-5) and one[name].errors[-1] < one[name].errors[0]
        half = LocalFit(block, i, params, frame.edges, frame.scales[i])
        half.grow(3, 99)
        resumed = LocalFit(block, i, params, frame.edges, frame.scales[i], half.trees, half.errors)
        resumed.grow(params.trees, 99)
        assert resumed.errors == pytest.approx(local.errors)


def test_scoring_saving_and_odd_inputs(spark):
    rows = random_rows(200) + [([None, None, None], None, None, "train", 900), ([math.nan, 1.0, 1e300], 1.0, 1.0, "test", 901)]
    frame = make_rows(spark, rows)
    model = fit_boosted(frame, ["p", "q", "r"], {"m": ("y", BoostParams(trees=3, depth=3, min_rows=3))})["m"]
    scored = [r.s for r in frame.select(model.prediction().alias("s")).collect()]
    assert len(scored) == 202 and all(map(math.isfinite, scored))
    path = work_dir(spark)
    model.save(path)
    loaded = BoostedTrees.load(spark, path)
    assert [r.s for r in frame.select(loaded.prediction().alias("s")).collect()] == scored
    none = fit_boosted(frame.filter("split = 'x'"), ["p", "q", "r"], {"m": ("y", BoostParams(trees=2))})["m"]
    assert none.predict(np.zeros((2, 3))).tolist() == [0.0, 0.0]
    still = fit_boosted(frame.withColumn("y", frame.y * 0 + 5), ["p", "q", "r"], {"m": ("y", BoostParams(trees=2))})["m"]
    assert still.predict(np.zeros((1, 3))).tolist() == [5.0]
    assert frame.filter("split = 'x'").select(model.prediction().alias("s")).collect() == []
    zero = fit_boosted(frame, ["p", "q", "r"], {"m": ("y", BoostParams(trees=0))})["m"]
    assert zero.trees == [] and len(zero.errors) == 1


def test_a_search_in_tasks_equals_one_in_shared_passes(spark, monkeypatch):
    rows = random_rows(500)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "INTERVAL", 3)
    frame = frame_of(make_rows(spark, rows, 5), ["p", "q", "r"], ["y", "z"])
    models = [(1, BoostParams(trees=7, leaves=5, depth=3, subsample=0.8, min_rows=5)), (0, BoostParams(trees=4, leaves=8, depth=3, min_rows=1, l2=1.0)),
              (1, BoostParams(trees=5, leaves=3, depth=2, feature_share=0.7))]
    tasks = boosting.staged_errors(frame, 3, models)
    monkeypatch.setattr(boosting, "TASK_BYTES", 0)
    monkeypatch.setattr(boosting, "WAVE_BYTES", 4 * 3 * 64 * 16)
    assert [len(wave) for wave in boosting.waves(3, models)] == [2, 1] and frame.rows == 500 and frame.blocks.count() > 1
    passes = boosting.staged_errors(frame, 3, models)
    for (_, params), one, other in zip(models, tasks, passes):
        assert len(one) == params.trees + 1 and one == pytest.approx(other, abs=1e-5) and one[-1] < one[0]
    none = boosting.staged_errors(frame_of(make_rows(spark, rows).filter("split = 'x'"), ["p", "q", "r"], ["y"]), 3, [(0, BoostParams(trees=2))])
    assert len(none[0]) == 3 and all(map(math.isnan, none[0]))


def test_early_end_after_patience():
    draw = np.random.default_rng(3)
    y = draw.normal(size=(80, 1))  # nothing to learn
    edges = [np.linspace(-1, 1, 9)] * 2
    part = np.where(np.arange(80) % 2, boosting.TRAIN, boosting.VALID).astype(np.uint8)
    block = Block(binned(draw.normal(size=(80, 2)), edges), y, np.zeros((80, 1)), part, np.arange(80))
    fit = LocalFit(block, 0, BoostParams(learning_rate=0.3, min_rows=2), edges, 1e6)
    fit.grow(300, 5)
    assert len(fit.trees) < 300 and len(fit.errors) - 1 - int(np.argmin(fit.errors)) == 5
