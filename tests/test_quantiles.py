import random
import statistics

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zoneflow.operators.quantiles import column_medians, exact_quantiles

PROBS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}


def expected(values):
    return [float(np.quantile(values, p)) for p in PROBS.values()]


def check(spark, groups, low, high, bins):
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r.k: [r[p] for p in PROBS] for r in exact_quantiles(df, ["k"], "v", PROBS, low, high, bins).collect()}
    kept = {k: [v for v in vs if v is not None] for k, vs in groups.items()}
    kept = {k: vs for k, vs in kept.items() if vs}
    assert found.keys() == kept.keys()
    for k, vs in kept.items():
        assert found[k] == pytest.approx(expected(vs), rel=1e-12, abs=1e-12), k


def test_hot_group_null_group_and_copies(spark):
    rng = random.Random(1)
    check(spark, {
        "hot": [rng.uniform(5, 500) for _ in range(5000)],
        None: [rng.uniform(5, 500) for _ in range(7)],
        "copies": [42.0] * 900 + [41.0, 43.0],
        "one": [17.5],
        "two": [10.0, 20.0],
        "unknown": [None, None],
        "some unknown": [None, 3.0, None, 1.0],
    }, 5.0, 500.0, 64)


@pytest.mark.parametrize("low,high,bins", [(0.0, 1.0, 4), (0.0, 0.0, 8), (-1e6, 1e6, 2048), (5.0, 500.0, 1)])
def test_limits_steer_the_load_and_not_the_result(spark, low, high, bins):
    rng = random.Random(2)
    check(spark, {"a": [rng.gauss(0, 300) for _ in range(400)], "b": [float(i) for i in range(11)]}, low, high, bins)


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", None]), st.lists(
    st.one_of(st.none(), st.floats(-1e4, 1e4), st.sampled_from([0.0, 1.0, 5.0])), max_size=30), min_size=1))
def test_any_values(spark, groups):
    if any(groups.values()):
        check(spark, groups, -100.0, 100.0, 16)


def test_medians_of_columns_per_group_and_overall(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), rng.random() if rng.random() > 0.2 else None, rng.randint(0, 9), None) for _ in range(500)]
    df = spark.createDataFrame(rows, "z string, x double, n int, nothing double")

    def median(values):
        values = [v for v in values if v is not None]
        return pytest.approx(float(np.median(values))) if values else None

    for r in column_medians(df, ["x", "n", "nothing"], ["z"]).collect():
        mine = [row for row in rows if row[0] == r.z]
        assert (r.x, r.n, r.nothing) == (median(m[1] for m in mine), median(m[2] for m in mine), None)
    overall = column_medians(df, ["x", "n", "nothing"]).collect()
    assert len(overall) == 1
    assert (overall[0].x, overall[0].n, overall[0].nothing) == (median(r[1] for r in rows), median(r[2] for r in rows), None)


def test_one_far_value_takes_no_bins_from_the_others(spark):
    """999,999 usual values and one of 1e12: no bin holds more than a few hundredths of them."""
    from zoneflow.operators.quantiles import BINS, TAIL_SCALE, bin_sql, tail_limits

    long = spark.range(100_000).selectExpr(
        "'c' AS _column", "CASE WHEN id = 7 THEN 1e12 WHEN id = 8 THEN -1e12 ELSE (id * 7919) % 100003 / 1e5 END AS _value")
    fullest = long.join(tail_limits(long), "_column").selectExpr(
        f"{bin_sql(TAIL_SCALE, '_low', '_high', BINS)} AS bin").groupBy("bin").count().agg({"count": "max"}).first()[0]
    assert fullest < 6_000
    wide = long.selectExpr("_value AS c", "_value * 2 AS d")
    assert column_medians(wide, ["c", "d"]).first().asDict() == wide.selectExpr(
        "percentile(c, 0.5) AS c", "percentile(d, 0.5) AS d").first().asDict()


def test_medians_of_merged_counts_equal_those_of_all_rows(spark):
    from functools import reduce

    from pyspark.sql import DataFrame

    from zoneflow.operators.quantiles import count_medians, merged_counts, value_counts

    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1.0, 2.0, 2.0, rng.gauss(0, 1e6)]), rng.choice([None, float("nan"), 3.0, 1e300]), i % 4)
            for i in range(500)]
    df = spark.createDataFrame(rows, "z string, x double, y double, part int")
    parts = reduce(DataFrame.unionAll, [value_counts(df.filter(f"part = {k}"), ["x", "y"], ["z"]) for k in range(4)])
    for keys in (["z"], []):
        found = count_medians(merged_counts(parts, keys), ["x", "y"], keys).collect()
        whole = column_medians(df, ["x", "y"], keys).collect()
        assert sorted(map(repr, found)) == sorted(map(repr, whole))
        by = {tuple(r[k] for k in keys): r for r in found}
        for key, r in by.items():
            own = sorted(x for z, x, *_ in rows if not keys or z == key[0])
            assert r.x == pytest.approx(statistics.median(own))
    assert count_medians(parts.filter("false"), ["x"], ["z"]).count() == 0
    assert value_counts(df, ["x"]).agg({"_times": "sum"}).first()[0] == 500
