"""Exact quantiles per group that stay exact, and stay parallel, when one group holds most rows.

The built-in ``percentile`` keeps all distinct values of a group in one task's memory. Here the value
range is cut into equal bins and the work is split by (group, bin):

1. count equal values per (group, bin) - combined map-side, so copies of one value shuffle as one row,
   and the rows of a hot group are spread over tasks by value;
2. running counts over the bins of a group (at most ``bins`` rows) tell which bins hold the wanted ranks;
3. only values in those bins, mostly one or two bins per wanted quantile, are put in order.

No row is dropped or sampled: a value outside the chosen bins cannot be the answer. The largest piece of
work in one task is the distinct values of one bin of one group.

A group travels as one struct column, ``_k``. A struct treats its NULL fields as equal, so groups with a
NULL key join by plain equality, and grouping, windows and joins agree on one partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 2048


def key_sql(keys: Sequence[str]) -> str:
    return f"struct({', '.join(keys)}) AS _k" if keys else "named_struct('all', 1) AS _k"


def bin_sql(value: str, low: float | str, high: float | str, bins: int = BINS) -> str:
    """Bin number of a value, in value order; NULL for NULL. Every step is monotone in ``value``, so bins
    never overlap; values outside the limits fall into the edge bins."""
    low, high = (f"{x}D" if isinstance(x, (int, float)) else x for x in (low, high))
    share = f"CASE WHEN {high} > {low} THEN ({value} - {low}) / ({high} - {low}) ELSE 0D END"
    return f"CASE WHEN {value} IS NOT NULL THEN int(least(greatest(floor({share} * {bins}), 0), {bins - 1})) END"


def keyed(df: DataFrame, keys: Sequence[str], value: str, low: float | str, high: float | str, bins: int = BINS,
          scale: str | None = None, times: str = "1") -> DataFrame:
    """The rows with a value, as group, bin, value and how often it counts (``times``). ``scale`` is what is cut into bins
    instead of the value; it must grow with the value."""
    rows = df.selectExpr(key_sql(keys), f"{value} AS _v", f"{bin_sql(scale or value, low, high, bins)} AS _bin", f"bigint({times}) AS _times")
    return rows.filter("_v IS NOT NULL AND NOT isnan(_v)")


def _ranks(p: float) -> tuple[str, str, str]:
    """Zero-based ranks below and above quantile ``p`` of ``_n`` values, and the weight of the upper."""
    at = f"((_n - 1) * {float(p)}D)"
    return f"floor({at})", f"ceil({at})", f"({at} - floor({at}))"


def locate(bin_counts: DataFrame, probs: Mapping[str, float]) -> DataFrame:
    """One row per group and wanted bin: ``_n`` values in the group and ``_before`` of them in lower bins.
    A wanted bin holds a rank next to one of the quantiles; there are at most two per quantile.

    ``bin_counts`` has ``_k``, ``_bin`` and ``_c``.
    """
    per_group = Window.partitionBy("_k")
    running = bin_counts.withColumns({
        "_before": F.sum("_c").over(per_group.orderBy("_bin")) - F.col("_c"),
        "_n": F.sum("_c").over(per_group),
    })
    wanted = sorted({rank for p in probs.values() for rank in _ranks(p)[:2]})
    holds = " OR ".join(f"(_before <= {rank} AND {rank} < _before + _c)" for rank in wanted)
    return running.filter(holds).drop("_c")


def group_quantiles(rows: DataFrame, probs: Mapping[str, float]) -> DataFrame:
    """``_k`` and one column per quantile, from rows of ``_k``, ``_bin``, ``_v`` (not NULL) and ``_times``. The value
    counts are shuffled once and serve both the bin counts and the ordering."""
    counts = rows.groupBy("_k", "_bin", "_v").agg(F.expr("sum(_times) AS _c"))
    located = locate(counts.groupBy("_k", "_bin").agg(F.expr("sum(_c) AS _c")), probs)
    in_bin = Window.partitionBy("_k", "_bin").orderBy("_v")
    ordered = counts.join(located, ["_k", "_bin"]).withColumn("_upto", F.col("_before") + F.sum("_c").over(in_bin))
    columns = []
    for name, p in probs.items():
        low, high, weight = _ranks(p)
        at_low, at_high = (
            f"max(CASE WHEN _upto - _c <= {rank} AND {rank} < _upto THEN _v END)" for rank in (low, high))
        columns.append(f"{at_low} * (1 - max({weight})) + {at_high} * max({weight}) AS {name}")
    return ordered.groupBy("_k").agg(*[F.expr(c) for c in columns])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
                    low: float | str, high: float | str, bins: int = BINS, scale: str | None = None) -> DataFrame:
    """The keys and one column per quantile of ``value``, exact and interpolated. ``low`` and ``high``,
    numbers or column names, are the expected limits of the values; they steer the load, not the result.
    Groups without any value are absent."""
    found = group_quantiles(keyed(df, keys, value, low, high, bins, scale), probs)
    return found.selectExpr(*[f"_k.{k}" for k in keys], *probs)


#: Grows with the value: straight around the middle, logarithmic far from it.
TAIL_SCALE = "signum(_value - _middle) * log1p(abs(_value - _middle) / _width)"


def column_limits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: where its values are dense (approximate quantiles, which steer the load and not the result), and the
    limits of :data:`TAIL_SCALE`. One far value so takes no bins away from the usual ones. One pass over the columns side by side."""
    facts = []
    for i, c in enumerate(columns):
        value = f"nullif(double({c}), double('NaN'))"
        facts += [f"approx_percentile({value}, array(0.05D, 0.25D, 0.5D, 0.75D, 0.95D)) AS q{i}", f"min({value}) AS a{i}", f"max({value}) AS b{i}"]
    each = ", ".join(f"'{c}', q{i}, a{i}, b{i}" for i, c in enumerate(columns))
    spread = df.agg(*map(F.expr, facts)).selectExpr(f"stack({len(columns)}, {each}) AS (_column, q, a, b)")
    width = "coalesce(nullif(q[3] - q[1], 0D), nullif(q[4] - q[0], 0D), nullif(b - a, 0D), 1D)"
    at = spread.filter("a IS NOT NULL").selectExpr("_column", "a", "b", "q[2] AS _middle", f"{width} AS _width")
    return at.selectExpr("_column", "_middle", "_width", f"{TAIL_SCALE.replace('_value', 'a')} AS _low",
                         f"{TAIL_SCALE.replace('_value', 'b')} AS _high")


def stacked(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Columns as rows: keys, ``_column``, ``_value`` (not NULL, not NaN)."""
    pairs = ", ".join(f"'{c}', double({c})" for c in columns)
    long = df.selectExpr(*keys, f"stack({len(columns)}, {pairs}) AS (_column, _value)")
    return long.filter("_value IS NOT NULL AND NOT isnan(_value)")


def value_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """How often each value of each column occurs in a group: keys, ``_column``, ``_value``, ``_times``. NULL and NaN do not count.

    Counts of parts of a table, of its months for instance, add up to those of the whole (:func:`merged_counts`), so medians over
    a long history need its counts only, not its rows."""
    return stacked(df, columns, keys).groupBy(*keys, "_column", "_value").agg(F.count("*").alias("_times"))


def merged_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of parts added up, by fewer keys if fewer are given."""
    return counts.groupBy(*keys, "_column", "_value").agg(F.sum("_times").alias("_times"))


def tail_limits(counts: DataFrame) -> DataFrame:
    """:func:`column_limits` of values or their counts in rows."""
    spread = counts.groupBy("_column").agg(F.expr("approx_percentile(_value, array(0.05D, 0.25D, 0.5D, 0.75D, 0.95D)) AS q"),
                                           F.expr("min(_value) AS a"), F.expr("max(_value) AS b"))
    width = "coalesce(nullif(q[3] - q[1], 0D), nullif(q[4] - q[0], 0D), nullif(b - a, 0D), 1D)"
    at = spread.selectExpr("_column", "a", "b", "q[2] AS _middle", f"{width} AS _width")
    return at.selectExpr("_column", "_middle", "_width", f"{TAIL_SCALE.replace('_value', 'a')} AS _low",
                         f"{TAIL_SCALE.replace('_value', 'b')} AS _high")


def count_medians(counts: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), limits: DataFrame | None = None) -> DataFrame:
    """Exact medians of many columns from their value counts, wide: one row per group (one row in all without keys).

    Every (group, column, bin) is its own unit of work, and no task holds the values of a whole column."""
    # One row per column name: bounded by the argument list.
    placed = counts.join(F.broadcast(tail_limits(counts) if limits is None else limits), "_column")
    rows = keyed(placed, [*keys, "_column"], "_value", "_low", "_high", scale=TAIL_SCALE, times="_times")
    medians = group_quantiles(rows, {"_median": 0.5}).selectExpr(*[f"_k.{k}" for k in [*keys, "_column"]], "_median")
    return medians.groupBy(*keys).agg(*[F.expr(f"max(CASE WHEN _column = '{c}' THEN _median END) AS {c}") for c in columns])


def column_medians(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Exact median of many columns, wide: one row per group (one row in all without keys)."""
    each = stacked(df, columns, keys).withColumn("_times", F.lit(1))
    return count_medians(each, columns, keys, column_limits(df, columns))
