"""Hard negatives by threshold joins over an inverted index in blocks.

For every anchor the best rows of its own label are its positives, and for each positive the best rows of other labels
whose score lies in a window below the positive's. Scores are inner products of integer vectors. Rows and anchors are cut
into blocks; each pair of blocks is one group, so no group grows with the input. Within a group:

- Dimensions are taken in slices, those with most of the anchors' weight first. The index holds a row in a slice's list only
  from the slice on where the norm of the row's components so far, times the longest anchor's norm, could reach the
  group's lowest threshold: dimensions that this bound covers are omitted.
- Partial scores are accumulated list by list as matrix products. After each slice the norms of what remains of anchor and
  row bound what can still come, the omitted prefix included; rows that no anchor can bring to its threshold leave.
- What is left gets the omitted part and so its exact score, and the best rows of each window are kept.

Thresholds start high and are lowered for the anchors whose windows are not yet full, until they are or the window ends; what an
earlier threshold has found stays. A threshold covers all rows, so a full window holds the best rows of all.

Every round is written to the shared folder. A group returns at most as many rows as its windows want.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import BROADCAST_GROUPS
from zoneflow.llm.vector_codes import complete, integers
from zoneflow.session import materialize

#: Components saturate here.
LIMIT = 2 ** 20
FOUND = "anchor long, positive long, row long, id long, score long"


@dataclass(frozen=True)
class Mining:
    """What is mined; shares are of a positive's score, in percent."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    #: Rows and anchors of a block, and dimensions of a slice.
    block_rows: int = 8192
    block_anchors: int = 1024
    slice_dims: int = 8
    #: Thresholds of the positives, as shares of the largest score that norms allow; the last takes every row.
    positive_steps: tuple[float, ...] = (0.8, 0.4, -1.0)
    #: Thresholds of the negatives, in percent of the positive's score; the last is ``low``.
    negative_steps: tuple[int, ...] = (85, 70, 50)


class SliceIndex:
    """An inverted index of a block of rows: per slice of dimensions the rows that it lists."""

    def __init__(self, rows: np.ndarray, order: np.ndarray, slice_dims: int, longest: float, threshold: float):
        self.order, self.slice_dims = order, slice_dims
        self.values = rows[:, order]
        starts = np.arange(0, rows.shape[1], slice_dims)
        squares = np.add.reduceat(self.values ** 2, starts, axis=1) if len(starts) else np.zeros((len(rows), 0))
        before = np.concatenate([np.zeros((len(rows), 1)), np.cumsum(squares, axis=1)], axis=1)
        self.slices = [slice(b, min(b + slice_dims, rows.shape[1])) for b in starts]
        #: Norms of what follows after each slice.
        self.rest = np.sqrt(np.maximum(before[:, -1:] - before[:, 1:], 0))
        # A prefix is omitted while no anchor can reach the threshold with it alone.
        omitted = np.sqrt(before[:, 1:]) * longest * (1 + 1e-9) < threshold
        self.first = np.where(omitted.all(axis=1), len(self.slices), np.argmin(omitted, axis=1)) if len(starts) else np.zeros(len(rows), int)
        self.omitted_norm = np.sqrt(np.take_along_axis(before, self.first[:, None], axis=1))[:, 0]

    def scores(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, exact scores by anchor and row) of all rows that some anchor may bring to its threshold."""
        queries = anchors[:, self.order]
        norms = np.linalg.norm(queries, axis=1)
        live = np.flatnonzero(self.first < len(self.slices)) if self.slices else np.arange(len(self.values))
        live = np.arange(len(self.values)) if (thresholds <= 0).any() else live
        partial = np.zeros((len(anchors), len(live)))
        remaining = norms ** 2
        for k, part in enumerate(self.slices):
            listed = self.first[live] <= k
            remaining = np.maximum(remaining - (queries[:, part] ** 2).sum(axis=1), 0)
            if not listed.any():
                continue
            partial[:, listed] += queries[:, part] @ self.values[live[listed], part].T
            # What is not accumulated yet: the rest, and the prefix that a row's lists omit.
            bound = partial + np.sqrt(remaining)[:, None] * self.rest[live, k] + norms[:, None] * self.omitted_norm[live]
            bound[:, ~listed] = np.inf
            keep = (bound * (1 + 1e-9) + 1e-6 >= thresholds[:, None]).any(axis=0)
            if not keep.all():
                live, partial = live[keep], partial[:, keep]
        for k, part in enumerate(self.slices):
            missing = self.first[live] > k
            if missing.any():
                partial[:, missing] += queries[:, part] @ self.values[live[missing], part].T
        return live, partial


def best_of(ids: np.ndarray, rows: np.ndarray, scores: np.ndarray, want: int) -> np.ndarray:
    """Places of the first rows by score descending, then id (NULL last), then row."""
    if len(scores) > want:  # ties at the border stay in until they are sorted
        scores_at = np.flatnonzero(scores >= np.partition(scores, len(scores) - want)[len(scores) - want])
    else:
        scores_at = np.arange(len(scores))
    missing = np.isnan(ids[scores_at])
    order = np.lexsort((rows[scores_at], np.where(missing, 0, ids[scores_at]), missing, -scores[scores_at]))
    return scores_at[order[:want]]


def joiner(mining: Mining, same_label: bool):
    """Of one pair of blocks: the best rows of every window of its anchors."""
    def stacked(column: pd.Series, dim: int) -> np.ndarray:
        found = np.zeros((len(column), dim))
        for i, v in enumerate(column):
            found[i, :len(v)] = v
        return found

    def join(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        is_anchor = group["window"].notna().to_numpy()
        asked, rows = group[is_anchor], group[~is_anchor].sort_values("row")
        if not len(asked) or not len(rows):
            return pd.DataFrame({"anchor": [], "positive": [], "row": [], "id": [], "score": []}, dtype="Int64")
        dim = int(max(group["vector"].map(len).max(), 0))
        single = asked.drop_duplicates("row").sort_values("row")
        anchors, values = stacked(single["vector"], dim), stacked(rows["vector"], dim)
        place = np.searchsorted(single["row"].to_numpy(), asked["row"].to_numpy())
        lows = asked["low"].to_numpy(np.float64)
        thresholds = np.full(len(anchors), np.inf)
        np.minimum.at(thresholds, place, lows)
        order = np.argsort(-(anchors ** 2).sum(axis=0), kind="stable")
        longest = np.linalg.norm(anchors, axis=1).max(initial=0.0)
        index = SliceIndex(values, order, mining.slice_dims, longest, thresholds.min())
        live, scores = index.scores(anchors, thresholds)
        labels, ids, numbers = (rows[c].to_numpy() for c in ("label", "id", "row"))
        ids = rows["id"].to_numpy(np.float64, na_value=np.nan)
        labels, numbers = labels[live], numbers[live]
        out = []
        for (_, ask), at in zip(asked.iterrows(), place, strict=True):
            own = scores[at]
            fits = (own >= ask["low"]) & (own <= ask["high"]) & ((labels == ask["label"]) == same_label) & (numbers != ask["row"])
            near = np.flatnonzero(fits)
            for j in near[best_of(ids[live[near]], numbers[near], own[near], int(ask["want"]))]:
                out.append((ask["row"], ask["window"], numbers[j], ids[live[j]], own[j]))
        found = pd.DataFrame(out, columns=["anchor", "positive", "row", "id", "score"])
        return found.astype("Int64")

    return join


def in_blocks(rows: DataFrame, mining: Mining, same_label: bool) -> DataFrame:
    """``rows`` with the numbers of blocks of rows and anchors that they meet: of their label, or of all."""
    number = {"row_blocks": F.ceil(F.count("*") / mining.block_rows), "anchor_blocks": F.ceil(F.count_if("is_anchor") / mining.block_anchors)}
    if same_label:
        sizes = materialize(rows.groupBy("label").agg(*[n.cast("long").alias(c) for c, n in number.items()]).filter("anchor_blocks > 0"))
        return rows.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_GROUPS else sizes, "label")
    sizes = rows.agg(*[n.cast("long").alias(c) for c, n in number.items()]).first()
    return rows.withColumns({c: F.lit(max(1, sizes[c])) for c in number})


def threshold_join(rows: DataFrame, asked: DataFrame, mining: Mining, same_label: bool) -> DataFrame:
    """The best rows of each window. ``rows`` are :func:`in_blocks`, ``asked`` are pending windows of anchors among them."""
    shared = ["row_block", "anchor_block", *(["of_label"] if same_label else [])]
    numbers = {c: F.sequence(F.lit(0).cast("long"), F.col(f"{c}s") - 1) for c in ("row_block", "anchor_block")}
    left = rows.withColumn("row_block", F.pmod(F.xxhash64("row"), F.col("row_blocks"))).withColumn("anchor_block", F.explode(numbers["anchor_block"]))
    right = asked.withColumn("anchor_block", F.pmod(F.xxhash64("row"), F.col("anchor_blocks"))).withColumn("row_block", F.explode(numbers["row_block"]))
    columns = ["row", "id", "label", "vector", "row_block", "anchor_block"]
    both = left.select(*columns, *[F.lit(None).cast(t).alias(c) for c, t in (("window", "long"), ("low", "long"), ("high", "long"), ("want", "int"))]
                       ).unionAll(right.select(*columns, "window", "low", "high", "want"))
    if same_label:
        both = both.withColumn("of_label", F.col("label"))
    return both.groupBy(*shared).applyInPandas(joiner(mining, same_label), FOUND)


def first_of(found: DataFrame, keys: Iterable[str], want: int) -> DataFrame:
    """The best rows of each window over all blocks, numbered from 1 by ``place``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= want)


def lowered(rows: DataFrame, windows: DataFrame, mining: Mining, same_label: bool, steps: tuple, threshold) -> DataFrame:
    """Lower the threshold of unfilled windows step by step. ``windows``: row, window, low, high, want and what
    ``threshold(step)``, a Column, reads. Returns (anchor, positive, row, id, score) of all windows."""
    rows = materialize(in_blocks(rows, mining, same_label))
    windows = windows.join(rows.filter("is_anchor").drop("is_anchor"), "row")
    found, pending, above = [], windows, None
    for step in steps:
        reach = F.greatest(F.col("low"), threshold(step)) if step != steps[-1] else F.col("low")
        # What lies above the last threshold was found then.
        upper = F.col("high") if above is None else F.least(F.col("high"), F.col("above") - 1)
        asked = pending.withColumn("_reach", reach)
        asked = asked.withColumn("high", upper).withColumn("above", F.col("_reach")).withColumn("asked_low", F.col("_reach"))
        asked = materialize(asked.drop("_reach"))
        found.append(materialize(threshold_join(
            rows, asked.filter("asked_low <= high").withColumn("low", F.col("asked_low")), mining, same_label)))
        if step == steps[-1]:
            break
        have = found[-1].groupBy(F.col("anchor").alias("row"), F.col("positive").alias("window")).agg(F.count("*").alias("_have"))
        pending = asked.join(have, ["row", "window"], "left").withColumn("want", F.col("want") - F.least(F.coalesce("_have", F.lit(0)), F.col("want")).cast("int"))
        pending = materialize(pending.filter("want > 0 and above > low").drop("_have", "asked_low"))
        above = True
        if pending.isEmpty():
            break
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result


def mine(vectors: DataFrame, is_anchor: Column, scale: int = 256, label: Column | None = None, mining: Mining = Mining(),
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` and ``label`` (default: the label column) are expressions over ``vectors``. Rows without label, and vectors that
    are NULL or hold NULL or non-finite components take no part; vectors of unlike length count as followed by zeros;
    integers beyond 2^20 saturate there. Rows that repeat are rows of their own, so an anchor's copy is another row; ties go
    to the smaller id, a NULL id last. A positive without a row in its window gives no rows, nor do empty tables. Other
    columns are ignored.
    """
    chosen = vectors.select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) if label is None else label).cast("string").alias("label"),
                            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = materialize(chosen.filter(F.col("label").isNotNull() & complete(F.col("v"))).select(
        F.monotonically_increasing_id().alias("row"), "id", "label", "is_anchor", integers(F.col("v"), scale, LIMIT).alias("vector")))
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    longest = rows.agg(F.max(F.sqrt(norm))).first()[0] or 0.0
    every = np.iinfo(np.int64)
    windows = rows.filter("is_anchor").select(
        "row", F.sqrt(norm).alias("norm"), F.lit(0).cast("long").alias("window"), F.lit(int(every.min)).alias("low"),
        F.lit(int(every.max)).alias("high"), F.lit(mining.positives).alias("want"))
    found = lowered(rows, windows, mining, True, mining.positive_steps, lambda step: (F.col("norm") * longest * step).cast("long"))
    positives = materialize(first_of(found.drop("positive"), ["anchor"], mining.positives).select(
        "anchor", F.col("row").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))

    # 100 * score lies between low and high times the positive's score; bounds are rounded inwards.
    score = F.col("positive_score")
    share = lambda percent: (score.cast("decimal(20,0)") * percent) / F.lit(100).cast("decimal(3,0)")
    inside = positives.select(
        F.col("anchor").alias("row"), F.col("positive").alias("window"), "positive_score", F.ceil(share(mining.low)).cast("long").alias("low"),
        F.floor(share(mining.high)).cast("long").alias("high"), F.lit(mining.negatives).alias("want")).filter("low <= high")
    negatives = lowered(rows, inside, mining, False, mining.negative_steps, lambda step: F.floor(share(step)).cast("long"))
    ranked = first_of(negatives, ["anchor", "positive"], mining.negatives).withColumnsRenamed({"id": "negative_id", "score": "negative_score", "row": "negative"})
    ids = rows.filter("is_anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return ranked.join(positives, ["anchor", "positive"]).join(ids, "anchor").select(
        F.col("anchor_id"), "positive_id", F.col("place").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
