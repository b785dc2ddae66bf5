"""Gradient boosted regression trees for squared error, grown leaf by leaf on histograms.

Features are binned once by quantile edges; NULL has a bin of its own. A split sends NULL to the side that gains more, so missing
values need no filling. Per leaf, feature and bin the tasks sum residuals and rows; sums are integers (residuals in fixed point),
so a model does not depend on how rows are partitioned. Of two siblings only the smaller is summed, the other is the
parent's rest.

A tree grows leaf-wise: always the leaf with the largest gain is split next, until it has ``leaves``. A whole level
is evaluated in one pass all the same: a node is reached before another exactly when the smallest gain on its path is
larger, so the splits of the leaf-wise tree are those with the largest path minimum, and a node whose path minimum is no longer
among these can be dropped. A tree thus costs at most one pass per level of depth.

Several models grow side by side in the same passes (:func:`fit_boosted`). Rows are held in blocks below the shared folder with
their predictions so far, which are brought up to date every ``INTERVAL`` trees; between that, tasks add the newest trees
themselves. Tasks keep nothing between passes, so a lost executor costs a pass.

A search fits many models of the same rows (:func:`staged_errors`). Where a task can hold all rows each model is a task, beyond
that the models grow in shared passes, as many at a time as their histograms allow. Both read every row and give the same errors.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from zoneflow.session import discard, materialize, work_dir

# Functions go to the tasks by value, so executors need not have the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bins of a feature without the one of NULL, and that one.
BINS, MISSING = 63, 63
BLOCK_ROWS, INTERVAL, DIRECT_PARTS, SPREAD = 65_536, 20, 16, 32
#: A level's features are evaluated in groups by their bins, if it has more than a few nodes.
WIDTHS, FEW_NODES = (4, 12, 30), 8
#: Rows of up to this size are fitted in one task each model of a search; histograms of up to this size are asked for in one pass
#: of a search; and up to this size come to the driver from the tasks of a pass.
TASK_BYTES, WAVE_BYTES, DIRECT_BYTES = 48 << 20, 64 << 20, 256 << 20
#: Residuals of the start become integers up to this size.
FIXED_POINT = 2.0 ** 26
TRAIN, VALID = 1, 2


@dataclass(frozen=True)
class BoostParams:
    trees: int = 100
    learning_rate: float = 0.1
    leaves: int = 31
    depth: int = 5
    subsample: float = 1.0
    feature_share: float = 1.0
    min_rows: int = 20
    l2: float = 0.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes by number, the root first; a leaf's feature is -1. ``bin`` is the last bin that goes left."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    null_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def _leaves(self, count: int, goes_left) -> np.ndarray:
        node = np.zeros(count, dtype=np.int64)
        open_ = np.arange(count)
        while len(open_ := open_[self.feature[node[open_]] >= 0]):
            at = node[open_]
            node[open_] = np.where(goes_left(open_, at), self.left[at], self.right[at])
        return node

    def leaves_of_bins(self, bins: np.ndarray) -> np.ndarray:
        def left(rows, at):
            own = bins[rows, self.feature[at]]
            return np.where(own == MISSING, self.null_left[at], own <= self.bin[at])
        return self._leaves(len(bins), left)

    def predict(self, values: np.ndarray) -> np.ndarray:
        """Of raw features, NaN for NULL."""
        def left(rows, at):
            own = values[rows, self.feature[at]]
            return np.where(np.isnan(own), self.null_left[at], own <= self.threshold[at])
        return self.value[self._leaves(len(values), left)]


@dataclass
class Growing:
    """A tree being grown. ``wanted`` are the nodes whose histograms the next pass has to sum."""

    params: BoostParams
    edges: list[np.ndarray]
    features: np.ndarray
    scale: float
    nodes: list[dict] = field(default_factory=lambda: [{"parent": -1, "depth": 0}])
    wanted: list[int] = field(default_factory=lambda: [0])
    level: list[int] = field(default_factory=lambda: [0])

    def tree(self, split: set[int] | None = None) -> Tree:
        """The tree of the nodes split so far, or of those in ``split``."""
        rate, l2 = self.params.learning_rate, self.params.l2
        kept, number = [0], {0: 0}
        for i in kept:
            node = self.nodes[i]
            if "left" in node and (split is None or i in split):
                for child in (node["left"], node["right"]):
                    number[child] = len(kept)
                    kept.append(child)
        rows = []
        for i in kept:
            node = self.nodes[i]
            if node.get("left") in number:
                f = int(self.features[node["f"]])
                rows.append((f, node["b"], self.edges[f][node["b"]], node["null_left"], number[node["left"]], number[node["right"]], 0.0))
            else:
                g, n = node.get("sums", (0, 0))
                rows.append((-1, 0, 0.0, False, 0, 0, -rate * (g / self.scale) / (n + l2) if n + l2 else 0.0))
        columns = list(zip(*rows))
        kinds = (np.int64, np.int64, np.float64, bool, np.int64, np.int64, np.float64)
        return Tree(*(np.array(c, dtype=k) for c, k in zip(columns, kinds)))

    def give(self, found: dict[int, np.ndarray]) -> None:
        """Histograms (feature, bin, [residuals, rows]) of the wanted nodes; splits what may belong to the leaf-wise tree."""
        for i in self.level:
            node = self.nodes[i]
            if i in found:
                node["histogram"] = found[i]
            else:
                parent = self.nodes[node["parent"]]
                sibling = parent["left"] if parent["right"] == i else parent["right"]
                node["histogram"] = parent["histogram"] - found[sibling]
            node["sums"] = tuple(node["histogram"][0].sum(axis=0).tolist()) if len(self.features) else (0, 0)
        for i in {self.nodes[i]["parent"] for i in self.level} - {-1}:
            del self.nodes[i]["histogram"]
        self.evaluate()
        best = self.best()
        self.wanted, following = [], []
        for i in self.level:
            node = self.nodes[i]
            if i in best and node["depth"] < self.params.depth:
                smaller, rest = sorted(((node["rows_left"], len(self.nodes)), (node["sums"][1] - node["rows_left"], len(self.nodes) + 1)))
                node["left"], node["right"] = len(self.nodes), len(self.nodes) + 1
                self.nodes += [{"parent": i, "depth": node["depth"] + 1} for _ in (0, 1)]
                if node["depth"] + 1 < self.params.depth and rest[0] >= 2 * max(1, self.params.min_rows):
                    self.wanted.append(smaller[1])
                    following += [node["left"], node["right"]]
                else:  # leaves for certain: their sums follow from the split
                    g, n = node["sums"]
                    for child, sums in ((node["left"], (node["g_left"], node["rows_left"])), (node["right"], (g - node["g_left"], n - node["rows_left"]))):
                        self.nodes[child]["sums"] = sums
                    del node["histogram"]
            else:
                node.pop("histogram", None)
        self.level = following

    def evaluate(self) -> None:
        """The best split of every node of the level, NULL to either side; ties go to the first feature, bin and side."""
        if not len(self.features):
            return
        least = max(1, self.params.min_rows)
        open_ = [i for i in self.level if self.nodes[i]["sums"][1] >= 2 * least]
        for i in set(self.level).difference(open_):  # too few rows for two sides
            self.nodes[i] |= {"gain": 0.0, "path": 0.0}
        if not open_:
            return
        h = np.stack([self.nodes[i]["histogram"] for i in open_])
        g, n = h[..., 0] / self.scale, h[..., 1].astype(np.float64)
        all_g, all_n, l2 = g[:, 0].sum(axis=1), n[:, 0].sum(axis=1), self.params.l2
        shape = (len(open_), len(self.features))
        gains, bins, sides, lefts = np.full(shape, -np.inf), np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape)
        for some, width, both in self.alike(n[..., MISSING].any(axis=0), len(open_)):
            left_g, left_n = np.cumsum(g[:, some, :width], axis=2)[..., None], np.cumsum(n[:, some, :width], axis=2)[..., None]
            if both:
                left_g = np.concatenate([left_g, left_g + g[:, some, BINS:, None]], axis=3)
                left_n = np.concatenate([left_n, left_n + n[:, some, BINS:, None]], axis=3)
            whole_g, whole_n = all_g[:, None, None, None], all_n[:, None, None, None]
            right_g, right_n = whole_g - left_g, whole_n - left_n
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = left_g ** 2 / (left_n + l2) + right_g ** 2 / (right_n + l2) - whole_g ** 2 / (whole_n + l2)
            gain[~((left_n >= least) & (right_n >= least))] = -np.inf
            for k, f in enumerate(self.features[some]):
                gain[:, k, len(self.edges[f]):] = -np.inf
            flat = gain.reshape(*gain.shape[:2], -1)
            at = flat.argmax(axis=2)[..., None]
            gains[:, some], lefts[:, some] = (np.take_along_axis(x, at, 2)[..., 0] for x in (flat, left_n.reshape(flat.shape)))
            bins[:, some], sides[:, some] = at[..., 0] // gain.shape[3], at[..., 0] % gain.shape[3]
        for row, (i, f) in enumerate(zip(open_, gains.argmax(axis=1).tolist())):
            node, best, b, side = self.nodes[i], gains[row, f], int(bins[row, f]), int(sides[row, f])
            missing = h[row, f, MISSING, 1]
            node["gain"] = float(best) if best > 1e-9 * max(1.0, float(all_g[row] ** 2 / max(all_n[row], 1))) else 0.0
            rows_left = int(lefts[row, f])
            node |= {"f": f, "b": b, "rows_left": rows_left, "null_left": bool(side) if missing else rows_left * 2 >= all_n[row],
                     "g_left": int(h[row, f, :b + 1, 0].sum() + (h[row, f, MISSING, 0] if side else 0))}
            parent = self.nodes[node["parent"]]["path"] if node["parent"] >= 0 else np.inf
            node["path"] = min(parent, node["gain"])

    def alike(self, missing: np.ndarray, nodes: int) -> list[tuple[np.ndarray, int, bool]]:
        """Features in groups, with their bins and whether NULL may go to either side: what a feature has no rows for is not
        computed. A level of few nodes is one group."""
        ends = np.array([len(self.edges[f]) for f in self.features])
        kinds = 2 * np.searchsorted(WIDTHS, ends) + missing if nodes > FEW_NODES else np.zeros(len(ends), np.int64)
        groups = [np.flatnonzero(kinds == kind) for kind in np.unique(kinds)]
        return [(some, int(ends[some].max()), bool(missing[some].any())) for some in groups if ends[some].any()]

    def best(self) -> set[int]:
        """The splits that the leaf-wise tree has, as far as nodes are evaluated."""
        open_ = [i for i, node in enumerate(self.nodes) if node.get("path", 0) > 0 and node["depth"] < self.params.depth]
        return set(sorted(open_, key=lambda i: (-self.nodes[i]["path"], i))[:self.params.leaves - 1])

    def finished(self) -> Tree:
        return self.tree(self.best())

    def bare(self) -> Growing:
        """What tasks need of it: the nodes without their histograms."""
        return replace(self, nodes=[{k: v for k, v in node.items() if k != "histogram"} for node in self.nodes])


@dataclass
class Block:
    """Rows of one block: bins (row, feature), targets (row, target), predictions (row, target at first, then model), part of the
    split, row key."""

    bins: np.ndarray
    targets: np.ndarray
    predictions: np.ndarray
    part: np.ndarray
    key: np.ndarray

    def columns(self) -> list[bytes]:
        return [x.tobytes() for x in (self.bins, self.targets, self.predictions, self.part, self.key)]

    @classmethod
    def of(cls, parts: list[bytes], features: int, targets: int) -> Block:
        bins, target, predictions, part, key = parts
        return cls(np.frombuffer(bins, np.uint8).reshape(-1, features), np.frombuffer(target).reshape(-1, targets),
                   np.frombuffer(predictions).reshape(len(part), -1), np.frombuffer(part, np.uint8), np.frombuffer(key, np.int64))

    def sampled(self, params: BoostParams, tree: int) -> np.ndarray:
        """Train rows of a tree's sample, by a hash of row and tree."""
        train = self.part == TRAIN
        if params.subsample >= 1:
            return train
        mark = np.random.SeedSequence([params.seed, tree]).generate_state(1, np.uint64)[0]
        h = self.key.view(np.uint64) ^ mark
        for _ in range(2):
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
        return train & ((h >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 < params.subsample)

    def histograms(self, growing: Growing, model: int, predictions: np.ndarray, tree: int) -> dict[int, np.ndarray]:
        if not growing.wanted:
            return {}
        rows = np.flatnonzero(self.sampled(growing.params, tree) & ~np.isnan(self.targets[:, model]))
        slot = np.full(len(growing.nodes), -1)
        slot[growing.wanted] = np.arange(len(growing.wanted))
        numbers = growing.tree()
        # Nodes of the partial tree are numbered breadth first, as they were made.
        own = slot[numbers.leaves_of_bins(self.bins[rows])]
        rows, own = rows[own >= 0], own[own >= 0]
        shape = (len(growing.wanted), len(growing.features), BINS + 1)
        size = int(np.prod(shape))
        both = np.zeros((size, 2), np.int64)
        for start in range(0, len(rows), BLOCK_ROWS):  # one piece for a block, several where a task has all rows
            some, mine = rows[start:start + BLOCK_ROWS], own[start:start + BLOCK_ROWS]
            residuals = np.rint((predictions[some] - self.targets[some, model]) * growing.scale)
            at = ((mine[:, None] * shape[1] + np.arange(shape[1])) * shape[2] + self.bins[np.ix_(some, growing.features)]).ravel()
            both[:, 0] += np.bincount(at, np.repeat(residuals, shape[1]), size).astype(np.int64)
            both[:, 1] += np.bincount(at, minlength=size)
        return dict(zip(growing.wanted, both.reshape(*shape, 2)))


def tree_features(params: BoostParams, tree: int, count: int) -> np.ndarray:
    """The features a tree may use."""
    if params.feature_share >= 1:
        return np.arange(count)
    draw = np.random.default_rng([params.seed, tree])
    return np.sort(draw.choice(count, max(1, round(params.feature_share * count)), replace=False))


@dataclass
class BoostedTrees:
    """A fitted model over ``features``, read from a column of double arrays in that order."""

    features: list[str]
    base: float
    trees: list[Tree]
    errors: list[float] = field(default_factory=list)

    def predict(self, values: np.ndarray) -> np.ndarray:
        found = np.full(len(values), self.base)
        for tree in self.trees:
            found += tree.predict(values)
        return found

    def prediction(self, column: str = "raw") -> Column:
        """Scored in Arrow batches; the model goes to the tasks with the function."""
        base, trees = self.base, self.trees

        @F.pandas_udf("double")
        def score(rows: pd.Series) -> pd.Series:
            values = np.stack([np.asarray(r, dtype=np.float64) for r in rows]) if len(rows) else np.empty((0, 0))
            found = np.full(len(rows), base)
            for tree in trees:
                found += tree.predict(values)
            return pd.Series(found)

        return score(F.col(column))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        rows = [(i, k, int(t.feature[k]), int(t.bin[k]), float(t.threshold[k]), bool(t.null_left[k]), int(t.left[k]), int(t.right[k]), float(t.value[k]))
                for i, t in enumerate(self.trees) for k in range(len(t.feature))]
        spark.createDataFrame(rows, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(self.features, self.base, len(self.trees), self.errors)], HEAD_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        head = spark.read.schema(HEAD_SCHEMA).json(f"{path}/head").first()
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])  # as large as the model
        trees = [Tree(*(g[c].to_numpy() for c in ("feature", "bin", "threshold", "null_left", "left", "right", "value")))
                 for _, g in nodes.groupby("tree", sort=True)]
        return cls(list(head.features), head.base, trees, list(head.errors or []))


NODE_SCHEMA = ("tree int, node int, feature long, bin long, threshold double, null_left boolean, left long, right long, value double")
HEAD_SCHEMA = "features array<string>, base double, trees int, errors array<double>"


# --- binning

def bin_edges(train: DataFrame, raw: str, count: int, accuracy: int = 10_000) -> list[np.ndarray]:
    """Upper ends of the bins of every feature, at most ``BINS``: its values where they are few, else quantiles to within a
    share of 1 / ``accuracy`` of the rows. One pass; a feature without values has none."""
    shares = F.lit([i / BINS for i in range(1, BINS)])
    found = train.agg(*[F.percentile_approx(F.nullif(F.col(raw)[i], F.lit(float("nan"))), shares, accuracy).alias(str(i)) for i in range(count)]).first()
    return [np.unique(np.array(found[i] or [], dtype=np.float64)) for i in range(count)]


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(values.shape, dtype=np.uint8)
    for f, own in enumerate(edges):
        out[:, f] = np.where(np.isnan(values[:, f]), MISSING, np.searchsorted(own, values[:, f], "left"))
    return out


def blocker(edges: list[np.ndarray], bases: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(parts: list[tuple]) -> pa.RecordBatch:
            values, targets, part, key = (np.concatenate([p[i] for p in parts]) for i in range(4))
            block = Block(binned(values, edges), targets, np.tile(np.array(bases), (len(values), 1)), part, key)
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in block.columns()], names=BLOCK_COLUMNS)

        held, rows = [], 0
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(edges))
            targets = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(bases))
            held.append((values, targets, batch.column(2).to_numpy().astype(np.uint8), batch.column(3).to_numpy()))
            rows += len(values)
            if rows >= BLOCK_ROWS:
                yield emit(held)
                held, rows = [], 0
        if rows:
            yield emit(held)
    return run


BLOCK_COLUMNS = ["bins", "targets", "predictions", "part", "key"]
BLOCK_SCHEMA = ", ".join(f"{c} binary" for c in BLOCK_COLUMNS)


@dataclass
class Frame:
    """Binned rows in blocks, and what the models start from."""

    blocks: DataFrame
    edges: list[np.ndarray]
    bases: list[float]
    scales: list[float]
    rows: int


def frame_of(rows: DataFrame, features: list[str], targets: list[str], raw: str = "raw", split: str = "split", key: Column | None = None) -> Frame:
    """``rows`` with a column of double arrays, target columns and the split's part, in blocks. ``key`` tells rows apart for
    sampling; rows without target neither train nor count as errors."""
    train = rows.filter(F.col(split) == "train")
    facts = train.agg(F.count("*").alias("rows"), *[f(F.col(t).cast("double")).alias(f"{n}{i}") for i, t in enumerate(targets)
                                                   for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))]).first()
    bases = [facts[f"avg{i}"] or 0.0 for i in range(len(targets))]
    largest = [max(abs((facts[f"{end}{i}"] or 0.0) - bases[i]) for end in ("min", "max")) for i in range(len(targets))]
    edges = bin_edges(train, raw, len(features))
    part = F.when(F.col(split) == "train", TRAIN).when(F.col(split) == "valid", VALID).otherwise(0)
    count = rows.count()
    tasks = max(1, -(-count // BLOCK_ROWS))
    chosen = rows.select(raw, F.array(*[F.col(t).cast("double") for t in targets]), part.cast("int"),
                         (F.xxhash64(raw) if key is None else key).cast("long")).coalesce(tasks)
    blocks = materialize(chosen.mapInArrow(blocker(edges, bases), BLOCK_SCHEMA))
    return Frame(blocks, edges, bases, [FIXED_POINT / (x or 1.0) for x in largest], count)


# --- passes over all rows

@dataclass
class Fit:
    """A model being fitted: its number, target and column of predictions, the trees since its predictions were last written, and
    the one that grows."""

    model: int
    target: int
    column: int
    params: BoostParams
    step: int = 0
    growing: Growing | None = None
    recent: list[Tree] = field(default_factory=list)
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)

    def asked(self) -> Fit:
        """What tasks need of it."""
        return replace(self, growing=self.growing and self.growing.bare(), trees=[], errors=[])


def up_to_date(block: Block, fit: Fit) -> np.ndarray:
    found = block.predictions[:, fit.column].copy()
    for tree in fit.recent:
        found += tree.value[tree.leaves_of_bins(block.bins)]
    return found


def passer(fits: list[Fit], features: int, targets: int, errors: bool):
    """(model, node, sums): a task's histograms of the nodes wanted; node -1 has the valid part's absolute errors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}

        def add(key: tuple[int, int], value: np.ndarray) -> None:
            sums[key] = sums[key] + value if key in sums else value

        for batch in batches:
            for i in range(batch.num_rows):
                block = Block.of([c[i].as_py() for c in batch.columns], features, targets)
                for fit in fits:
                    now = up_to_date(block, fit)
                    for node, found in block.histograms(fit.growing, fit.target, now, fit.step).items():
                        add((fit.model, node), found)
                    if errors:
                        apart = np.abs(now - block.targets[:, fit.target])[block.part == VALID]
                        apart = apart[~np.isnan(apart)]
                        add((fit.model, -1), np.array([apart.sum(), len(apart)]))
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
                 pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["model", "node", "sums"])
    return run


SUM_SCHEMA = "model int, node int, sums binary"


def read_sums(node: int, sums: bytes) -> np.ndarray:
    return np.frombuffer(sums, np.float64 if node < 0 else np.int64)


def add_up(group: pd.DataFrame) -> pd.DataFrame:
    node = int(group["node"].iloc[0])
    total = read_sums(node, group["sums"].iloc[0]).copy()
    for more in group["sums"].iloc[1:]:
        total += read_sums(node, more)
    return pd.DataFrame({"model": group["model"].iloc[:1], "node": [node], "sums": [total.tobytes()]})


def summed(partial: DataFrame, parts: int, size: int) -> dict[tuple[int, int], np.ndarray]:
    """Sums of all tasks, ``size`` bytes each: few are added here; more in two rounds, so that no task and not the driver gets them
    all."""
    if parts > DIRECT_PARTS or parts * size > DIRECT_BYTES:
        salted = partial.withColumn("salt", F.spark_partition_id() % SPREAD)
        partial = salted.groupBy("model", "node", "salt").applyInPandas(add_up, SUM_SCHEMA).groupBy("model", "node").applyInPandas(add_up, SUM_SCHEMA)
    found: dict[tuple[int, int], np.ndarray] = {}
    for row in partial.collect():  # nodes x features x bins
        key, value = (row["model"], row["node"]), read_sums(row["node"], row["sums"])
        found[key] = found[key] + value if key in found else value
    return found


def updater(fits: list[Fit], features: int, targets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block.of([c[i].as_py() for c in batch.columns], features, targets)
                block.predictions = np.stack([up_to_date(block, fit) for fit in fits], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in block.columns()], names=BLOCK_COLUMNS)
    return run


def fit_boosted(rows: DataFrame, features: list[str], models: dict[str, tuple[str, BoostParams]], raw: str = "raw", split: str = "split",
                key: Column | None = None) -> dict[str, BoostedTrees]:
    """Fit several models of the same rows in shared passes. ``models``: target column and parameters by name.

    Rows of the train part teach; ``errors`` of a model has the valid part's mean absolute error before each tree and after
    the last, NaN without valid rows. Without train rows a model has no tree and predicts 0; a target that is NULL does not
    teach; ``trees`` may be 0.
    """
    frame = frame_of(rows, features, [target for target, _ in models.values()], raw, split, key)
    if frame.blocks.count() == 1:
        return fit_in_tasks(frame, features, models)
    fits = fit_in_passes(frame, len(features), [(i, params) for i, (_, params) in enumerate(models.values())])
    return {name: BoostedTrees(features, frame.bases[f.target], f.trees, f.errors) for name, f in zip(models, fits)}


def fit_in_passes(frame: Frame, features: int, models: list[tuple[int, BoostParams]], keep: bool = True) -> list[Fit]:
    """Models, as a target's number and parameters, grown side by side. Without ``keep`` only their errors are kept, not their trees."""
    blocks, spark, written = frame.blocks, frame.blocks.sparkSession, []
    parts, targets = blocks.rdd.getNumPartitions(), len(frame.bases)
    fits = [Fit(i, target, target, params) for i, (target, params) in enumerate(models)]
    try:
        for step in range(max((f.params.trees for f in fits), default=0) + 1):
            active = [f for f in fits if step <= f.params.trees]
            for f in active:
                f.step = step
                f.growing = Growing(f.params, frame.edges, tree_features(f.params, step, features), frame.scales[f.target])
                if step == f.params.trees:  # only the errors are wanted
                    f.growing.wanted = []
            first = True
            while active and (first or any(f.growing.wanted for f in active)):
                asked = [f for f in active if first or f.growing.wanted]
                size = sum(len(f.growing.wanted) * len(f.growing.features) * (BINS + 1) * 16 for f in asked)
                found = summed(blocks.mapInArrow(passer([f.asked() for f in asked], features, targets, first), SUM_SCHEMA), parts, size)
                for f in asked:
                    if first and (error := found.get((f.model, -1))) is not None:
                        f.errors.append(float(error[0] / error[1]) if error[1] else float("nan"))
                    if f.growing.wanted:
                        shape = (len(f.growing.features), BINS + 1, 2)
                        zero = np.zeros(shape, np.int64)
                        f.growing.give({n: found[f.model, n].reshape(shape) if (f.model, n) in found else zero for n in f.growing.wanted})
                first = False
            for f in active:
                if step < f.params.trees:
                    f.recent.append(f.growing.finished())
                    f.trees += f.recent[-1:] if keep else []
                f.growing = None
            if max(len(f.recent) for f in fits) >= INTERVAL:
                written.append(work_dir(spark))
                blocks = materialize(blocks.mapInArrow(updater([f.asked() for f in fits], features, targets), BLOCK_SCHEMA), written[-1])
                parts = blocks.rdd.getNumPartitions()
                if len(written) > 1:  # one table of predictions at a time
                    discard(spark, written.pop(0))
                for f in fits:
                    f.recent, f.column = [], f.model
    finally:
        for path in written:
            discard(spark, path)
    return fits


def fit_in_tasks(frame: Frame, features: list[str], models: dict[str, tuple[str, BoostParams]]) -> dict[str, BoostedTrees]:
    """The same for rows that are one block: a pass's sums are those of its only task then, so the loop over trees runs inside
    it, a task for each model, with the same result."""
    params = [p for _, p in models.values()]
    each = frame.blocks.withColumn("model", F.explode(F.array(*map(F.lit, range(len(params))))))
    grown = each.repartitionByRange(len(params), "model").mapInArrow(
        whole_fitter(params, frame.edges, frame.scales), "model int, state binary").collect()  # as large as the models
    states = {row["model"]: pickle.loads(row["state"]) for row in grown}
    return {name: BoostedTrees(features, frame.bases[i], [Tree(*t) for t in states[i][0]], states[i][1]) for i, name in enumerate(models)}


def whole_fitter(params: list[BoostParams], edges: list[np.ndarray], scales: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                *columns, model = (c[i].as_py() for c in batch.columns)
                fit = LocalFit(Block.of(columns, len(edges), len(params)), model, params[model], edges, scales[model])
                fit.grow(params[model].trees, params[model].trees + 1)
                yield pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([fit.state()], pa.binary())], names=["model", "state"])
    return run


# --- many models of the same rows

def staged_errors(frame: Frame, features: int, models: list[tuple[int, BoostParams]]) -> list[list[float]]:
    """The valid part's mean absolute error of every model, a target's number and parameters, before each tree and after the last.
    Every model is fitted on all train rows to its last tree."""
    if not frame.rows:
        return [[float("nan")] * (params.trees + 1) for _, params in models]
    if frame.rows * (features + 25) <= TASK_BYTES:
        return errors_in_tasks(frame, features, models)
    found: list[list[float]] = []
    for wave in waves(features, models):
        found += [fit.errors for fit in fit_in_passes(frame, features, wave, keep=False)]
    return found


def waves(features: int, models: list[tuple[int, BoostParams]]) -> list[list[tuple[int, BoostParams]]]:
    """Models in their order, as many together as ask for ``WAVE_BYTES`` of histograms at most, or one."""
    found, held = [], WAVE_BYTES + 1
    for target, params in models:
        nodes = max(1, min(params.leaves - 1, 2 ** max(0, params.depth - 2)))  # of two siblings one is asked for
        size = nodes * len(tree_features(params, 0, features)) * (BINS + 1) * 16
        if held + size > WAVE_BYTES:
            found.append([])
            held = 0
        found[-1].append((target, params))
        held += size
    return found


def errors_in_tasks(frame: Frame, features: int, models: list[tuple[int, BoostParams]]) -> list[list[float]]:
    """A job of one task each model, which reads all blocks from their table; the longest first, as many at once as there are cores.
    A union of them would be one task, as each has a single partition."""
    spark = frame.blocks.sparkSession
    longest = sorted(range(len(models)), key=lambda i: (-models[i][1].trees * min(models[i][1].leaves, 2 ** models[i][1].depth), i))

    def fitted(i: int) -> tuple[int, list[float]]:
        fitter = error_fitter(*models[i], frame.edges, frame.bases, frame.scales)
        return i, list(frame.blocks.coalesce(1).mapInArrow(fitter, "errors array<double>").first()["errors"])  # a number a tree

    with ThreadPoolExecutor(max(1, min(len(models), spark.sparkContext.defaultParallelism))) as pool:
        found = dict(pool.map(inheritable_thread_target(spark)(fitted), longest))
    return [found[i] for i in range(len(models))]


def error_fitter(target: int, params: BoostParams, edges: list[np.ndarray], bases: list[float], scales: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block.of([c[i].as_py() for c in batch.columns], len(edges), len(bases))
                parts.append((block.bins, block.targets[:, [target]], block.predictions[:, [target]], block.part, block.key))
        block = Block(*map(np.concatenate, zip(*parts)))
        del parts
        order = np.argsort(block.key, kind="stable")  # the errors' last bits do not depend on how rows are partitioned
        block = Block(*(x[order] for x in vars(block).values()))
        fit = LocalFit(block, 0, params, edges, scales[target])
        fit.grow(params.trees, params.trees + 1)
        yield pa.RecordBatch.from_arrays([pa.array([fit.errors], pa.list_(pa.float64()))], names=["errors"])
    return run


# --- one task's rows

@dataclass
class LocalFit:
    """A fit of rows that a task holds, tree after tree."""

    block: Block
    model: int
    params: BoostParams
    edges: list[np.ndarray]
    scale: float
    trees: list[Tree] = field(default_factory=list)
    #: Valid mean absolute error after as many trees as its place says.
    errors: list[float] = field(default_factory=list)

    def __post_init__(self):
        self.now = self.block.predictions[:, self.model].copy()
        for tree in self.trees:
            self.now += tree.value[tree.leaves_of_bins(self.block.bins)]
        if not self.errors:
            self.errors.append(self.error())

    def error(self) -> float:
        apart = np.abs(self.now - self.block.targets[:, self.model])[self.block.part == VALID]
        apart = apart[~np.isnan(apart)]
        return float(apart.mean()) if len(apart) else float("nan")

    def grow(self, until: int, patience: int) -> None:
        """Up to ``until`` trees; ends when the last ``patience`` did not improve the error."""
        while len(self.trees) < until:
            best = int(np.nanargmin(self.errors)) if not np.isnan(self.errors).all() else len(self.errors) - 1
            if len(self.errors) - 1 - best >= patience:
                break
            step = len(self.trees)
            growing = Growing(self.params, self.edges, tree_features(self.params, step, len(self.edges)), self.scale)
            while growing.wanted:
                growing.give(self.block.histograms(growing, self.model, self.now, step))
            self.trees.append(growing.finished())
            self.now += self.trees[-1].value[self.trees[-1].leaves_of_bins(self.block.bins)]
            self.errors.append(self.error())

    def state(self) -> bytes:
        return pickle.dumps(([tuple(vars(t).values()) for t in self.trees], self.errors))
