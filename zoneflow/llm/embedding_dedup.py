"""Near copies among embeddings by random-hyperplane signs.

In each of several tables the signs against random hyperplanes name a vector's bucket. Vectors that share a bucket are
compared exactly, in double precision, by blocked matrix products; a pair that shares several buckets counts in the
first one only. Links are counted where they are found and components are built from a spanning part of them, so no task
and no shuffle holds all pairs of a bucket. Buckets beyond ``block`` vectors are cut into blocks, each pair of blocks
being a group of its own; equal vectors are one class with a multiplicity.

The number of planes grows with the logarithm of the largest label's rows, which keeps the usual bucket near
``bucket_rows``; the number of tables follows so that a pair at the threshold is missed with a chance of at most ``miss``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.components import connected_components
from zoneflow.session import materialize

SEED = 20_240_131


def planes_and_tables(rows: int, threshold: float, bucket_rows: int, miss: float) -> tuple[int, int]:
    """How many planes a table has, and how many tables."""
    planes = min(62, max(1, math.ceil(math.log2(max(2, rows / bucket_rows)))))
    together = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, max(1, math.ceil(math.log(miss) / math.log1p(-together)))


def hyperplanes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, count))


def usable(values: list | None) -> np.ndarray | None:
    """The vector in double precision; None where it can link with nothing."""
    if not values or any(v is None for v in values):
        return None
    vector = np.asarray(values, dtype=np.float64)
    return vector if np.isfinite(vector).all() and vector.any() else None


def with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds dim and digest, both NULL for vectors that link with nothing."""
    for batch in batches:
        dims, digests = [], []
        for values in batch.column(2).to_pylist():
            vector = usable(values)
            dims.append(None if vector is None else len(vector))
            # + 0.0 makes one zero of both.
            digests.append(None if vector is None else hashlib.blake2b((vector + 0.0).tobytes(), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(dims, pa.int32()), pa.array(digests, pa.binary())],
            names=["id", "label", "vector", "dim", "digest"])


def signer(planes: int, tables: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        powers = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
        for batch in batches:
            signs = []
            for values in batch.column(1).to_pylist():
                vector = np.asarray(values, dtype=np.float64)
                if len(vector) not in known:
                    known[len(vector)] = hyperplanes(len(vector), planes * tables)
                above = (vector @ known[len(vector)] > 0).reshape(tables, planes)
                signs.append(above @ powers)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tolist() for s in signs], pa.list_(pa.int64()))], names=["cls", "signs"])
    return sign


def compare(threshold: float):
    """Of one pair of blocks: each vector's links, weighted by multiplicity, and edges that span what is linked."""

    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rows of index pairs with a cosine of at least the threshold."""
        unit_x = x / np.linalg.norm(x, axis=1, keepdims=True)
        unit_y = y / np.linalg.norm(y, axis=1, keepdims=True)
        cosine = unit_x @ unit_y.T
        for i, j in zip(*np.nonzero(np.abs(cosine - threshold) < 1e-9), strict=True):
            cosine[i, j] = math.fsum(x[i] * y[j]) / math.sqrt(math.fsum(x[i] * x[i])) / math.sqrt(math.fsum(y[j] * y[j]))
        return np.argwhere(cosine >= threshold)

    def links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        table, low, high = int(key[2]), key[4], key[5]
        rows = rows.sort_values("cls", kind="stable").reset_index(drop=True)
        own = rows["own"].to_numpy()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        vectors, signs = np.stack(rows["vector"].to_list()).astype(np.float64), np.stack(rows["signs"].to_list())
        pairs = near(vectors[left], vectors[right]) if len(left) and len(right) else np.empty((0, 2), int)
        a, b = left[pairs[:, 0]], right[pairs[:, 1]]
        if low == high:
            a, b = a[(upper := a < b)], b[upper]
        first = ~(signs[a, :table] == signs[b, :table]).any(axis=1)
        a, b = a[first], b[first]
        weight = rows["mult"].to_numpy(np.float64)
        count = np.bincount(a, weight[b], len(rows)) + np.bincount(b, weight[a], len(rows))
        # Only links that join what earlier ones leave apart are needed as edges.
        root = np.arange(len(rows))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        edges = []
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            x, y = find(i), find(j)
            if x != y:
                root[max(x, y)] = min(x, y)
                edges.append((i, j))
        rep, cls = rows["rep"].to_numpy(), rows["cls"].to_numpy()
        linked = np.flatnonzero(count)
        return pd.concat([
            pd.DataFrame({"cls": cls[linked], "links": count[linked].astype(np.int64)}),
            pd.DataFrame({"a": rep[[e[0] for e in edges]], "b": rep[[e[1] for e in edges]]}, dtype="Int64"),
        ]).reindex(columns=["cls", "links", "a", "b"]).astype("Int64")

    return links


def near_copies(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                label_col: str = "label", bucket_rows: int = 256, block: int = 512, miss: float = 1e-6) -> DataFrame:
    """One row per row of ``vectors``: id_col, n_links, component_id, kept.

    Only vectors of the same label and length are compared. Vectors without label, that are NULL, empty, zero or have
    NULL or non-finite components link with nothing and are their own component. Rows that repeat are vectors of
    their own, so they are linked. Empty tables give no rows; other columns are ignored.
    """
    chosen = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                            F.col(vector_col).cast("array<double>").alias("vector"))
    rows = materialize(chosen.mapInArrow(
        with_digest, "id long, label string, vector array<double>, dim int, digest binary"))
    comparable = rows.filter("digest is not null and label is not null")
    classes = materialize(
        comparable.groupBy("label", "dim", "digest")
        .agg(F.min("id").alias("rep"), F.count("*").alias("mult"), F.first("vector").alias("vector"))
        .withColumn("cls", F.monotonically_increasing_id()))
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    planes, tables = planes_and_tables(largest, threshold, bucket_rows, miss)
    signed = materialize(classes.select("cls", "vector").mapInArrow(signer(planes, tables), "cls long, signs array<long>"))

    facts = classes.join(signed, "cls")
    seats = facts.select("cls", "label", "dim", F.posexplode("signs").alias("t", "sig"))
    bucket = ["label", "dim", "t", "sig"]
    shared = seats.groupBy(*bucket).agg(F.count("*").alias("n")).filter("n > 1")
    shared = shared.select(*bucket, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    seated = (
        seats.join(shared, bucket)
        .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cls", "t", "sig", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")))
    compared = (
        seated.join(facts, "cls").groupBy("label", "dim", "t", "sig", "low", "high")
        .applyInPandas(compare(threshold), "cls long, links long, a long, b long"))
    compared = materialize(compared)

    counts = compared.filter("cls is not null").groupBy("cls").agg(F.sum("links").alias("links"))
    found = connected_components(compared.filter("a is not null").select("a", "b"))
    facts = (classes.select("label", "dim", "digest", "rep", "mult", "cls")
             .join(counts, "cls", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left"))
    component = F.coalesce("component", "rep", "id")
    return rows.select("id", "label", "dim", "digest").join(facts, ["label", "dim", "digest"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("mult") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
