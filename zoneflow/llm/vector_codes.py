"""Compression of vectors to one byte a part, with codebooks trained by exact nearest-entry search.

Every component becomes an integer, a vector is cut into equal consecutive parts, and each part position has a codebook.
The nearest entry of a part is found by slicing and intersecting bitmasks: per dimension the entries' coordinates are sorted
and carry prefix masks (bit e of mask i says that entry e is among the first i), so the entries within a radius of a
coordinate are one mask without another. The masks of all dimensions are ANDed; what is left holds every entry within
the radius, and only these are compared. Where the best of them lies within the radius it is the nearest; otherwise the
radius becomes its distance, or doubles where nothing was left. The result is exact, ties included.

A pass assigns all parts in the tasks and sums them by entry there; the driver gets one row per coordinate of the codebooks,
whose size the parameters bound. The integers are written once to the shared folder, so a lost executor costs one pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.common import with_group_total
from zoneflow.session import materialize

#: Components saturate here, so that squared distances fit 64 bits.
LIMIT = 2 ** 27
FULL = np.uint64(2 ** 64 - 1)


class MaskedEntries:
    """The entries of one codebook, at most 64 to a mask word."""

    def __init__(self, entries: np.ndarray, radius: int | None = None):
        self.entries = np.asarray(entries, dtype=np.int64)
        count, width = self.entries.shape
        words = (count + 63) // 64
        self.order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, self.order, axis=0)
        self.prefix = np.zeros((width, count + 1, words), dtype=np.uint64)
        for d in range(width):
            for i, e in enumerate(self.order[:, d].tolist()):
                self.prefix[d, i + 1] = self.prefix[d, i]
                self.prefix[d, i + 1, e // 64] |= np.uint64(1) << np.uint64(e % 64)
        # Where points lie as entries do, half of the spread of a dimension holds a nearest entry as a rule.
        spread = self.entries.max(axis=0) - self.entries.min(axis=0) if width else np.zeros(1, np.int64)
        self.radius = max(1, int(spread.max()) // 2) if radius is None else radius

    def within(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that differ from a point by at most its radius in every dimension."""
        masks = np.full((len(points), self.prefix.shape[2]), FULL)
        for d in range(points.shape[1]):
            low = np.searchsorted(self.sorted[:, d], points[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], points[:, d] + radius, "right")
            masks &= self.prefix[d, high] & ~self.prefix[d, low]
        return masks

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, its squared distance) of every point; ties go to the lower index."""
        count = len(self.entries)
        index, best = np.zeros(len(points), np.int64), np.full(len(points), np.iinfo(np.int64).max)
        if not points.shape[1]:
            return index, np.zeros(len(points), np.int64)
        pending, radius = np.arange(len(points)), np.full(len(points), self.radius, dtype=np.int64)
        while len(pending):
            masks = self.within(points[pending], radius[pending])
            for e in range(count):
                at = pending[(masks[:, e // 64] >> np.uint64(e % 64)) & np.uint64(1) == 1]
                apart = points[at] - self.entries[e]
                distance = np.einsum("ij,ij->i", apart, apart)
                nearer = (distance < best[at]) | ((distance == best[at]) & (e < index[at]))
                best[at[nearer]], index[at[nearer]] = distance[nearer], e
            reached = best[pending] < np.iinfo(np.int64).max
            root = np.sqrt(best[pending].astype(np.float64)).astype(np.int64) + 1
            grown = np.where(reached, root, 2 * radius[pending] + 1)
            open_ = ~reached | (best[pending] > radius[pending] ** 2)
            radius[pending] = grown
            pending = pending[open_]
        return index, best


@dataclass(frozen=True)
class Codebooks:
    """Integer entries by part, entry and position within the part."""

    entries: np.ndarray
    #: What a component is multiplied by before it becomes an integer.
    scale: int

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def searches(self) -> list[MaskedEntries]:
        return [MaskedEntries(e) for e in self.entries]

    def assign(self, vectors: np.ndarray, searches: list[MaskedEntries]) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) by vector and part."""
        width = self.entries.shape[2]
        found = [s.nearest(vectors[:, p * width:(p + 1) * width]) for p, s in enumerate(searches)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def complete(vector: Column) -> Column:
    """Whether a vector is not NULL and has finite components only."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def integers(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * x) of every component, saturated at the limit."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x * float(scale), F.lit(float(limit))), F.lit(float(-limit)))).cast("int"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The lists of a column as rows; shorter ones end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == dim).all():
        return values.reshape(len(lengths), dim)
    found = np.zeros((len(lengths), dim), dtype=np.int64)
    found[np.arange(dim) < lengths[:, None]] = values
    return found


def summer(books: Codebooks):
    """(part, entry, at, total, n): a task's sums of the parts assigned to each entry."""
    parts, count, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = books.searches()
        totals, members = np.zeros((parts, count, width), np.int64), np.zeros((parts, count), np.int64)
        for batch in batches:
            vectors = matrix(batch.column(0), parts * width)
            entries, _ = books.assign(vectors, searches)
            for p in range(parts):
                np.add.at(totals[p], entries[:, p], vectors[:, p * width:(p + 1) * width])
                members[p] += np.bincount(entries[:, p], minlength=count)
        p, e, at = (x.ravel() for x in np.indices(totals.shape))
        used = members[p, e] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[used]) for x in (p, e, at, totals.ravel(), members[p, e])], names=["part", "entry", "at", "total", "n"])
    return run


def coder(books: Codebooks):
    """Two hex digits a part, and the squared distances summed over parts."""
    dim = books.parts * books.entries.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = books.searches()
        for batch in batches:
            entries, distances = books.assign(matrix(batch.column(2), dim), searches)
            codes = [row.tobytes().hex() for row in entries.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(distances.sum(axis=1))],
                names=["id", "label", "code", "error"])
    return run


def scaled(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, parts) of the vectors that take part, written once."""
    doubles = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    return materialize(doubles.filter(complete(F.col("v"))).select("id", "label", integers(F.col("v"), scale, LIMIT).alias("parts")))


def train(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Codebooks:
    """Codebooks of :func:`scaled` rows: the parts of the rows of smallest id, moved to their members' means."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    dim = rows.agg(F.max(F.size("parts"))).first()[0] or 0
    width = -(-dim // parts)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "parts").limit(entries).collect()
    start = np.zeros((len(first), parts * width), dtype=np.int64)
    for i, row in enumerate(first):
        start[i, :len(row["parts"])] = row["parts"]
    book = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) and width else 0):
        sums = rows.select("parts").mapInArrow(summer(Codebooks(book, scale)), "part long, entry long, at long, total long, n long")
        for row in sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            book[row["part"], row["entry"], row["at"]] = row["total"] // row["n"]
    return Codebooks(book, scale)


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, code, error) of :func:`scaled` rows."""
    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return rows.select("id", "label", "parts").mapInArrow(coder(books), schema)


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector that takes part: id_col, code, error, label_error, codebooks_sha256.

    Vectors that are NULL or hold NULL or non-finite components take no part. Vectors shorter than the longest, and lengths
    that ``parts`` does not divide, count as followed by zeros; integers beyond 2^27 saturate there. Of rows with equal id the
    smaller vector starts a codebook first, and a NULL id comes last. Repeated rows count each; with fewer rows than entries
    the codebooks are that much smaller; an empty table gives no rows. Other columns are ignored.
    """
    rows = scaled(vectors, scale, id_col, vector_col, label_col)
    books = train(rows, parts, entries, rounds, scale)
    coded = materialize(encode(rows, books))
    return with_group_total(coded, "label", "error", "label_error").select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def decode(codes: DataFrame, books: Codebooks, code_col: str = "code", vector_col: str = "decoded") -> DataFrame:
    """``codes`` with the vectors that its codes stand for; a NULL code gives NULL."""
    flat = [[[float(x) / books.scale for x in entry] for entry in part] for part in books.entries.tolist()]

    @F.pandas_udf("array<double>")
    def vectors(column):
        import pandas as pd

        return pd.Series([None if c is None else [x for p, e in enumerate(bytes.fromhex(c)) for x in flat[p][e]] for c in column])

    return codes.withColumn(vector_col, vectors(F.col(code_col)))
