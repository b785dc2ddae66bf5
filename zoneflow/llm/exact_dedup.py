"""Exact copies by a content sort.

Rows are range-partitioned by their normalised text at sampled splitters and sorted there (Spark's sort spills), so equal
texts are neighbours. A window over the text then compares each row with the one before it in full, and the first of
a run stays. The range partitioning already clusters the window's key, so the texts are shuffled once. The splitters
are the text's first ``SPLITTER_CHARS`` characters and then its hash, as whole sampled texts would grow on the
driver; the sort and the comparison within a partition take the whole text.

A text that many rows share would be one key in one task. Texts with more than ``hot_rows`` copies are therefore
found first by counting hashes (combined before the shuffle) and their groups are aggregated by full text, also
combined before the shuffle; in the sort their rows get a salt that spreads them. There are at most
``rows / hot_rows`` <= 1,000 such texts, which bounds the broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.session import materialize

LEAST_HOT_ROWS, HOT_TEXTS = 64, 1000
SPLITTER_CHARS = 32


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                normalise: Callable[[Column], Column] | None = None, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size, kept, text_sha256.

    ``keep`` is ``min`` or ``max``: which id of a group stays. ``carry`` adds a struct ``row`` with all columns of
    ``docs``. A NULL text counts as empty. Equal texts without an id (NULL) lose against those with one. Of rows that
    repeat with their id exactly one is kept. Empty tables give no rows; other columns of any name are ignored or,
    with ``carry``, stay inside ``row``.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    first = F.col("id").asc_nulls_last() if keep == "min" else F.col("id").desc_nulls_last()
    best = F.min("id") if keep == "min" else F.max("id")
    body = F.coalesce(normalise(F.col(text_col)) if normalise else F.col(text_col), F.lit(""))
    # Without a normaliser the text itself is the sort key and need not travel twice.
    others = [c for c in docs.columns if normalise or c != text_col] if carry else [id_col]
    rows = docs.select(
        F.col(id_col).alias("id"), F.struct(*others, F.col(text_col).isNull().alias("no text")).alias("rest"),
        body.alias("body")).withColumn("h", F.xxhash64("body"))

    hot_rows = max(LEAST_HOT_ROWS, -(-docs.count() // HOT_TEXTS))
    often = materialize(rows.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows).select("h"))
    hot = materialize(
        rows.select("id", "h", "body").join(F.broadcast(often), "h").groupBy("h", "body")
        .agg(best.alias("hot_keep"), F.count("*").alias("hot_size"))
        .select("h", F.sha2("body", 256).alias("hot_sha"), "hot_keep", "hot_size",
                F.ceil(F.col("hot_size") / hot_rows).alias("salts")))

    salted = (
        rows.withColumn("sha", F.sha2("body", 256))
        .join(F.broadcast(hot.withColumnRenamed("h", "hot_h")),
              (F.col("h") == F.col("hot_h")) & (F.col("sha") == F.col("hot_sha")), "left")
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("salts")), F.lit(0))))
    run = Window.partitionBy("head", "h", "salt", "body")
    marked = (
        salted.withColumn("head", F.substring("body", 1, SPLITTER_CHARS)).repartitionByRange("head", "h", "salt")
        .withColumn("place", F.row_number().over(run.orderBy(first)))
        .withColumn("near_keep", F.first("id").over(run.orderBy(first)))
        .withColumn("near_size", F.count("*").over(run))
        .withColumn("keep_id", F.when(F.col("hot_size").isNull(), F.col("near_keep")).otherwise(F.col("hot_keep"))))
    columns = [
        F.col("id").alias(id_col), "keep_id", F.coalesce("hot_size", "near_size").cast("long").alias("group_size"),
        ((F.col("place") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256")]
    if carry:
        text = F.col(f"rest.`{text_col}`") if normalise else F.when(~F.col("rest.no text"), F.col("body"))
        columns.append(F.struct(*[(text if c == text_col else F.col(f"rest.`{c}`")).alias(c)
                                  for c in docs.columns]).alias("row"))
    return marked.select(*columns)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    return mark_copies(docs, id_col, text_col, keep, normalise, carry=True).filter("kept").select("row.*")
