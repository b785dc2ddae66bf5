"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: What separates words; the complement of the words' class ``[^\x20\x09-\x0D]+``.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case; other letters as they are."""
    return F.translate(c, UPPER, LOWER)


def word_array(text: Column, separators: str) -> Column:
    """The words of a text: what stands between runs of ``separators``. NULL counts as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def word_count(text: Column) -> Column:
    """How many words ``[^\\x20\\x09-\\x0D]+`` a text has, as long. NULL counts as empty."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"\A{SPACES}|{SPACES}\z", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")


def id_hash_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(modulus))


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Totals of at most so many groups are broadcast, some megabytes; more are joined by salted keys.
BROADCAST_GROUPS, SALTS = 50_000, 32


def with_group_total(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows``, a written table, with the sum of ``value`` over equal keys; NULL keys are one group."""
    totals = materialize(rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(name)))
    if totals.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(totals), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    # A key that holds a large part of all rows meets its total in as many tasks as there are salts.
    spread = totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_own", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_own") == F.col("_salt"))
    return salted.join(spread, same, "left").drop("_key", "_salt", "_own")


def release_memory() -> None:
    """Gives a Python worker's free memory back. Workers are used again by later stages, and what one stage leaves in them
    counts against the next one's."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def frees_memory(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that releases its worker's memory when its task ends."""
    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory()
    return wrapped


#: Bytes of a batch of rows on its way to a Python worker.
BATCH_BYTES = "4m"


def in_small_batches(rows: DataFrame) -> DataFrame:
    """``rows``, whose session from now on hands rows to Python in batches of some megabytes: batches of many long texts would
    take several times their size in the JVM and in the worker."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return rows
