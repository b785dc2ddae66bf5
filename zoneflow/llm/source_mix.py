"""Mixing sources to target weights.

The texts of a source form one stream of words, in the order of a hash of their ids, which is cut into blocks of a fixed
length. The mix is a list of slots, dealt into output shards of a fixed number of slots. Each shard draws how many of its
slots go to each source: first the whole part of what the source's share calls for, then the slots that remain by
multinomial draws from the fractional parts, so that counts are random but totals stay near their targets. A
source's slots are numbered through the shards; slot ``j`` takes the block at place ``j`` of a pseudorandom permutation of
the source's blocks, another permutation each time the blocks run out. Slots are joined to blocks by that index.

Streams and blocks are positions only: words are counted, and texts are cut where the mix is written. Running
totals are taken within buckets of the hash and then over the buckets' sums, so no task sees a whole source, and the
order does not depend on how many buckets there are.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import SPACES, word_array, word_count
from zoneflow.session import materialize

WEIGHTS, SHARE, MOST_TIMES = (5, 2, 1), Fraction(3, 2), 2
BLOCK, SHARD_SLOTS, SEED, ROUNDS = 64, 1024, 71, 4


@dataclass(frozen=True)
class Mix:
    """places: row, id, source_no, size, source_size, target, offset (in the source's stream), and ``rest`` with what was
    carried. slots: shard, source_no, block, times (how often the block was taken before)."""

    places: DataFrame
    slots: DataFrame
    block: int

    def pieces(self) -> DataFrame:
        """row, source_no, block, start (word within the text), length: how texts lie in blocks."""
        words = self.places.filter("size > 0").select("row", "source_no", "offset", "size")
        first, last = F.col("offset"), F.col("offset") + F.col("size") - 1
        words = words.withColumn("block", F.explode(F.sequence(
            F.floor(first / self.block).cast("long"), F.floor(last / self.block).cast("long"))))
        begin = F.greatest(F.col("block") * self.block, first)
        end = F.least((F.col("block") + 1) * self.block - 1, last) + 1
        return words.select("row", "source_no", "block", (begin - F.col("offset")).alias("start"), (end - begin).alias("length"))

    def taken(self) -> DataFrame:
        """row, taken: how many words the mix takes of each text it takes any of, repeats counted."""
        often = self.slots.groupBy("source_no", "block").agg(F.count("*").alias("n"))
        return (self.pieces().join(often, ["source_no", "block"])
                .groupBy("row").agg(F.sum(F.col("length") * F.col("n")).alias("taken")))

    def ranges(self) -> DataFrame:
        """row, times, ranges: the word ranges a text gives to the mix on its first, second, ... turn, in order."""
        own = self.pieces().join(self.slots.select("source_no", "block", "times"), ["source_no", "block"])
        return own.groupBy("row", "times").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("ranges"))


def targets(sizes: Sequence[int], weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE,
            most_times: int = MOST_TIMES) -> list[float]:
    """Target sizes of sources in their order: shares of ``share`` times all sizes by weight, none above ``most_times``
    its size. What a source cannot take is shared by weight among the others until none is above."""
    weight = [Fraction(weights[i % len(weights)]) for i in range(len(sizes))]
    found: list[Fraction | None] = [None] * len(sizes)
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    while open_:
        total = sum(weight[i] for i in open_)
        over = [i for i in open_ if left * weight[i] / total > most_times * sizes[i]]
        if not over:
            for i in open_:
                found[i] = left * weight[i] / total
            break
        for i in over:
            found[i] = Fraction(most_times * sizes[i])
            left -= found[i]
        open_ = [i for i in open_ if found[i] is None]
    return [float(t) for t in found]


def unit(*parts) -> Column:
    """A pseudorandom number in [0, 1) that depends on ``parts`` only."""
    return F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(2 ** 40)) / F.lit(float(2 ** 40))


def unit(*parts: Column) -> Column:
    """A pseudorandom number in [0, 1) that depends on ``parts`` only."""
    return F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(2 ** 40)) / F.lit(float(2 ** 40))


def permutations(blocks: Sequence[int], times: int) -> list[tuple]:
    """For each source and turn (source_no, times, blocks, power, half, add, odd): the constants of a bijection of
    0 .. blocks - 1, drawn anew; see :func:`permuted`. blocks below 2**31."""
    found = []
    for number, count in enumerate(blocks):
        power = 1 << max(0, count.bit_length() - 1)
        for turn in range(times):
            draw = random.Random(f"{SEED} {number} {turn}")
            found.append((number, turn, count, power, 1 << (power.bit_length() // 2 or 1),
                          [draw.randrange(max(1, count)) for _ in range(ROUNDS)],
                          [draw.randrange(2 ** 30) * 2 + 1 for _ in range(ROUNDS)]))
    return found


def permuted(rows: DataFrame, index: str) -> DataFrame:
    """``rows`` with ``index`` moved by its row's bijection.

    Each round turns the numbers by a random step and then mixes those below the largest power of two in blocks, by an
    odd factor and by folding their upper half into the lower; each of these can be undone.
    """
    blocks, power, half = F.col("blocks"), F.col("power"), F.col("half")

    def step(at: Column, constants: Column) -> Column:
        turned = F.pmod(at + constants["add"], blocks)
        mixed = (turned * constants["odd"]).bitwiseAND(power - 1)
        return F.when(turned < power, mixed.bitwiseXOR(F.floor(mixed / half))).otherwise(turned)

    return rows.withColumn(index, F.aggregate(F.arrays_zip("add", "odd"), F.col(index), step))


def stream_offsets(sized: DataFrame, buckets: int) -> DataFrame:
    """``sized`` with offset: words of the same source before the text, in the order of h."""
    bits = max(1, (buckets - 1).bit_length())
    rows = sized.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))
    # As many rows a source as there are buckets.
    starts = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    within = Window.partitionBy("bucket", "source_no").orderBy("h", "id", "size", "text_hash", "row").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = rows.repartition("bucket").withColumn("offset", F.sum("size").over(within) - F.col("size"))
    return (placed.join(starts, ["source_no", "bucket"])
            .withColumn("offset", F.col("offset") + F.col("start")).drop("bucket", "start"))


def draw_slots(spark: SparkSession, blocks: Sequence[int], wanted: Sequence[float], shard_slots: int,
               most_times: int) -> DataFrame:
    """shard, source_no, block, times. ``blocks`` and ``wanted``: by source, its blocks and how many slots it should get."""
    total = sum(wanted)
    shards = max(1, math.ceil(total / shard_slots))
    share = [w / shards for w in wanted]
    whole = [math.floor(s) for s in share]
    parts = [s - w for s, w in zip(share, whole, strict=True)]
    rising, run = [], 0.0
    for part in parts:
        run += part
        rising.append(run / (sum(parts) or 1.0))
    # A shard's slots are the difference of rounded totals, so that all shards together have the total.
    counts = (
        spark.range(shards).withColumnRenamed("id", "shard")
        .withColumn("left", F.round((F.col("shard") + 1) * total / shards).cast("long")
                    - F.round(F.col("shard") * total / shards).cast("long") - sum(whole))
        .withColumn("draws", F.when(F.col("left") > 0, F.sequence(F.lit(1).cast("long"), F.col("left"))).otherwise(F.array()))
        .withColumn("draws", F.transform("draws", lambda d: F.size(F.filter(
            F.array(*map(F.lit, rising[:-1])), lambda r: r <= unit(F.col("shard"), d)))))
        .select("shard", "draws", F.posexplode(F.array(*[F.lit(w).cast("long") for w in whole])).alias("source_no", "whole"))
        .select("shard", "source_no", (F.col("whole") + F.size(F.filter(
            "draws", lambda d: d == F.col("source_no")))).alias("n")))
    sizes = spark.createDataFrame([(i, int(b)) for i, b in enumerate(blocks)], "source_no int, blocks long")
    constants = spark.createDataFrame(
        permutations(blocks, most_times), "source_no int, times int, blocks long, power long, half long, add array<long>, "
                                          "odd array<long>")
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # Slots are made where their shard is, not where their source is; the rows that make them are too few to size by.
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = (
        counts.withColumn("from", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .repartition(dealt, "shard").join(F.broadcast(sizes), "source_no").filter("n > 0 and blocks > 0")
        .withColumn("slot", F.explode(F.expr("sequence(`from`, `from` + n - 1)")))
        .withColumn("times", F.floor(F.col("slot") / F.col("blocks")).cast("int"))
        .filter(F.col("times") < most_times).drop("blocks")
        .join(F.broadcast(constants), ["source_no", "times"])
        .withColumn("block", F.col("slot") - F.col("times") * F.col("blocks")))
    return permuted(numbered, "block").select("shard", "source_no", "block", "times")


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most_times: int = MOST_TIMES,
                block: int = BLOCK, shard_slots: int = SHARD_SLOTS, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", carry: bool = False) -> Mix:
    """The mix of all texts. ``carry`` keeps all columns of ``docs`` in the struct ``rest`` of the places.

    Sources count in the order of their code points, NULL last; weights repeat along that order. There are few sources:
    their sizes come to the driver. NULL and empty texts have size 0 and are never taken. Repeated rows are texts
    of their own. The same rows give the same mix, however they are dealt over files and partitions.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(id_col).alias("h"),
        F.xxhash64(text).alias("text_hash"), *([F.struct(*docs.columns).alias("rest")] if carry else [])))
    totals = sized.groupBy("source").agg(F.sum("size").alias("words")).collect()
    totals = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["words"] for r in totals]
    wanted = targets(sizes, weights, share, most_times)
    sources = spark.createDataFrame(
        [(i, r["source"], r["words"], t) for i, (r, t) in enumerate(zip(totals, wanted, strict=True))],
        "source_no int, source string, source_size long, target double")
    numbered = sized.drop("rest").join(F.broadcast(sources), sized["source"].eqNullSafe(sources["source"])).drop("source")
    buckets = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = stream_offsets(numbered, buckets).drop("h", "text_hash")
    if carry:
        places = places.join(sized.select("row", "rest"), "row")
    places = materialize(places)
    blocks = [-(-s // block) for s in sizes]
    slots = [t * b / s if s else 0.0 for t, b, s in zip(wanted, blocks, sizes, strict=True)]
    drawn = draw_slots(spark, blocks, slots, shard_slots, most_times)
    return Mix(places, drawn, block)


def mixed_texts(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", **options) -> DataFrame:
    """The mix as rows of ``docs``: one for each turn a text is taken, with the words taken then.

    A text taken whole stays as it is; of others the taken words are joined by blanks. ``chars_col``, where there is
    such a column, is the new text's length. Other columns stay.
    """
    mix = mix_sources(docs, text_col=text_col, carry=True, **options)
    rows = mix.places.select("row", "size", "rest").join(mix.ranges(), "row")
    taken = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["length"])
    rows = rows.withColumn("whole", taken == F.col("size")).withColumn("words", F.when(
        ~F.col("whole"), word_array(F.col(f"rest.`{text_col}`"), SPACES)).otherwise(F.array()))
    cut = F.array_join(F.flatten(F.transform("ranges", lambda r: F.slice(
        "words", (r["start"] + 1).cast("int"), r["length"].cast("int")))), " ")
    # Asking for the words' number too keeps Spark from splitting the text anew for every range.
    cut = F.when(F.size("words") > 0, cut).otherwise("")
    rows = rows.withColumn("new text", F.when(F.col("whole"), F.col(f"rest.`{text_col}`")).otherwise(cut))
    new = {text_col: F.col("new text"), chars_col: F.length("new text").cast(dict(docs.dtypes).get(chars_col, "long"))}
    return rows.select(*[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
