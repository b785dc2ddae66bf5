"""Similarity join of texts on the Jaccard similarity of their word shingles, with adaptive multi-match prefixes.

Texts with equal shingle sets are one class. A class orders its shingles by how many classes have them, rarest first. Two
sets as similar as wanted share a shingle within their first ``n - ceil(t n) + 1`` ones, and at least ``k`` within
their first ``n - ceil(t n) + k``. Each class picks the ``k`` for which reading its prefix and verifying what that leaves
costs least by estimate, so common shingles make the prefix longer and the test stricter; a pair is held to the smaller
``k`` of its two classes.

1. Tasks hash the shingles of their texts and send them, packed, to shingle buckets, which find the shingles that
   several texts have. With a shingle goes its text's number in a run of texts, some 9 bytes together however many buckets
   there are; a run's classes go beside them, once, and find the first text of each class and how many were sent of it.
   What several texts have meets the classes by run: shingles that only copies share are dropped there. A class with
   too few others has no partner at all.
2. Prefix shingles of at most ``light`` texts give pairs, counted against ``k``. Commoner ones give no pairs: their
   classes are linked to one of them as candidates. A pair that shares such a one needs no count, any other is counted.
3. Candidates are gathered by connected component, and compared exactly there in blocks of ``block`` classes, each
   pair of blocks being a group of its own. A group yields only the links that join what is still apart, never all
   pairs, and connected components of these links are the result.

Nothing is sampled or capped: prefixes lose no pair, and step 3 compares whole sets. A shingle is a 64-bit hash, a class
a 64-bit hash of its set, and a run of texts a 64-bit hash of its classes, the same if a task reads its rows again in their
order, as tables give them. A shingle's entries meet in one bucket, about 9 bytes for each text that has it; of equal
texts a task sends one. How common a shingle is, is counted by these texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import frees_memory, in_small_batches
from zoneflow.llm.components import connected_components
from zoneflow.llm.word_hash import RADIX, WordHasher, chunks, mixed
from zoneflow.session import materialize

WORDS, PERCENT = 5, 80
LIGHT, BLOCK, BUCKET_SHINGLES, MOST_MATCHES = 64, 512, 1_200_000, 8
#: Factors of a shingle's words, by their place.
PLACES = np.array([pow(0xD1B54A32D192ED03, k + 1, 2 ** 64) for k in range(64)], dtype=np.uint64)


class Shingler(WordHasher):
    """Shingle sets of many texts at once."""

    def __init__(self, words: int = WORDS):
        super().__init__()
        self.words = words

    def sets(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text number, shingle) of each text's distinct shingles, the sets' sizes, and their classes (0 if empty)."""
        own, word, _ = self.word_hashes(texts)
        count, k = np.bincount(own, minlength=len(texts)), self.words
        first = np.flatnonzero(own[:-k + 1] == own[k - 1:]) if len(own) >= k else np.empty(0, np.int64)
        shingle = np.zeros(len(first), dtype=np.uint64)
        for j in range(k):
            shingle += word[first + j] * PLACES[j]
        # Texts of fewer words: all of them are one shingle.
        begin = np.concatenate([[0], np.cumsum(count)])
        short = np.flatnonzero((count > 0) & (count < k))
        whole = np.array([(word[begin[t]:begin[t + 1]] * PLACES[:count[t]]).sum(dtype=np.uint64) + np.uint64(count[t])
                          for t in short], dtype=np.uint64)
        own = np.concatenate([own[first], short])
        shingle = mixed(np.concatenate([shingle, whole]))
        order = np.lexsort((shingle, own))
        own, shingle = own[order], shingle[order]
        if len(own):
            new = np.concatenate([[True], (own[1:] != own[:-1]) | (shingle[1:] != shingle[:-1])])
            own, shingle = own[new], shingle[new]
        sizes = np.bincount(own, minlength=len(texts))
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(shingle ^ np.uint64(RADIX)), dtype=np.uint64)])
        stop = np.cumsum(sizes)
        classes = mixed(total[stop] - total[stop - sizes] + sizes.astype(np.uint64))
        classes[sizes == 0] = 0
        return own, shingle, sizes, classes


def class_rows(words: int):
    """id, n (shingles), cls of every text; NULL for a text without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes, classes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for part in chunks(texts):
                _, _, n, cls = shingler.sets(texts[part])
                sizes.append(n)
                classes.append(cls)
            n = np.concatenate(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(np.concatenate(classes).view(np.int64), mask=n == 0)],
                names=["id", "n", "cls"])
    return run


def bucket_rows(words: int, buckets: int, groups: int):
    """Packed shingles of a run of texts by bucket, and the run's classes and their sizes by group of classes (below 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sent = Shingler(words), set()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in chunks(texts):
                own, shingle, n, cls = shingler.sets(texts[part])
                # A class that this task has sent is not sent again.
                fresh = np.zeros(len(n), dtype=bool)
                for i, c in enumerate(cls.tolist()):
                    if n[i] and c not in sent:
                        sent.add(c)
                        fresh[i] = True
                # A run's name follows from its classes and their order, so a task that runs again gives the same one.
                place = np.arange(len(cls), dtype=np.uint64) * np.uint64(RADIX)
                name = mixed(mixed(cls + place).sum(dtype=np.uint64, keepdims=True))
                keep = fresh[own]
                own, shingle = own[keep], shingle[keep]
                rows = {name: [] for name in PACKED.names}
                bucket = ((shingle >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
                pack(rows, bucket, np.repeat(name, len(own)), own, shingle)
                text = np.flatnonzero(fresh)
                pack(rows, -1 - dealt(cls[text], groups), np.repeat(name, len(text)), text, cls[text], n[text])
                yield pa.RecordBatch.from_pydict(rows, schema=PACKED)
    return run


#: Entries by run of texts: of each run its name and how many entries follow, of an entry the text's number in its run, by
#: steps, and a shingle and how many texts have it, or a class, its size and how many texts were sent of it.
PACKED = pa.schema([("deal", pa.int32()), ("names", pa.binary()), ("counts", pa.binary()), ("steps", pa.binary()),
                    ("shingles", pa.binary()), ("sizes", pa.binary()), ("copies", pa.binary())])
PACKED_SQL = "deal int, names binary, counts binary, steps binary, shingles binary, sizes binary, copies binary"
#: Classes of which a task looks up the copies, and classes that a task orders the shingles of.
GROUP_CLASSES, DEALT_CLASSES = 200_000, 65_536


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    return at, np.diff(np.concatenate([at, [len(values)]]))


def narrow(values: np.ndarray) -> bytes:
    """Numbers from 0 in as many bytes as the largest needs, all lowest bytes first."""
    width = max(1, -(-int(values.max()).bit_length() // 8))
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def widened(raw: bytes, count: int) -> np.ndarray:
    found = np.zeros((count, 8), dtype=np.uint8)
    found[:, :len(raw) // count] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, count).T
    return found.view("<i8").ravel()


def pack(rows: dict, deal: np.ndarray, name: np.ndarray, own: np.ndarray, shingle: np.ndarray, size: np.ndarray | None = None,
         copies: np.ndarray | None = None):
    """Adds a row for every number in ``deal``."""
    order = np.lexsort((own, name, deal))
    deal, name, own, shingle = deal[order], name[order], own[order], shingle[order]
    size, copies = (None if x is None else x[order] for x in (size, copies))
    new = np.concatenate([[True], (name[1:] != name[:-1]) | (deal[1:] != deal[:-1])])[:len(name)]
    steps = np.where(new, own, own - np.concatenate([[0], own[:-1]])[:len(own)])
    for i, length in zip(*runs(deal), strict=True):
        part = slice(i, i + length)
        at, lengths = runs(name[part])
        rows["deal"].append(int(deal[i]))
        rows["names"].append(name[part][at].tobytes())
        rows["counts"].append(lengths.astype(np.int32).tobytes())
        rows["steps"].append(narrow(steps[part]))
        rows["shingles"].append(shingle[part].tobytes())
        rows["sizes"].append(None if size is None else narrow(size[part]))
        rows["copies"].append(None if copies is None else narrow(copies[part]))


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """name, own, shingle, size and copies of all entries; the last two are empty where rows have none."""
    found = ([], [], [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)])
    lengths = [np.empty(0, np.int32)]
    for names, counts, steps, shingles, sizes, copies in zip(*(table[c].to_pylist() for c in PACKED.names[1:]), strict=True):
        count = len(shingles) // 8
        found[0].append(np.frombuffer(names, dtype=np.uint64))
        lengths.append(np.frombuffer(counts, dtype=np.int32))
        found[1].append(widened(steps, count))
        found[2].append(np.frombuffer(shingles, dtype=np.uint64))
        for to, raw in ((found[3], sizes), (found[4], copies)):
            if raw is not None:
                to.append(widened(raw, count))
    counts = np.concatenate(lengths)
    name = np.repeat(np.concatenate([np.empty(0, np.uint64), *found[0]]), counts)
    total = np.cumsum(np.concatenate([np.empty(0, np.int64), *found[1]]))
    # A run's steps begin at 0.
    before = np.concatenate([[0], total])[np.cumsum(counts) - counts]
    return name, total - np.repeat(before, counts), *(np.concatenate(x) for x in found[2:])


def shared_shingles(deals: int):
    """Of one bucket the shingles that several texts have, and how many have them; of one group of classes their first texts,
    and how many were sent. Both go to the group of the texts' run."""
    def run(table: pa.Table) -> pa.Table:
        rows = {name: [] for name in PACKED.names}
        name, own, value, size, _ = unpack(table)
        if len(size):
            order = np.lexsort((own, name, value))
            at, copies = runs(value[order])
            first = order[at]
            name = name[first]
            pack(rows, dealt(name, deals), name, own[first], value[first], size[first], copies)
        else:
            order = np.argsort(value, kind="stable")
            df = np.repeat(lengths := runs(value[order])[1], lengths)
            order, df = order[df > 1], df[df > 1]
            name = name[order]
            pack(rows, dealt(name, deals), name, own[order], value[order], df)
        return pa.Table.from_pydict(rows, schema=PACKED)
    return run


def dealt(hashes: np.ndarray, deals: int) -> np.ndarray:
    return (mixed(hashes) % np.uint64(deals)).astype(np.int64)


def with_classes(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """cls, n, shingle and df of a group's shingles that another class has too; only a class's first text has any.

    A shingle that no other class has is in as many texts as were sent of the class."""
    first = pc.is_valid(table["copies"])
    name, own, cls, n, copies = unpack(table.filter(first))
    known, at = np.unique(name, return_inverse=True)
    order = np.argsort(keys := at.astype(np.int64) << 32 | own)
    keys, cls, n, copies = keys[order], cls[order], n[order], copies[order]
    name, own, shingle, df, _ = unpack(table.filter(pc.invert(first)))
    if not len(keys):
        return cls, n, shingle[:0], df[:0]
    at = np.minimum(np.searchsorted(known, name), len(known) - 1)
    key = at.astype(np.int64) << 32 | own
    text = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    keep = (known[at] == name) & (keys[text] == key) & (df > copies[text])
    return cls[text[keep]], n[text[keep]], shingle[keep], df[keep]


def least_overlap(n: int, percent: int) -> int:
    """How many shingles a set of ``n`` shares at least with any set that is similar enough."""
    return -(-percent * n // 100)


def matches_needed(df: np.ndarray, unique: int, free: int) -> int:
    """The ``k`` whose prefix costs least: entries to read, and pairs left to verify, each as dear as ``n / 64`` entries.

    ``df``: of the shared shingles, rarest first, how many texts sent have them. ``free``: n less the least overlap.
    """
    most = min(MOST_MATCHES, unique + len(df) - free)
    read = np.concatenate([[0], np.cumsum(df - 1, dtype=np.float64)])
    costs = []
    for k in range(1, most + 1):
        reach = read[min(max(free + k - unique, 0), len(df))]
        costs.append(reach + reach / k * (unique + len(df)) / 64)
    return 1 + int(np.argmin(costs))


def ordered_sets(percent: int):
    """Of a group's classes that may have a partner: shared shingles, rarest first, ``k``, how far the first of them lies
    beyond the free part of the shortest prefix, and how many texts have those in the prefix."""
    def run(table: pa.Table) -> pa.Table:
        cls, n, shingle, df = with_classes(table)
        cls, shingle = cls.view(np.int64), shingle.view(np.int64)
        order = np.lexsort((shingle, df, cls))
        cls, n, shingle, df = cls[order], n[order], shingle[order], df[order]
        if len(cls):
            # Tasks may have sent the same run of texts.
            new = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (cls[1:] != cls[:-1])])
            cls, n, shingle, df = cls[new], n[new], shingle[new], df[new]
        rows = {name: [] for name in SET_SCHEMA.names}
        for i, length in zip(*runs(cls), strict=True):
            size = int(n[i])
            unique, free = size - length, size - least_overlap(size, percent)
            if unique > free:
                continue  # the shortest prefix has no shared shingle: no partner
            k = matches_needed(df[i:i + length], unique, free)
            rows["cls"].append(int(cls[i]))
            rows["n"].append(size)
            rows["k"].append(k)
            rows["beyond"].append(unique - free)
            rows["shingles"].append(shingle[i:i + length])
            rows["dfs"].append(df[i:i + min(length, free + k - unique)])
        return pa.Table.from_pydict(rows, schema=SET_SCHEMA)
    return run


SET_SCHEMA = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("k", pa.int32()), ("beyond", pa.int64()),
                        ("shingles", pa.list_(pa.int64())), ("dfs", pa.list_(pa.int32()))])
SET_SQL = "cls long, n long, k int, beyond long, shingles array<long>, dfs array<int>"


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many shingles each of ``left`` shares with each of ``right``, by products over runs of ``width`` shingles."""
    values, inverse = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    sizes = np.array([len(s) for s in [*left, *right]])
    rows = np.repeat(np.arange(len(sizes)), sizes)
    found = np.zeros((len(left), len(right)), dtype=np.float32)
    order = np.argsort(inverse, kind="stable")
    rows, inverse = rows[order], inverse[order]
    for begin in range(0, len(values), width):
        i, j = np.searchsorted(inverse, [begin, begin + width])
        has = np.zeros((len(sizes), min(width, len(values) - begin)), dtype=np.float32)
        has[rows[i:j], inverse[i:j] - begin] = 1
        found += has[:len(left)] @ has[len(left):].T
    return found


def linker(percent: int):
    """Links between the classes of one group that join what is still apart there."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        edges: list[tuple[int, int]] = []
        for _, part in rows.groupby("cluster", sort=False):
            own = part["own"].to_numpy()
            low, high = int(key[1]), int(key[2])
            left, right = part[own == low], part[own == high]
            if not len(left) or not len(right) or (low == high and len(left) == 1):
                continue
            shared = overlaps(left["shingles"].tolist(), right["shingles"].tolist())
            both = left["n"].to_numpy()[:, None] + right["n"].to_numpy()[None, :] - shared
            near = 100 * shared.astype(np.int64) >= percent * both.astype(np.int64)
            names = np.concatenate([left["cls"].to_numpy(), right["cls"].to_numpy()])
            root: dict[int, int] = {}

            def find(x: int, root: dict[int, int] = root) -> int:
                while root.setdefault(x, x) != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i, j in np.argwhere(near).tolist():
                a, b = int(names[i]), int(names[len(left) + j])
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    edges.append((a, b))
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")
    return run


def candidates(sets: DataFrame, percent: int, light: int) -> DataFrame:
    """(a, b): edges that connect, directly or over others, all classes that may be similar."""
    places = sets.select("cls", "n", "k", "beyond", F.posexplode(F.arrays_zip(
        F.slice("shingles", 1, F.size("dfs")).alias("shingle"), F.col("dfs").alias("df"))).alias("at", "entry"))
    places = places.select("cls", "n", "k", (F.col("beyond") + F.col("at")).alias("e"), "entry.shingle", "entry.df")
    rare = places.filter(F.col("df") <= light).drop("df")
    a, b = rare.alias("a"), rare.alias("b")
    k = F.least("a.k", "b.k")
    pairs = (
        a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.cls") < F.col("b.cls"))
               & (F.col("a.e") < k) & (F.col("b.e") < k)
               & (100 * F.col("a.n") >= percent * F.col("b.n")) & (100 * F.col("b.n") >= percent * F.col("a.n")))
        .groupBy(F.col("a.cls").alias("a"), F.col("b.cls").alias("b"), k.alias("k")).agg(F.count("*").alias("matches"))
        .filter("matches >= k").select("a", "b"))
    common = places.filter(F.col("df") > light).select("shingle", "cls")
    hubs = common.groupBy("shingle").agg(F.min("cls").alias("b"))
    return pairs.unionAll(common.join(hubs, "shingle").select(F.col("cls").alias("a"), "b"))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                       percent: int = PERCENT, light: int = LIGHT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: id_col, n_shingles, component_id.

    Texts link when ``100 * shared >= percent * all`` of their distinct ``words``-word shingles; the component is the
    smallest id reachable. A text of fewer words is one shingle; NULL texts and texts without words link with nothing.
    Repeated rows are texts of their own. Empty tables give no rows; columns other than id and text are ignored.
    """
    texts = in_small_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body")))
    members = materialize(texts.mapInArrow(frees_memory(class_rows(words)), "id long, n long, cls long"))
    total = members.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_SHINGLES))
    count = members.count()
    deals = max(1, math.ceil(total / (2 * BUCKET_SHINGLES)), math.ceil(count / DEALT_CLASSES))
    groups = max(1, math.ceil(count / GROUP_CLASSES))
    packed = texts.select("body").mapInArrow(frees_memory(bucket_rows(words, buckets, groups)), PACKED_SQL)
    shared = packed.groupBy("deal").applyInArrow(shared_shingles(deals), PACKED_SQL)
    sets = materialize(shared.groupBy("deal").applyInArrow(ordered_sets(percent), SET_SQL))

    clusters = materialize(connected_components(candidates(sets, percent, light)))
    sizes = clusters.groupBy("component").agg(F.count("*").alias("size"))
    groups = max(1, math.ceil(clusters.count() / block))
    blocks = F.ceil(F.col("size") / block).cast("int")
    seated = (
        sets.select("cls", "n", "shingles").join(clusters.withColumnRenamed("node", "cls"), "cls").join(sizes, "component")
        .withColumn("own", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        # Small clusters share a group, large ones have a group for each pair of blocks.
        .select("cls", "n", "shingles", "own", F.col("component").alias("cluster"),
                F.when(blocks > 1, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(groups))).alias("deal"),
                F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")))
    links = materialize(seated.groupBy("deal", "low", "high").applyInPandas(linker(percent), "a long, b long"))

    joined = connected_components(links).withColumnsRenamed({"node": "cls", "component": "part"})
    least = members.filter("cls is not null").groupBy("cls").agg(F.min("id").alias("least")).join(joined, "cls", "left")
    least = materialize(least)
    parts = least.filter("part is not null").groupBy("part").agg(F.min("least").alias("part_least"))
    named = least.join(parts, "part", "left").select("cls", F.coalesce("part_least", "least").alias("component"))
    return members.join(named, "cls", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near copies: of texts linked by similarity the row with the smallest id stays, the first of several; NULL
    is the largest id. Rows are numbered, as an id may be NULL or stand on several texts; ``docs`` has to be a written table,
    which gives the same numbers each time it is read. Columns may have any names."""
    numbered = docs.select(F.monotonically_increasing_id().alias("near"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    found = similar_components(numbered.select("near", "text"), id_col="near", text_col="text")
    linked = materialize(found.filter("component_id <> near").select("near", "component_id"))
    members = linked.unionAll(linked.select(F.col("component_id").alias("near"), "component_id").distinct())
    rank = F.struct(F.col("id").isNull(), "id", "near")
    kept = members.join(numbered.select("near", "id"), "near").groupBy("component_id").agg(F.min(rank).alias("kept")).select(
        F.col("kept.near").alias("near"))
    going = members.select("near").join(kept, "near", "left_anti")
    return numbered.join(going, "near", "left_anti").select("doc.*")
