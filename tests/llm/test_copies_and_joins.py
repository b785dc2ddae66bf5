import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from zoneflow.llm import ngram_join as nj
from zoneflow.llm.components import connected_components
from zoneflow.llm.embedding_dedup import near_copies
from zoneflow.llm.exact_dedup import drop_copies, mark_copies

SPACED = re.compile("[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


class Union(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, kept string")


@pytest.mark.parametrize("keep", ["min", "max"])
def test_copies_of_equal_texts(spark, keep):
    texts = ["a", "a ", None, "", "a", "b" * 100_000, "b" * 100_000 + "c", "é"] + ["hot"] * 300 + ["a"]
    found = {r.doc_id: r for r in mark_copies(frame(spark, texts), keep=keep).collect()}
    groups = collections.defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    for ids in groups.values():
        best = min(ids) if keep == "min" else max(ids)
        for i in ids:
            assert (found[i].keep_id, found[i].group_size, found[i].kept) == (best, len(ids), i == best)


def test_copies_with_repeated_rows_and_carried_columns(spark):
    docs = frame(spark, ["x", "x", None, "y"])
    twice = docs.unionAll(docs)
    kept = drop_copies(twice)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(0, "x", "k"), (2, None, "k"), (3, "y", "k")], key=repr)
    assert mark_copies(docs.limit(0)).count() == drop_copies(docs.limit(0)).count() == 0
    hot = spark.createDataFrame([(7, "same")] * 200, "doc_id long, text string")
    assert mark_copies(hot).filter("kept").count() == 1


def test_normalised_copies(spark):
    from pyspark.sql import functions as F

    docs = frame(spark, ["A  b", "a b", "c"])
    assert sorted(r.doc_id for r in drop_copies(docs, normalise=lambda c: F.lower(F.regexp_replace(c, r"\s+", " "))).collect()) == [0, 2]
    assert [r.text for r in drop_copies(docs, normalise=F.lower).filter("doc_id = 0").collect()] == ["A  b"]


def test_components_of_random_graphs_chains_and_stars(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(draw.randint(100, 160), draw.randint(100, 160)) for _ in range(40)]
    edges += [(300, i) for i in range(301, 360)] + [(400, 400)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: union.find(n) for a, b in edges if a != b for n in (a, b)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    words = SPACED.findall((text or "").translate(FOLD))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar(sets):
    union = Union()
    for i, s in sets.items():
        union.find(i)
        for j, t in sets.items():
            if i < j and s and 100 * len(s & t) >= 80 * len(s | t):
                union.join(i, j)
    return {i: union.find(i) for i in sets}


def varied(draw, base, changes):
    words = base.split()
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"z{draw.randrange(10 ** 6)}"
    return " ".join(words)


@pytest.mark.parametrize("light, block", [(64, 512), (3, 4)])
def test_shingle_join_equals_brute_force(spark, light, block):
    """Also with few classes a block and few rare shingles, so that common ones and pairs of blocks are met."""
    draw = random.Random(light)
    common = " ".join(f"c{i}" for i in range(60))
    texts = [None, "", " \t", "one", "ONE", "a b c d", "a b c d", "A b c d e", "a b c d e", "kelvin \u212a x y z", "x" * 50_000]
    for g in range(12):
        base = " ".join(f"w{g}x{i}" for i in range(draw.randrange(5, 120)))
        texts += [varied(draw, base, k) for k in (0, 0, 1, 1, 2, 3)]
        texts.append(base + " " + common)
    big = " ".join(f"b{i}" for i in range(150))
    texts += [varied(draw, big, draw.randrange(0, 5)) for _ in range(60)]
    found = nj.similar_components(frame(spark, texts), light=light, block=block).collect()
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(s) for i, s in sets.items()}
    assert {r.doc_id: r.component_id for r in found} == similar(sets)


def test_shingle_join_of_repeated_rows_and_of_no_rows(spark):
    docs = frame(spark, ["a b c d e f", "a b c d e f"])
    assert [r.component_id for r in nj.similar_components(docs.unionAll(docs)).collect()] == [0] * 4
    assert nj.similar_components(docs.limit(0)).count() == 0


def test_packed_shingles_stay_small_however_many_buckets():
    """A bucket with one shingle of a text gets 8 bytes for it and about one for the text, not the text's class and size."""
    texts = [" ".join(f"w{t}x{i}" for i in range(404)) for t in range(200)]
    batch = pa.RecordBatch.from_pydict({"body": texts})
    [packed] = nj.bucket_rows(5, 100, 1)(iter([batch]))
    table = pa.Table.from_batches([packed])
    sent = sum(len(raw) for c in nj.PACKED.names[1:] for raw in table[c].to_pylist() if raw)
    assert 8 * 80_000 < sent < 10 * 80_000
    name, own, shingle, *_ = nj.unpack(table.filter(pc.greater_equal(table["deal"], 0)))
    assert len(set(name)) == 1 and len(set(shingle)) == 80_000
    assert np.bincount(own).tolist() == [400] * 200


def test_copies_sent_by_many_tasks_share_no_shingle(spark):
    """Entries are counted by texts; a class is known to have a shingle alone by the copies that were sent of it."""
    alone = " ".join(f"a{i}" for i in range(50))
    pair = " ".join(f"p{i}" for i in range(50))
    texts = [alone, pair, f"{pair} end", "b c d e f"]
    docs = frame(spark, texts).unionAll(frame(spark, texts)).unionAll(frame(spark, texts)).repartition(12)
    found = {(r.doc_id, r.component_id) for r in nj.similar_components(docs).collect()}
    assert found == {(0, 0), (1, 1), (2, 1), (3, 3)}
    rows = {name: [] for name in nj.PACKED.names}
    name, own = np.array([7, 7, 9], dtype=np.uint64), np.array([0, 1, 4])
    nj.pack(rows, np.zeros(3, np.int64), name, own, np.array([11, 12, 13], dtype=np.uint64), np.array([2, 2, 2]), np.array([3, 1, 1]))
    # Shingle 5 is in three copies of class 11 alone, 6 in those and in class 12, 8 in a text that stands for no class.
    nj.pack(rows, np.zeros(4, np.int64), name[[0, 0, 1, 2]], np.array([0, 0, 1, 5]), np.array([5, 6, 6, 8], dtype=np.uint64), np.array([3, 4, 4, 2]))
    cls, n, shingle, df = nj.with_classes(pa.Table.from_pydict(rows, schema=nj.PACKED))
    assert sorted(zip(cls.tolist(), n.tolist(), shingle.tolist(), df.tolist())) == [(11, 2, 6, 4), (12, 2, 6, 4)]


def test_longer_prefixes_are_chosen_where_they_cost_less():
    rare, common = np.full(40, 2), np.full(40, 60)
    assert nj.matches_needed(rare, unique=0, free=20) > 1
    assert nj.matches_needed(np.concatenate([rare[:1], common]), unique=20, free=20) == 1


@pytest.mark.parametrize("block", [512, 16])
def test_embedding_links_equal_brute_force(spark, block):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(12, 16))
    rows = []
    for i in range(150):
        vector = base[i % 12] + draw.normal(size=16) * (0.02, 0.1, 0.2)[i % 3]
        rows.append((i, [float(np.float32(x)) for x in vector], i % 2 if i % 25 else None, "x"))
    rows += [(200 + i, rows[1][1], 1, "x") for i in range(40)]
    rows += [(300, None, 1, "x"), (301, [0.0] * 16, 1, "x"), (302, [math.nan] * 16, 1, "x"), (303, [None] * 16, 1, "x"), (304, [], 1, "x"),
             (305, [1.0, 2.0], 1, "x"), (306, [2.0, 4.0], 1, "x"), (307, [math.inf] * 16, 1, "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept string")
    found = {r.vec_id: r for r in near_copies(vectors, bucket_rows=8, block=block).collect()}
    links, union = collections.Counter(), Union()

    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    for i, (a, x, k, _) in enumerate(rows):
        union.find(a)
        for b, y, l, _ in rows[:i]:
            if k is not None and k == l and good(x) and good(y) and len(x) == len(y):
                p, q = np.array(x, np.float64), np.array(y, np.float64)
                if p @ q / math.sqrt(p @ p) / math.sqrt(q @ q) >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    union.join(a, b)
    for a, *_ in rows:
        assert (found[a].n_links, found[a].component_id, found[a].kept) == (links[a], union.find(a), union.find(a) == a), a
    assert near_copies(vectors.limit(0)).count() == 0
