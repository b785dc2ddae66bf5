import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.llm import common, queries, toxicity, vector_codes
from zoneflow.llm.hard_negatives import Mining, SliceIndex, best_of, mine
from zoneflow.llm.toxicity import Network, Sizes, Vocabulary, encoded, tokenize
from zoneflow.llm.vector_codes import MaskedEntries, compress

VECTORS = "vec_id long, embedding array<float>, label int"


# --- vector codes

@pytest.mark.parametrize("radius", [None, 0, 1, 10 ** 6])
@pytest.mark.parametrize("count", [1, 16, 64, 130])
def test_masks_find_the_nearest_entry_and_ties_go_to_the_lower(radius, count):
    draw = np.random.default_rng(count)
    entries = draw.integers(-6, 6, (count, 3))
    points = draw.integers(-9, 9, (300, 3))
    index, best = MaskedEntries(entries, radius).nearest(points)
    apart = ((points[:, None] - entries) ** 2).sum(axis=2)
    assert (index == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()


def test_masks_hold_exactly_what_lies_within_the_radius():
    draw = np.random.default_rng(5)
    entries, points = draw.integers(0, 20, (70, 2)), draw.integers(0, 20, (50, 2))
    masks = MaskedEntries(entries).within(points, np.full(50, 4))
    for i, p in enumerate(points):
        near = {e for e in range(70) if np.abs(entries[e] - p).max() <= 4}
        assert {e for e in range(70) if int(masks[i, e // 64]) >> (e % 64) & 1} == near


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, l, [math.floor(min(max(x * scale, -2.0 ** 27), 2.0 ** 27)) for x in v]) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(q) for *_, q in kept), default=0) // parts)
    kept = [(i, l, q + [0] * (width * parts - len(q))) for i, l, q in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[q[p * width:(p + 1) * width] for *_, q in first] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        members = [[[] for _ in first] for _ in range(parts)]
        for *_, q in kept:
            for p in range(parts):
                part = q[p * width:(p + 1) * width]
                members[p][nearest(p, part)[1]].append(part)
        for p in range(parts):
            for k, own in enumerate(members[p]):
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    found = []
    for i, l, q in kept:
        near = [nearest(p, q[p * width:(p + 1) * width]) for p in range(parts)]
        found.append((i, "".join(f"{k:02x}" for _, k in near), sum(d for d, _ in near), l))
    totals = {}
    for _, _, error, l in found:
        totals[l] = totals.get(l, 0) + error
    return sorted([(i, c, e, totals[l], digest) for i, c, e, l in found], key=repr)


def test_codes_of_odd_vectors_equal_brute_force(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(0, 1, 16)], int(draw.integers(3)) if i % 5 else None) for i in range(60)]
    rows += rows[:4] + [(None, rows[7][1], 1), (61, None, 1), (62, [1.0, None] * 8, 1), (63, [float("nan")] * 16, 1), (64, [float("inf")] * 16, 2),
                        (65, [0.5, -0.5], 2), (66, [], None), (67, [float(np.float32(1e30))] * 16, 9)]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({"parts": F.lit("x"), "code": F.lit(1), "h": F.lit(2)}).repartition(5)
    found = compress(frame)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_codes(rows)


def test_codes_of_few_and_of_no_vectors(spark):
    few = [(3, [0.25, -0.75], 1), (1, [0.5, 0.5], None)]
    found = compress(spark.createDataFrame(few, VECTORS), parts=2)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_codes(few, parts=2)
    assert compress(spark.createDataFrame([], VECTORS)).count() == 0
    assert compress(spark.createDataFrame([(1, None, 1)], VECTORS)).count() == 0
    with pytest.raises(ValueError):
        vector_codes.train(vector_codes.scaled(spark.createDataFrame(few, VECTORS), 16, "vec_id", "embedding", "label"), entries=257)


def test_decoding_gives_the_entries(spark):
    rows = vector_codes.scaled(spark.createDataFrame([(i, [i / 4, -i / 4], 1) for i in range(9)], VECTORS), 16, "vec_id", "embedding", "label")
    books = vector_codes.train(rows, parts=2, entries=16, scale=16)
    decoded = vector_codes.decode(vector_codes.encode(rows, books), books).collect()
    assert {r.id: r.decoded for r in decoded} == {i: [i / 4, -i / 4] for i in range(9)}


def test_totals_of_many_groups_are_joined_with_salt(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "a" if i % 3 else None, i) for i in range(100)], "id int, label string, error long")
    want = sorted((tuple(r) for r in common.with_group_total(rows, "label", "error", "total").collect()), key=repr)
    monkeypatch.setattr(common, "BROADCAST_GROUPS", 0)
    found = common.with_group_total(rows, "label", "error", "total")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    assert {r.total for r in found.filter("label is null").collect()} == {sum(range(0, 100, 3))}


# --- hard negatives

def brute_negatives(rows, is_anchor, mining=Mining(), scale=256):
    kept = [(i, l, [math.floor(min(max(scale * x, -2.0 ** 20), 2.0 ** 20)) for x in v]) for i, v, l in rows
            if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def score(a, b):
        return sum(x * y for x, y in zip(kept[a][2], kept[b][2]))

    def best(anchor, others, n):
        return sorted(others, key=lambda b: (-score(anchor, b), kept[b][0] is None, kept[b][0] or 0, b))[:n]

    found = []
    for a, (i, l, _) in enumerate(kept):
        if i is None or not is_anchor(i):
            continue
        for p in best(a, [b for b in range(len(kept)) if b != a and kept[b][1] == l], mining.positives):
            ps = score(a, p)
            fits = [b for b in range(len(kept)) if kept[b][1] != l and mining.low * ps <= 100 * score(a, b) <= mining.high * ps]
            for rank, b in enumerate(best(a, fits, mining.negatives), 1):
                found.append((i, kept[p][0], rank, kept[b][0], ps, score(a, b)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("mining", [Mining(), Mining(block_rows=7, block_anchors=3, slice_dims=3), Mining(positive_steps=(0.99, -1.0), negative_steps=(94, 50), slice_dims=1)])
def test_negatives_equal_brute_force(spark, mining):
    draw = np.random.default_rng(11)
    middles = draw.normal(0, 1, (4, 10))
    rows = []
    for i in range(120):
        v = middles[i % 4] + draw.normal(0, 0.4, 10)
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int((i % 4 + (i % 3 == 0)) % 4)))
    rows += [rows[0], rows[20], rows[20], (None, rows[5][1], 1), (200, None, 1), (210, [1.0, None], 1), (220, [float("nan")] * 10, 2),
             (230, rows[3][1], None), (240, [0.0] * 10, 1), (250, [0.5, 0.5], 2), (260, [], 2)]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({"row": F.lit(1), "low": F.lit("x"), "window": F.lit(2)}).repartition(3)
    found = mine(frame, F.col("vec_id") % 10 == 0, mining=mining)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_negatives(rows, lambda i: i % 10 == 0, mining)


def test_negatives_of_no_rows_and_of_one_label(spark):
    assert mine(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(i, [1.0, float(i)], 1) for i in range(100)], VECTORS)
    assert mine(one, F.col("vec_id") % 50 == 0).count() == 0
    assert mine(one, F.lit(False)).count() == 0


def test_index_omits_covered_dimensions_and_loses_no_row():
    draw = np.random.default_rng(2)
    rows = np.floor(draw.normal(0, 1, (400, 24)) * np.geomspace(100, 1, 24))
    anchors = rows[:20]
    exact = anchors @ rows.T
    thresholds = np.quantile(exact, 0.99, axis=1)
    index = SliceIndex(rows, np.arange(24)[::-1], 4, np.linalg.norm(anchors, axis=1).max(), thresholds.min())
    assert (index.first > 0).any()
    live, scores = index.scores(anchors, thresholds)
    assert len(live) < len(rows) and (scores == exact[:, live]).all()
    assert set(np.flatnonzero((exact >= thresholds[:, None]).any(axis=0))) <= set(live)


def test_best_rows_keep_ties_at_the_border():
    ids = np.array([5.0, 1.0, np.nan, 3.0])
    assert best_of(ids, np.arange(4), np.array([7, 7, 7, 7]), 2).tolist() == [1, 3]
    assert best_of(ids, np.arange(4), np.array([7, 7, 7, 7]), 9).tolist() == [1, 3, 0, 2]


# --- toxicity

def test_words_and_grams():
    found = tokenize([encoded("The CAT, the cat!"), encoded(None), encoded("é-x")])
    assert found.own.tolist() == [0, 0, 0, 0, 2, 2]
    assert found.words[0] == found.words[2] and found.words[1] == found.words[3] and len(set(found.words.tolist())) == 4
    per = np.bincount(found.gram_word, minlength=6)  # " the": 2 of three bytes, 1 of four
    assert per.tolist() == [3, 3, 3, 3, 1, 0]
    assert len(tokenize([b"a" * 1000]).words) == 4


def small_network():
    draw = np.random.default_rng(1)
    texts = [" ".join(f"w{draw.integers(300)}" for _ in range(80)) for _ in range(120)]
    labels = np.arange(120) % 2
    texts = [f"{t[:100]} grob{'' if i % 3 else draw.integers(9)} {t[100:]}" if labels[i] else t for i, t in enumerate(texts)]
    return toxicity.fit(texts, labels, Sizes(words=400, grams=400)), texts, labels


@pytest.fixture(scope="module")
def network():
    return small_network()


def test_a_single_word_is_learnt_wherever_it_stands(network):
    net, texts, labels = network
    assert ((net.probabilities(texts) >= 0.5) == labels).mean() >= 0.97
    clean = " ".join(f"w{i % 300}" for i in range(5000))
    for at in (0, 12_001, len(clean)):
        at = clean.find(" ", at) if at < len(clean) else at
        assert net.probabilities([clean[:at] + " grob " + clean[at:]])[0] >= 0.5
    again, *_ = small_network()
    assert (again.probabilities(texts) == net.probabilities(texts)).all()


def test_long_texts_in_pieces_equal_whole_ones(network, monkeypatch):
    net, *_ = network
    draw = np.random.default_rng(4)
    text = " ".join("x" * int(draw.integers(1, 9)) + f"w{draw.integers(300)}" for _ in range(4000)) + " grob" + "y" * 3000 + " ,.- " * 500 + "end"
    whole = net.highest([text, text + " w1", text[:7000]])
    monkeypatch.setattr(toxicity, "CHUNK", 9_000)
    assert net.highest([text, text + " w1", text[:7000]]) == pytest.approx(whole, abs=1e-4)


def test_gradients_equal_differences():
    sizes = Sizes(words=20, grams=20, word_dim=3, gram_dim=2, hidden=3, window=6)
    tokens = tokenize([b"abc abd xyz abc", b"q abd abd zzz abc abc abd xyz"])
    net = Network(sizes, Vocabulary(np.unique(tokens.words)), Vocabulary(np.unique(tokens.grams)))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = net.inputs(tokens)
    text, places = net.windows(x.own, 2)
    labels, weights = np.arange(len(text)) % 2, np.linspace(1, 2, len(text))

    def loss():
        z = net.forward(net.embedded(x).astype(np.float64), places)
        return (weights * (np.log1p(np.exp(z)) - labels * z)).sum() / weights.sum()

    gradients = net.gradients(x, net.embedded(x), places, labels, weights)
    for name, value in net.p.items():
        for at in list(np.ndindex(value.shape))[:: max(1, value.size // 7)]:
            if name in ("word", "gram") and at[0] == 0:
                continue
            before = value[at]
            value[at] = before + 1e-3
            up = loss()
            value[at] = before - 1e-3
            down = loss()
            value[at] = before
            assert gradients[name][at] == pytest.approx((up - down) / 2e-3, abs=2e-3), name


def test_windows_cover_every_word_and_overlap():
    net = Network(Sizes(window=4), Vocabulary(np.empty(0, np.uint64)), Vocabulary(np.empty(0, np.uint64)))
    text, places = net.windows(np.array([0, 0, 0, 2, 2, 2, 2, 2, 2, 2]), 3)
    assert text.tolist() == [0, 1, 2, 2, 2]
    assert places.tolist() == [[0, 1, 2, 10], [10] * 4, [3, 4, 5, 6], [5, 6, 7, 8], [7, 8, 9, 10]]


def test_query_scores_every_document_and_tells_held_out_ones_apart(spark, sf_dir):
    wide = sf_dir.replace("sf0.001", "sf0.01")
    rows = {r.doc_id: r for r in queries.op13_toxicity(spark, wide).collect()}
    assert set(rows) == {r.doc_id for r in spark.read.parquet(f"{wide}/documents.parquet").collect()}
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{wide}/labels.parquet").collect()}
    held = [(rows[i].score, y) for i, y in truth.items() if rows[i].held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, y in held if y for b, z in held if not z]
    assert sum(pairs) / len(pairs) >= 0.8


def test_toxicity_of_odd_tables(spark):
    docs = spark.createDataFrame([(i, ["fein " * 9, "grob wort"][i % 2]) for i in range(40)] + [(90, None), (91, ""), (None, "grob"), (1, "grob wort"), (1, "fein")],
                                 "doc_id long, text string").withColumns({"label": F.lit(7), "h": F.lit(1), "score": F.lit("x")})
    marks = [(i, i % 2) for i in range(40)] + [(90, 1), (91, 0), (None, 1), (5, 1), (6, None), (7, 9)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    net = toxicity.learn(docs, labels)
    found = toxicity.score(docs, net)
    assert found.columns == ["doc_id", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == 45 and all(0 <= r.score <= 1 for r in rows)
    assert {r.predicted for r in rows if r.doc_id is not None and r.doc_id < 40 and r.doc_id % 2 == 0} == {0}
    for some in (labels.limit(0), labels.filter("toxic = 1")):
        one = toxicity.score(docs, toxicity.learn(docs, some)).collect()
        assert len({r.score for r in one}) == 1
    assert toxicity.score(docs.limit(0), net).count() == 0
    assert toxicity.learn(docs.limit(0), labels).probabilities(["x"])[0] == pytest.approx(0, abs=1e-2)


def test_sample_is_bounded_by_texts_and_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "trainer", lambda sizes: counting)
    docs = spark.createDataFrame([(i % 50, f"text {i} " * 10) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")

    def counting(batches):
        import pickle

        import pyarrow as pa
        rows = [r for b in batches for r in b.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(rows)], pa.binary())], names=["state"])

    monkeypatch.setattr(Network, "of_state", classmethod(lambda cls, sizes, state: seen.append(__import__("pickle").loads(state))))
    toxicity.learn(docs, labels, Sizes(sample_docs=5))
    toxicity.learn(docs, labels, Sizes(sample_bytes=200))
    toxicity.learn(docs, labels, Sizes(sample_bytes=1))
    assert [len(rows) for rows in seen[:1]] == [10] and len(seen[2]) == 2
    assert all(sum(len(r["body"]) for r in seen[1] if r["label"] == y) <= 200 for y in (0, 1)) and len(seen[1]) >= 2
