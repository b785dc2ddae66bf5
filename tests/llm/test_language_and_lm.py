import collections
import math
import re
import zlib

import numpy as np
import pytest

from zoneflow.llm import language_id, lm_scoring, queries

SPACED = re.compile("[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def test_held_out_language_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = queries.op9_language_id(spark, sf_dir).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_of_odd_texts(spark, sf_dir):
    model = language_id.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = [(i, t, "und") for i, t in enumerate([None, "", "123 !?", "the of and is with that", "der die und ist nicht " * 5000, "é"])]
    odd = spark.createDataFrame(rows, "doc_id long, text string, language string")
    found = {r.doc_id: r.language for r in language_id.identify(odd, model).collect()}
    assert all(found[i].lang == "und" and found[i].rejected and found[i].score == 0 for i in (0, 1, 2))
    assert (found[3].lang, found[4].lang) == ("en", "de") and found[5].lang in model.dictionaries
    assert language_id.keep_identified(odd, model).columns == odd.columns
    assert language_id.identify(odd.limit(0), model).count() == 0
    nothing = language_id.learn(spark.createDataFrame([(1, "x", None)], "doc_id long, text string, lang string"))
    assert {r.language.lang for r in language_id.identify(odd, nothing).collect()} == {"und"}


def test_base_scores_equal_brute_force_and_the_model_beats_them(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    tokens = {i: [*SPACED.findall((t or "").translate(FOLD)), None] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    rows = queries.op7_lm_scoring(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        own = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(counts[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def small_model(spark):
    texts = ["a b c. a b", "A B", None, "", "a zed"] * 3
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    return texts, docs, lm_scoring.train(docs)


def test_class_probabilities_are_normalised(spark):
    _, _, model = small_model(spark)
    n = model.classes.count
    one, two = np.repeat(np.arange(n), n)[:4 * n], np.full(4 * n, model.classes.end)
    logs = model.net.log10_probabilities(np.tile(np.arange(n), 4), one, two)
    assert (10 ** logs).reshape(4, n).sum(axis=1) == pytest.approx(np.ones(4), rel=1e-4)


def test_scores_of_odd_and_repeated_rows(spark):
    texts, docs, model = small_model(spark)
    rows = lm_scoring.score(docs.unionAll(docs), model).collect()
    assert len(rows) == 2 * len(texts) and all(r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if texts[r.doc_id] in (None, "")} == {1}
    assert len({r.score for r in rows if r.doc_id == 0}) == 1
    assert lm_scoring.score(docs.limit(0), model).count() == 0
    unseen = spark.createDataFrame([(1, "never seen " * 30_000)], "doc_id long, text string")
    row = lm_scoring.score(unseen, model).first()
    assert (row.n_tokens, row.n_known) == (60_001, 1)
    empty = lm_scoring.train(docs.limit(0))
    row = lm_scoring.score(unseen, empty).first()
    assert (empty.tokens, row.n_known) == (0, 0) and row.base_score == 0.0


def test_contexts_stop_at_the_beginning_of_a_text():
    classes = lm_scoring.Classes(np.array([], dtype=np.uint64))
    own, hashes, lasts = np.array([0, 0, 2]), np.array([1, 2, 3], dtype=np.uint64), np.array([97, 98, 99])
    number, cls, one, two = classes.sequence(own, hashes, lasts, 3)
    end, (a, b, c) = classes.end, lm_scoring.ending_class(lasts)
    assert number.tolist() == [0, 0, 0, 1, 2, 2] and cls.tolist() == [a, b, end, end, c, end]
    assert one.tolist() == [end, a, b, end, end, c] and two.tolist() == [end, end, a, end, end, end]
