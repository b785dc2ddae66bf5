import re

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import license_scan as ls
from zoneflow.llm.queries import URL_RULES, op3_url_filter
from zoneflow.llm.url_filter import Rule, Vocabulary, judge_urls

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def phrases_in(text):
    words = WORD.findall((text or "").translate(FOLD))
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        wanted = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(wanted)] == wanted]
    return len(words), sorted(found)


TEXTS = [
    None, "", " .,", "MIT", "MIT License", "mit-license; MIT LICENSE", "the general public license of mit", "mit license " * 400,
    "GNU General Public License, apache license mit license", "\u212aelvin mit\u00a0license", "mit\u0130 license MIT\tLicense", "x" * 70_000 + " mit license",
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.",
]


def docs_of(spark, texts):
    rows = [(i, t, "other") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, label string")


def test_phrases_equal_brute_force(spark):
    rows = ls.labelled(ls.spans(docs_of(spark, TEXTS))).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        n, found = phrases_in(TEXTS[row.doc_id])
        starts = [i for i, _ in found]
        assert (row.n_words, row.n_base) == (n, len(found))
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


def test_whole_documents_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in ls.labelled(ls.spans(docs)).collect():
        n, found = phrases_in(texts[row.doc_id])
        assert (row.n_words, row.n_base) == (n, len(found))


def test_notices_with_changed_words_are_one_span_of_merged_diagonals(spark):
    text = ("word " * 50 + "Redistribution and use in source and binary forms, with or without any modification, are permitted "
            "provided that following conditions are met " + "word " * 50)
    found = ls.spans(docs_of(spark, [text, "Redistribution and use in source"])).filter("label = 'bsd'").collect()
    assert [(r.doc_id, r.start_word) for r in found] == [(0, 50)] and 0.8 <= found[0].score < 1


def test_scan_of_repeated_rows_and_of_no_rows(spark):
    docs = docs_of(spark, ["mit license"])
    assert [r.n_base for r in ls.labelled(ls.spans(docs.unionAll(docs))).collect()] == [1, 1]
    assert ls.labelled(ls.spans(docs.limit(0))).count() == 0


def test_grams_are_made_once_and_only_where_one_may_begin(spark, capsys):
    docs = docs_of(spark, ["a b the MIT License of a fox", "mıt license Åpache Licenſe", "general public", "mit", None])
    found = ls.votes(docs, ls.PHRASES)
    found.explain()
    assert "size(concat(" not in capsys.readouterr().out
    assert [(r.id, r.template, r.diagonal, r.ats) for r in found.filter("template >= 0").orderBy("id").collect()] == [
        (0, 0, 3, [0]), (2, 2, 0, [0])]
    starts = docs.select(ls.word_array(F.col("text"), ls.SEPARATORS).alias("words")).withColumn("n_words", F.size("words"))
    assert [r[0] for r in starts.select(ls.likely_starts(ls.PHRASES)).collect()] == [[3], [], [0], [], []]


RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("com", "/de/", "block"))


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme/casino", "", "", None, "block"),
    ("http://A.Example.ORG/es/1?x=/y", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/ES/1", "example.org", "/ES/1", "org/", "allow"), ("http://org", "org", "", None, "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"), ("x://b.com/de/", "b.com", "/de/", "com/de/", "block"),
    ("x://b.com?u=y://z.org/", "b.com", "", None, "allow"), ("http://casinos.net/", "casinos.net", "/", None, "allow"),
    ("http://m.ads-track.net/", "m.ads-track.net", "/", None, "block"), ("http://ads.ads.net/ads", "ads.ads.net", "/ads", None, "allow"),
    ("http://my-CASINO.net/", "my-casino.net", "/", None, "block"), ("http://casino.org/", "casino.org", "/", "org/", "allow"),
])
def test_url_verdicts(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "h")], "page_id long, url string, host string")
    row = judge_urls(pages, RULES).first()
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)


def test_own_vocabulary_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, "a://b/c-d"), (1, "a://b/c-d")], "page_id long, url string")
    found = judge_urls(pages, vocabulary=Vocabulary(strict=(), soft=("c", "d", "b"), soft_needed=3)).collect()
    assert [r.verdict for r in found] == ["block"] * 2
    assert judge_urls(pages.limit(0), RULES).count() == 0


def test_rules_of_the_query_are_those_of_its_contract():
    contract = "allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/"
    assert [f"{r.verdict} {r.name}" for r in URL_RULES] == contract.split(", ")


@pytest.mark.parametrize("url, rule, verdict", [
    ("http://example.org/en/1", "example.org/en/1", "block"), ("http://a.example.org/en/17?x", "example.org/en/1", "block"),
    ("http://example.org/en/2", "org/", "allow"), ("http://b.org/en/1", "org/", "allow"),
])
def test_verdicts_of_the_query(spark, tmp_path, url, rule, verdict):
    spark.createDataFrame([(1, url)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    row = op3_url_filter(spark, str(tmp_path)).first()
    assert (row.rule, row.verdict) == (rule, verdict)
