"""The registered queries of this subpackage: thin contracts over its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import hard_negatives, language_id, lm_scoring, toxicity, vector_codes
from zoneflow.llm.best_fit_packing import pack_documents
from zoneflow.llm.common import id_hash_mod, table, vocabulary
from zoneflow.llm.embedding_dedup import near_copies
from zoneflow.llm.exact_dedup import mark_copies
from zoneflow.llm.license_scan import labelled, spans
from zoneflow.llm.ngram_join import similar_components
from zoneflow.llm.source_mix import mix_sources
from zoneflow.llm.substring_dedup import drop_repeated_passages
from zoneflow.llm.url_filter import Rule, judge_urls

URL_RULES = (
    Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(table(spark, sf_dir, "documents"))
    return mix.places.join(mix.taken(), "row", "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spans(table(spark, sf_dir, "documents")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_passages(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "embeddings"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents"), keep="max")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_hash_mod("doc_id", 7) == 2
    docs = table(spark, sf_dir, "documents")
    model = lm_scoring.train(docs.filter(~held_out))
    return lm_scoring.score(docs, model, keep=(held_out.alias("held_out"),)).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_hash_mod("doc_id", 4) == 2)
    model = language_id.learn(docs.filter(~F.col("held_out")))
    judged = language_id.identify(docs.select("doc_id", "held_out", "text"), model)
    return judged.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), "language.score",
                         "language.rejected")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, scale=256, label=label)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_hash_mod("doc_id", 5) == 0
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    network = toxicity.learn(docs, labels.filter(~held_out))
    return toxicity.score(docs, network, keep=("doc_id", held_out.alias("held_out")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_source_mix, op3_url_filter, op4_substring_dedup, op5_embedding_dedup, op6_exact_dedup, op7_lm_scoring, op8_best_fit_packing, op9_language_id, op10_ngram_join,
                                op11_vector_codes, op12_hard_negatives, op13_toxicity)}
