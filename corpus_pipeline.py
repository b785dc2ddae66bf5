"""A corpus from raw documents, stage by stage: language, exact copies, near copies, mix of sources, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes it as Parquet below the shared folder
and reads it back for the next. All but the last return the columns of ``documents``.

- ``language_id``: texts whose language the classifier rejects go (NULL, no letter, or two languages equally likely). It
  learns from the labelled texts of the same documents.
- ``exact_dedup``: of equal texts the one with the smallest id stays.
- ``ngram_jaccard``: of texts linked by shingle similarity the row with the smallest id stays, the first of several; NULL
  is the largest id.
- ``mix_sources``: sources are mixed to their target weights; a text is a row for each turn it is taken, with the words
  taken.
- ``best_fit_packing``: one row per piece of a text with its place in a sequence.

Empty tables give empty results; NULL texts end in the first stage. Repeated rows are exact copies; other columns pass
through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zoneflow.llm import language_id
from zoneflow.llm.best_fit_packing import pack_documents
from zoneflow.llm.common import vocabulary
from zoneflow.llm.exact_dedup import drop_copies
from zoneflow.llm.ngram_join import drop_similar
from zoneflow.llm.source_mix import mixed_texts
from zoneflow.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.learn(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language), ("exact_dedup", drop_exact_copies), ("ngram_jaccard", drop_near_copies),
    ("mix_sources", mix), ("best_fit_packing", pack),
]

#: A trained classifier, a random mix and a search: SQL cannot express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
