"""License scan by diagonal voting.

Every rolling word k-gram of every text is joined to the templates' k-grams (exact, not by hash alone). A match votes
for the diagonal ``word position - template position``: all words of one unbroken copy vote for the same diagonal,
which is where the copy starts, and an inserted or dropped word moves the rest to a neighbouring one. Votes are
counted by diagonal, neighbouring diagonals are merged, and a merged span stands if it covers enough of its template's
words and is not stretched. Phrases must stand word for word: one diagonal with every vote.

Only votes are shuffled, never texts. The template table is a fixed list (a few hundred k-grams), so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import lower_ascii, word_array

#: Separators of the words of the text in ASCII lower case, said for the text as it is.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASE_GRAM, TEXT_GRAM = 2, 4


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: A phrase counts only word for word.
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return "".join(c if c.isalnum() else " " for c in self.text.lower()).split()

    @property
    def gram(self) -> int:
        return PHRASE_GRAM if self.phrase else TEXT_GRAM


PHRASES = (
    Template("mit", "mit license", True), Template("apache", "apache license", True),
    Template("gpl", "general public license", True))

#: Sentences that public licenses ask to be put into a work.
NOTICES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                           "License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    Template("gpl-or-later", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                             "published by the Free Software Foundation"),
    Template("mit-notice", "Released under the MIT license"),
    Template("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                         "associated documentation files, to deal in the Software without restriction"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def grams(starts: str, n: str, k: int) -> Column:
    """The ``k``-grams of the array ``words`` of ``n`` entries that begin at ``starts``, joined by blanks, and their places."""
    joined = ", ' ', ".join(f"words[i + {j}]" for j in range(k))
    return F.expr(f"transform(filter({starts}, i -> i <= {n} - {k}), i -> struct(i AS place, concat({joined}) AS found))")


def likely_starts(templates: Sequence[Template]) -> Column:
    """Places of ``words`` where a gram of a template may begin: its first two words are the first two of some gram, in lower
    case of all letters. Other places hold no gram, so theirs are not made."""
    pairs = {tuple(t.words[i:i + 2]) for t in templates for i in range(len(t.words) - t.gram + 1)}
    first, second = (sorted({pair[side] for pair in pairs}) for side in (0, 1))

    def likely(i: Column) -> Column:
        return F.lower(F.get("words", i)).isin(first) & F.lower(F.get("words", i + 1)).isin(second)

    places = F.when(F.col("n_words") >= 2, F.sequence(F.lit(0), F.col("n_words") - 2)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, likely)


def template_grams(spark, templates: Sequence[Template]) -> DataFrame:
    """(gram, template, at) of all templates, and an empty gram that stands for a text itself."""
    rows = [("", -1, 0)]
    for number, template in enumerate(templates):
        words, k = template.words, template.gram
        if len(words) < k:
            raise ValueError(f"a template needs {k} words: {template.text}")
        rows += [(" ".join(words[i:i + k]), number, i) for i in range(len(words) - k + 1)]
    return spark.createDataFrame(rows, "gram string, template int, at int")


def votes(docs: DataFrame, templates: Sequence[Template], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, n_words, template, diagonal, ats): the template positions that vote for each diagonal. Each text has one
    more row, of template -1. ``row`` tells rows apart, whatever their ids."""
    spark = docs.sparkSession
    texts = (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                    word_array(F.col(text_col), SEPARATORS).alias("words"))
        .withColumn("n_words", F.size("words"))
        .withColumn("starts", likely_starts(templates))
        .select("row", "id", "n_words", F.concat(F.expr("array(struct(0 AS place, '' AS found))"), grams("starts", "n_words", PHRASE_GRAM),
                                                 grams("starts", "n_words", TEXT_GRAM)).alias("grams"))
        # The array is never empty; an inner explosion would be given a filter that makes it a second time.
        .select("row", "id", "n_words", F.inline_outer("grams")))
    known = template_grams(spark, templates).withColumn("h", F.xxhash64("gram"))
    # Lower case of all letters finds candidates fast; equality is that of A-Z only.
    hit = (F.xxhash64(F.lower("found")) == F.col("h")) & (lower_ascii(F.col("found")) == F.col("gram"))
    return (texts.join(F.broadcast(known), hit)
            .withColumn("diagonal", F.when(F.col("template") < 0, 0).otherwise(F.col("place") - F.col("at")))
            .groupBy("row", "id", "n_words", "template", "diagonal").agg(F.collect_set("at").alias("ats")))


def spans(docs: DataFrame, templates: Sequence[Template] = PHRASES + NOTICES, id_col: str = "doc_id",
          text_col: str = "text", slack: int = 3, min_cover: float = 0.8) -> DataFrame:
    """One row per verified span: row, id_col, n_words, label, phrase, start_word, end_word (past it), score.

    Each text has one more row whose label is NULL. NULL texts count as empty. Repeated rows have spans each; empty
    tables give no rows; columns other than id and text are ignored.
    """
    spark = docs.sparkSession
    facts = spark.createDataFrame(
        [(-1, None, True, 0, 1)] + [(i, t.label, t.phrase, len(t.words), t.gram) for i, t in enumerate(templates)],
        "template int, label string, phrase boolean, size int, k int")
    voted = votes(docs, templates, id_col, text_col).join(F.broadcast(facts), "template")
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(near) > F.when(F.col("phrase"), 0).otherwise(slack), F.lit(True))
    merged = (
        voted.withColumn("apart", apart.cast("int"))
        .withColumn("run", F.sum("apart").over(near.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("cells", F.expr("flatten(transform(ats, a -> sequence(a, a + k - 1)))"))
        .groupBy("row", "id", "n_words", "template", "label", "phrase", "size", "run")
        .agg(F.min(F.col("diagonal") + F.array_min("cells")).alias("start_word"),
             (F.max(F.col("diagonal") + F.array_max("cells")) + 1).alias("end_word"),
             F.size(F.array_distinct(F.flatten(F.collect_list("cells")))).alias("cover")))
    score = F.col("cover") / F.greatest("size", F.col("end_word") - F.col("start_word"))
    stands = F.col("label").isNull() | F.when(F.col("phrase"), F.col("cover") == F.col("size")).otherwise(score >= min_cover)
    return merged.filter(stands).select(
        "row", F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), "label", "phrase",
        F.when(F.col("label").isNotNull(), F.col("start_word").cast("long")).alias("start_word"),
        F.when(F.col("label").isNotNull(), F.col("end_word").cast("long")).alias("end_word"),
        F.when(F.col("label").isNull(), 0.0).otherwise(score).alias("score"))


def labelled(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per text from its spans: counts and places of phrases, labels of phrases and of all templates, score."""
    base = F.col("phrase") & F.col("label").isNotNull()

    def names(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    return found.groupBy("row", id_col, "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start_word"))).alias("first_word"),
        F.max(F.when(base, F.col("start_word"))).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("label").isNotNull()).alias("labels"),
        F.max("score").alias("score")).drop("row")
