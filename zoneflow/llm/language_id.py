"""Language identification by compression.

Each language gets a zstandard raw-content dictionary made of a bounded sample of its labelled texts. A text is encoded
in blocks with every dictionary; the language whose encoding is smallest wins. A text whose two best encodings are
nearly as long is rejected.

The sample: per language labelled texts in the order of a hash of id and text, whole ones, until they are ``sample_docs`` or
``sample_bytes``; a text that does not fit is passed over. Languages are few, so the dictionaries (some 250 KB each) go to the
tasks with the function.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import in_small_batches, release_memory

UNKNOWN = "und"


@dataclass(frozen=True)
class CompressionModel:
    """Dictionary bytes by language, and how to encode."""

    dictionaries: dict[str, bytes]
    #: A text's length is summed over these levels: the higher tells long texts better, the lower short ones.
    levels: tuple[int, ...] = (3, 5)
    block: int = 16384
    #: Texts whose second best encoding is less than this share longer than the best are rejected.
    min_margin: float = 0.002

    def encoders(self) -> dict[str, list[zstandard.ZstdCompressor]]:
        found = {}
        for lang, content in self.dictionaries.items():
            found[lang] = []
            for level in self.levels:
                own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                own.precompute_compress(level=level)
                found[lang].append(zstandard.ZstdCompressor(
                    level=level, dict_data=own, write_checksum=False, write_content_size=False, write_dict_id=False))
        return found

    def judge(self, text: str | None, encoders: dict[str, list[zstandard.ZstdCompressor]]) -> tuple[str, float, bool]:
        """(language, score, rejected); ties go to the language whose name is first."""
        if not text or not encoders or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        data = prepared(text)
        parts = [data[i:i + self.block] for i in range(0, len(data), self.block)]
        sizes = sorted((sum(len(e.compress(p)) for e in own for p in parts), lang) for lang, own in encoders.items())
        best, second = sizes[0][0], sizes[min(1, len(sizes) - 1)][0]
        margin = 1.0 if len(sizes) == 1 else (second - best) / second
        return sizes[0][1], margin, margin < self.min_margin


def prepared(text: str) -> bytes:
    """Lower case, single spaces."""
    return " ".join(text.lower().split()).encode("utf-8", "replace")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = 512, sample_bytes: int = 262_144, **options) -> CompressionModel:
    """Dictionaries from labelled rows. Rows without label, text or letters teach nothing, equal rows count once; without any
    labelled row the model knows no language and predicts ``und``."""
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    labelled = labelled.select(F.xxhash64(id_col, text_col).alias("h"), F.col(lang_col).cast("string").alias("lang"),
                               F.octet_length(text_col).alias("size"), F.col(text_col).alias("body"))
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("h").alias("rows"))  # as many rows as languages
    place = F.col("h") / F.lit(2.0 ** 64) + 0.5
    # About twice as many rows as wanted in every language, wherever they lie; the first ones are taken.
    near = labelled.join(F.broadcast(counts), "lang").filter(place * F.col("rows") < 2 * sample_docs)
    taken, sizes = [], {}
    for row in sorted(near.select("lang", "h", "size").distinct().collect()):
        n, size = sizes.get(row["lang"], (0, 0))
        if n < sample_docs and size + row["size"] <= sample_bytes:  # a text that does not fit is passed over
            sizes[row["lang"]] = n + 1, size + row["size"]
            taken.append((row["lang"], row["h"]))
    wanted = docs.sparkSession.createDataFrame(taken, "lang string, h long")
    sample = near.select("lang", "h", "body").join(F.broadcast(wanted), ["lang", "h"]).dropDuplicates(["lang", "h"])
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in sample.collect():
        texts.setdefault(row["lang"], []).append((row["h"], row["body"]))
    return CompressionModel({lang: b" ".join(prepared(t) for _, t in sorted(rows)) for lang, rows in texts.items()}, **options)


def predictor(model: CompressionModel):
    """A function from texts to (lang, score, rejected)."""

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = model.encoders()
        try:
            for texts in batches:
                rows = [model.judge(text, encoders) for text in texts]
                yield pd.DataFrame(rows, columns=["lang", "score", "rejected"])
        finally:
            encoders.clear()
            release_memory()

    return predict


def identify(docs: DataFrame, model: CompressionModel, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``language``: lang, score (margin over the second best, 0 to 1), rejected.

    NULL texts and texts without a letter are ``und``, score 0, rejected. Whole texts count, however long. Columns
    other than the text are no input. A column of that name in ``docs`` is replaced.
    """
    return in_small_batches(docs).withColumn("language", predictor(model)(F.col(text_col)))


def keep_identified(docs: DataFrame, model: CompressionModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language the model tells, with its columns."""
    judged = in_small_batches(docs).select(F.struct(*docs.columns).alias("row"), predictor(model)(F.col(text_col)).alias("language"))
    return judged.filter(~F.col("language.rejected")).select("row.*")
