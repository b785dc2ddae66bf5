"""Repeated passages across texts: lines are cut into pieces, digests of the normalised pieces are grouped globally, the
earliest occurrence by (id, place) stays and the rest are removed, with their original offsets kept.

A piece ends with its line, after a word with a mark at its end, and after one word in 32 chosen by its hash, which finds the same
ends in text without marks; so a passage is found although its line differs elsewhere. Repeated pieces go in unbroken
runs of ``LEAST_WORDS`` words or more, over line ends too: a line of so many words goes as a whole, several short ones go
together, and a short line or phrase by itself stays.

The earliest occurrence of a digest is a minimum, combined before the shuffle. Only digests that repeat are joined with
their occurrences: the at most ``HOT`` that hold more than one in ``HOT`` of all occurrences by broadcast, as an equi-join
with an aggregate is not split by adaptive execution, the others by shuffle. A window and a list never hold more than one
text's pieces. Digests have 64 bits, as a chance collision of one piece does not make a run; texts are shuffled
compressed.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from zoneflow.llm.common import frees_memory, in_small_batches
from zoneflow.session import materialize

LEAST_WORDS, HOT = 35, 1000
WORD, MARKS = re.compile(r"\S+"), frozenset(".!?;:\u2026\u3002\uff01\uff1f\uff1b")


def line_pieces(line: str) -> list[tuple[int, int, int, str]]:
    """(begin, end, words, normalised text) of the pieces of a line; blank lines have none."""
    found, words, begin = [], [], 0
    for m in WORD.finditer(line):
        if not words:
            begin = m.start()
        word = m[0].lower()
        words.append(word)
        if word[-1] in MARKS or zlib.crc32(word.encode("utf-8", "surrogatepass")) % 32 == 0:
            found.append((begin, m.end(), len(words), " ".join(words)))
            words = []
    if words:
        found.append((begin, m.end(), len(words), " ".join(words)))
    return found


def digest(norm: str) -> int:
    return int.from_bytes(hashlib.blake2b(norm.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def compressed(names: list[str]):
    """(row, id, text) with the text as zstandard bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress(t.encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=names)
    return run


def unpacked(column: pa.Array) -> Iterator[str]:
    packer = zstandard.ZstdDecompressor()
    for raw in column:
        yield packer.decompress(raw.as_py()).decode("utf-8", "surrogatepass")


def unit_digests(separator: str, names: list[str]):
    """(row, id, at, words, digest) of all pieces, counted from 0 through a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                own, at, words, digests = [], [], [], []
                for i, text in enumerate(unpacked(part.column(2))):
                    pieces = [p for line in text.split(separator) for p in line_pieces(line)]
                    own += [i] * len(pieces)
                    at += range(len(pieces))
                    words += [p[2] for p in pieces]
                    digests += [digest(p[3]) for p in pieces]
                take = pa.array(own, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(at, pa.int32()),
                     pa.array(words, pa.int32()), pa.array(digests, pa.int64())], names=names)
    return run


def without(text: str, gone: set[int], separator: str) -> tuple[str, int, list[tuple[int, int]], int]:
    """What stays of ``text``, its lines, the spans that go, and how many of them are whole lines."""
    kept, spans, place, n, whole = [], [], 0, 0, 0
    lines = text.split(separator)
    for line in lines:
        pieces = line_pieces(line) if gone else []
        going = [n + j in gone for j in range(len(pieces))]
        n += len(pieces)
        if pieces and all(going):
            spans.append((place, place + len(line)))
            whole += 1
        else:
            cuts, j = [], 0
            while j < len(pieces):
                first = j
                while j < len(pieces) and going[j]:
                    j += 1
                if j > first:
                    cuts.append((pieces[first][0], pieces[j][0] if j < len(pieces) else len(line)))
                j += 1
            edges = [0, *(x for cut in cuts for x in cut), len(line)]
            kept.append("".join(line[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans += [(place + a, place + b) for a, b in cuts]
        place += len(line) + len(separator)
    return separator.join(kept), len(lines), spans, whole


def remover(separator: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                found = [without(text, set(gone or ()), separator) for text, gone in
                         zip(unpacked(part.column("text")), part.column("gone").to_pylist(), strict=True)]
                spans = [[{"begin": a, "end": b} for a, b in f[2]] for f in found]
                columns = [[f[0] for f in found], [f[1] for f in found], [f[3] for f in found],
                           [len(f[2]) - f[3] for f in found], spans]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *(pa.array(c, schema.field(i + 1).type) for i, c in enumerate(columns))], names=schema.names)
    return run


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", separator: str = "\n",
                           least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per row of ``docs``: id_col, text (what stays), n_units (lines), n_removed (lines that went whole), n_passages
    (spans that went inside other lines), removed (begin and end characters of all of these in the original text).

    Pieces are compared in lower case with single spaces; blank lines always stay. NULL counts as empty; rows that repeat
    lose what the first of them has; a NULL id comes last; empty tables give no rows; other columns are ignored."""
    chosen = in_small_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = chosen.schema["id"].dataType
    packed = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", kind), T.StructField("text", T.BinaryType())])
    texts = materialize(chosen.mapInArrow(frees_memory(compressed(packed.names)), packed))
    schema = T.StructType([*packed.fields[:2], T.StructField("at", T.IntegerType()), T.StructField("words", T.IntegerType()),
                           T.StructField("digest", T.LongType())])
    units = materialize(texts.mapInArrow(frees_memory(unit_digests(separator, schema.names)), schema))
    rank = F.struct(F.col("id").isNull(), "id", "row", "at")
    repeats = materialize(units.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        "digest", F.col("first.row").alias("first_row"), F.col("first.at").alias("first_at"), "n"))
    total = units.count()
    hot = repeats.filter(F.col("n") * HOT > total).select("digest", F.col("first_row").alias("hot_row"), F.col("first_at").alias("hot_at"))
    cold = repeats.filter(F.col("n") * HOT <= total).drop("n")
    marked = units.drop("id").join(F.broadcast(hot), "digest", "left")
    own = ["row", "at", "words"]
    found = marked.filter("hot_row IS NOT NULL").select(*own, F.col("hot_row").alias("first_row"), F.col("hot_at").alias("first_at")).unionAll(
        marked.filter("hot_row IS NULL").join(cold, "digest").select(*own, "first_row", "first_at"))
    seen = found.filter((F.col("row") != F.col("first_row")) | (F.col("at") != F.col("first_at"))).select(*own)
    runs = seen.withColumn("run", F.col("at") - F.row_number().over(Window.partitionBy("row").orderBy("at")))
    length = F.sum("words").over(Window.partitionBy("row", "run"))
    gone = runs.withColumn("length", length).filter(F.col("length") >= least_words).groupBy("row").agg(F.collect_list("at").alias("gone"))
    out = T.StructType([T.StructField(id_col, kind), T.StructField("text", T.StringType()), *(
        T.StructField(c, T.LongType()) for c in ("n_units", "n_removed", "n_passages")), T.StructField("removed", T.ArrayType(
            T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])))])
    return texts.join(gone, "row", "left").select("id", "text", "gone").mapInArrow(frees_memory(remover(separator, to_arrow_schema(out))), out)
