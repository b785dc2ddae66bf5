import collections
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.llm import best_fit_packing as bp
from zoneflow.llm import source_mix as sm
from zoneflow.llm.common import vocabulary
from zoneflow.session import materialize

SPACED = re.compile("[^\x20\x09-\x0D]+")


def test_targets_share_what_small_sources_cannot_take():
    found = sm.targets([100, 100, 100, 1000])
    assert sum(found) == pytest.approx(1.5 * 1300) and all(t <= 2 * s + 1e-9 for t, s in zip(found, [100, 100, 100, 1000]))
    assert found[:3] == [200, 200, 200]
    assert sm.targets([0, 10]) == [0, 15] and sm.targets([]) == []
    assert sm.targets([1000, 1000, 1000], (5, 2, 1), Fraction(3, 2)) == [2000, pytest.approx(5000 / 3), pytest.approx(2500 / 3)]


@pytest.mark.parametrize("count", [1, 2, 3, 7, 64, 100, 1023, 1025])
def test_indexes_are_permuted(spark, count):
    rows = spark.range(count).withColumnRenamed("id", "block").selectExpr("block", "0 AS source_no", "0 AS times")
    constants = spark.createDataFrame(sm.permutations([count], 1), "source_no int, times int, blocks long, power long, half long, "
                                                                   "add array<long>, odd array<long>")
    found = [r.block for r in sm.permuted(rows.join(constants, ["source_no", "times"]), "block").collect()]
    assert sorted(found) == list(range(count))
    assert count < 64 or found != list(range(count))


def docs_of(spark):
    draw = random.Random(3)
    rows = [(0, None, "a", "t"), (1, "", "b", "t"), (2, " \t ", None, "t"), (3, "three\u00a0words here", "lone", "t"), (3, "x y", "lone", "t")]
    rows += [(i, " ".join(["w"] * draw.randrange(1, 200)), draw.choice(["a", "a", "a", "b", "Z", "é", None]), "t") for i in range(10, 400)]
    rows.append((900, "long " * 20_000, "a", "t"))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, target string")


def test_mix_takes_near_targets_and_repeats(spark):
    rows, docs = docs_of(spark)

    def taken(frame):
        mix = sm.mix_sources(frame)
        return sorted((r.id, r["size"], r.source_size, round(r.target, 6), r.taken or 0) for r in mix.places.join(mix.taken(), "row", "left").collect())

    found = taken(docs)
    assert len(found) == len(rows)
    assert [(r[0], r[1]) for r in found] == sorted((i, len(SPACED.findall(t or ""))) for i, t, *_ in rows)
    assert all(r[4] <= 2 * r[1] for r in found)
    by_source = collections.defaultdict(lambda: [0, 0.0, 0])
    for r in found:
        by_source[r[2], r[3]][0] += r[4]
    total = sum(r[1] for r in found)
    for (size, target), (words, *_) in by_source.items():
        assert abs(words - target) <= max(0.05 * target, 3 * sm.BLOCK), (size, target, words)
    assert sum(r[4] for r in found) == pytest.approx(1.5 * total, rel=0.02)
    assert taken(docs.repartition(5)) == found
    assert taken(docs.limit(0)) == []


def test_mixed_texts_hold_the_words_taken(spark):
    rows, docs = docs_of(spark)
    found = sm.mixed_texts(docs, shard_slots=50)
    assert found.columns == docs.columns
    words = collections.Counter()
    for r in found.collect():
        words[r.source] += len(SPACED.findall(r.text))
    mix = sm.mix_sources(docs, shard_slots=50, carry=True)
    wanted = {r[0]: r[1] for r in mix.places.join(mix.taken(), "row").groupBy("rest.source").sum("taken").collect()}
    assert words == wanted
    whole = {t for _, t, *_ in rows}
    assert any(r.text in whole for r in found.collect())


def fewest(lengths, capacity):
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best[0]


def test_bin_completion_finds_the_fewest_bins():
    draw = random.Random(2)
    for trial in range(120):
        capacity = draw.choice([10, 30, 100])
        top = capacity if trial % 2 else capacity // 2 + capacity // 6
        lengths = [draw.randint(1, top) for _ in range(draw.randint(0, 10))]
        bins = bp.complete_bins(lengths, capacity)
        assert sorted(x for b in bins for x in b) == sorted(lengths) and all(sum(b) <= capacity for b in bins)
        assert bp.lower_bound(lengths, capacity) <= fewest(lengths, capacity) == len(bins)
    # Best fit decreasing needs four.
    assert len(bp.complete_bins([6, 5, 5, 3, 3, 2, 2, 2, 2], 10)) == 3


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


TEXTS = [None, "", " ", "Hello, world!", "It's 2024 -- don't", "ÉCOLE naïve İstanbul ß ǅ", "a\u00a0b\u2003c\r\nd\x1ce", "<|endoftext|> x<|startoftext|>",
         "e\u0301 cafe\u0301 \u212b", "word " * 5000, "日本語 テキスト 123", "x" * 3000, "\ud7ff", "The, THE, the."]


def test_cached_ids_are_the_tokenizers(tokenizer):
    cache = bp.WordCache(vocabulary("word_bpe_49k.json"), limit=3)
    for _ in range(2):
        for text in TEXTS[1:]:
            assert np.frombuffer(cache.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("group_pieces", [8192, 5])
def test_packed_pieces(spark, tokenizer, group_pieces):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS * 2)], "doc_id long, text string, sequence_id int")
    pieces = bp.token_pieces(docs, vocabulary("word_bpe_49k.json"), with_ids=True)
    rows = bp.pack_pieces(pieces.cache(), group_pieces=group_pieces).collect()
    places, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    for i, text in enumerate(TEXTS * 2):
        own = sorted(by_doc[i], key=lambda r: r.piece)
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == ids
        assert [r.start for r in own] == list(range(0, len(ids), 4096))
    if group_pieces > len(rows):
        assert len(places) == -(-sum(r.length for r in rows) // 4096)
    assert bp.pack_documents(docs.limit(0), vocabulary("word_bpe_49k.json")).count() == 0


def test_lengths_that_must_pair_meet_across_groups(spark):
    # 32,768 pieces of either length: only a bin with one of both has no waste.
    frame = spark.range(65_536).select(F.col("id"), F.when(F.col("id") % 2 == 0, 2500).otherwise(1596).cast("long").alias("length"))
    packed = bp.pack_pieces(materialize(frame))
    assert packed.select("sequence_id").distinct().count() == 32_768
    assert packed.count() == 65_536 and packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


def test_one_group_and_several_get_the_same_search(spark):
    # A search of a tenth of the nodes ends before it has packed 1,800 pieces.
    draw = random.Random(4)
    frame = materialize(spark.createDataFrame([(i, draw.randint(1300, 1420)) for i in range(3600)], "id long, length long"))
    counts = [bp.pack_pieces(frame, group_pieces=n).select("sequence_id").distinct().count() for n in (3600, 1800)]
    assert max(counts) <= 1.02 * min(counts)


def test_ids_of_characters_of_all_kinds(tokenizer):
    draw = random.Random(5)
    low, cache = [chr(i) for i in range(0x130)] + list("'''stmdlrv ") * 8, bp.WordCache(vocabulary("word_bpe_49k.json"), limit=50)
    wide = low + list("İſ̀́Åﬁ 日<|>") * 3
    for i in range(1000):
        text = "".join(draw.choices(wide if i % 2 else low, k=draw.randint(1, 30)))
        assert np.frombuffer(cache.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_rounds_that_save_nothing_end(spark):
    frame = materialize(spark.range(3_000).select("id", F.lit(2500).cast("long").alias("length")))
    packed = bp.pack_pieces(frame, group_pieces=100)
    assert packed.select("sequence_id").distinct().count() == 3_000 and packed.count() == 3_000
    assert packed.filter("offset <> 0").count() == 0 and packed.columns == ["id", "length", "sequence_id", "offset"]
