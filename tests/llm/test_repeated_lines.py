import random

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import queries
from zoneflow.llm.substring_dedup import LEAST_WORDS, drop_repeated_passages, line_pieces

SCHEMA = "doc_id long, text string"


def brute(rows, least=LEAST_WORDS):
    """(id, text, lines, whole lines, passages, spans) of rows in their order."""
    pieces = []
    for i, text in rows:
        own, at = [], 0
        for k, line in enumerate((text or "").split("\n")):
            own += [(k, at + a, at + b, n, norm) for a, b, n, norm in line_pieces(line)]
            at += len(line) + 1
        pieces.append(own)
    first = {}
    for row in sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, r)):
        for at, p in enumerate(pieces[row]):
            first.setdefault(p[4], (row, at))
    out = []
    for row, (i, text) in enumerate(rows):
        repeated = [first[p[4]] != (row, at) for at, p in enumerate(pieces[row])]
        gone, at = [False] * len(repeated), 0
        while at < len(repeated):
            end = at
            while end < len(repeated) and repeated[end]:
                end += 1
            if sum(p[3] for p in pieces[row][at:end]) >= least:
                gone[at:end] = [True] * (end - at)
            at = max(end, at + 1)
        kept, spans, whole, place = [], [], 0, 0
        for k, line in enumerate((text or "").split("\n")):
            own = [(p, g) for p, g in zip(pieces[row], gone) if p[0] == k]
            if own and all(g for _, g in own):
                spans.append((place, place + len(line)))
                whole += 1
            else:
                keep = [True] * len(line)
                for j, (p, g) in enumerate(own):
                    if g:
                        stop = own[j + 1][0][1] if j + 1 < len(own) else place + len(line)
                        keep[p[1] - place:stop - place] = [False] * (stop - p[1])
                kept.append("".join(c for c, stays in zip(line, keep) if stays))
                begin = None
                for c, stays in enumerate([*keep, True]):
                    if not stays and begin is None:
                        begin = c
                    if stays and begin is not None:
                        spans.append((place + begin, place + c))
                        begin = None
            place += len(line) + 1
        out.append((i, "\n".join(kept), len((text or "").split("\n")), whole, len(spans) - whole, spans))
    return sorted(out, key=repr)


def found(frame, **options):
    return sorted(((r.doc_id, r.text, r.n_units, r.n_removed, r.n_passages, [(x.begin, x.end) for x in r.removed])
                   for r in drop_repeated_passages(frame, **options).collect()), key=repr)


def test_the_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    query = sorted(((r.doc_id, r.text, r.n_units, r.n_removed, r.n_passages, [(x.begin, x.end) for x in r.removed])
                    for r in queries.op4_substring_dedup(spark, sf_dir).collect()), key=repr)
    assert query == brute(rows) and any(r[4] for r in query) and any(r[3] for r in query)


@pytest.mark.parametrize("least", [1, 12, 35])
def test_odd_rows_equal_brute_force(spark, least):
    rng = random.Random(least)
    lines = [" ".join(rng.choice("abcdefghij") + rng.choice(["", ".", "é", "!"]) for _ in range(rng.randint(0, 30))) for _ in range(12)]
    rows = [(rng.choice([1, 2, 3, None]), "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6)))) for _ in range(40)]
    rows += [(4, None), (4, ""), (5, "\n\n"), (6, "A  b c.\na B\tc."), (7, "x " * 30000), (8, "y" * 50000), (9, "x " * 30000), (3, "Yes."), (2, "Yes.")]
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1).withColumns({"row": F.lit(1), "at": F.lit("x"), "words": F.lit(2), "digest": F.lit(3)})
    assert found(frame, least_words=least) == brute(rows, least)


def test_repeated_rows_empty_tables_and_hot_pieces(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text)] * 5 + [(None, text)]
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert [r[1] for r in found(frame)].count(text) == 1 and found(frame) == brute(rows)
    monkeypatch.setattr("zoneflow.llm.substring_dedup.HOT", 10 ** 9)
    assert found(frame) == brute(rows)
    monkeypatch.setattr("zoneflow.llm.substring_dedup.HOT", 1)
    assert found(frame) == brute(rows)
    assert found(frame.limit(0)) == []


def test_short_lines_stay_and_go_only_together(spark):
    line = "end of the list."
    many = "\n".join(f"short line number {i} here." for i in range(9))
    rows = [(1, line), (2, f"{line}\nother words"), (3, many), (4, f"first of all\n{many}\nlast of all")]
    kept = {r.doc_id: r for r in drop_repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept[2].text == f"{line}\nother words" and kept[4].text == "first of all\nlast of all" and kept[4].n_removed == 9


def test_a_passage_goes_from_lines_that_differ_elsewhere(spark):
    passage = " ".join(f"Word{i}." if i % 7 == 0 else f"word{i}" for i in range(120))
    rows = [(1, f"one begins so. {passage} ends one.\nThe end."), (2, f"two begins unlike it.  {passage}\n\nthe  END."),
            (3, f"three. {passage.replace('word60', 'of word60')} and it goes on"), (4, passage.replace(".", "")), (None, None), (6, "")]
    kept = {r.doc_id: r for r in drop_repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    texts = dict(rows)
    assert kept[1].text == texts[1] and kept[1].removed == []
    assert kept[2].text.startswith("two begins unlike it.") and len(kept[2].text.split()) < 30
    assert len(kept[3].text.split()) < 45 and "of word60" in kept[3].text and kept[3].n_passages == 2
    assert kept[6].text == kept[None].text == ""
