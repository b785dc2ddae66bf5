"""Packing token sequences into bins of a fixed length by bin completion.

Texts are tokenised where they lie; only (id, piece, lengths, checksum) rows are shuffled. Pieces are dealt into groups of
about ``group_pieces`` and each group is packed by branch and bound. Then every bin of which more than a 64th stays empty, and the
emptiest of each group, is taken apart and its pieces are dealt anew, until a round saves less than one bin in a hundred; then
follows one more. A round that saves none is undone. Lengths that a group has too many of so meet what they lack. The rule is
the same for any number of pieces and groups.

Bin completion: the largest piece left gets a bin; the undominated fillings of its rest are enumerated, fullest first. A
branch ends when its waste so far exceeds what a better solution than the incumbent could afford. The incumbent is
best-fit decreasing; a solution that meets the lower bound is final. The search is bounded, not the pieces: ``node_budget`` nodes a
group, before the last round a tenth of them where best-fit decreasing is within a hundredth of the bound; ``breadth``
fillings a node, up to three partners of the largest piece before the rest is filled greedily.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.common import frees_memory, in_small_batches
from zoneflow.session import materialize

CAPACITY, END_ID = 4096, 1


#: Letters, digits and white space below U+0130, as the tokenizer's pattern has them.
LETTERS, DIGITS, BLANKS = "a-zA-Zªµº\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
#: What the tokenizer cuts a text into before it looks for tokens; every such word has ids of its own.
CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{BLANKS}{LETTERS}{DIGITS}]+")
#: Texts with these are left to the tokenizer: other lower case or normal forms, names of special tokens.
OTHERS = re.compile("[^\x00-\u012f]|<\\|")
#: How the tokenizer's model writes bytes: visible ones of Latin-1 as they are, others from U+0100 on.
VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTES = {byte: 256 + n for n, byte in enumerate(b for b in range(256) if b not in VISIBLE)}


class WordCache:
    """Token ids, as little-endian bytes, of the words that the tokenizer cuts a text into.

    The tokenizer looks for tokens within words only, so a text's ids are those of its words in turn. Words seen before
    come from memory; the others go to the tokenizer's model as they are. Memory is bounded: at ``limit`` entries a new
    generation begins, and what is used again moves over from the last one. A text with characters from U+0130 on is cut
    at blanks and line ends, and what has such characters is encoded as it stands.
    """

    def __init__(self, path: str, limit: int = 250_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.last: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if not (text.isascii() and "<|" not in text) and OTHERS.search(text):
            return b"".join([self.ids(part) if OTHERS.search(part) else self.known(part)
                             for part in text.replace("\n", " ").split(" ")])
        return self.known(text)

    def known(self, text: str) -> bytes:
        words = CUT.findall(text.lower())
        new = set(words).difference(self.words)
        if new:
            self.learn(new, words)
        return b"".join(map(self.words.__getitem__, words))

    def learn(self, new: set[str], words: list[str]) -> None:
        """Takes up the ``new`` ones of a text's words."""
        if len(self.words) > self.limit:
            self.last, self.words = self.words, {}
            new = set(words)
        last, tokens = self.last, self.model.tokenize
        for word in new:
            if (ids := last.get(word)) is None:
                plain = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(BYTES)
                ids = array("I", [token.id for token in tokens(plain)]).tobytes()
            self.words[word] = ids

    def ids(self, part: str) -> bytes:
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, dtype="<u4").tobytes()


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Per piece: id_col, piece, start, length, ids_crc32 and, if wanted, ids (little-endian unsigned 32-bit).

    A document's tokens end with ``end_id``; NULL and empty texts are that one token. Documents of more than
    ``capacity`` tokens are cut every ``capacity`` tokens. Every executor reads the tokenizer file from its own disk.
    """
    id_field = T.StructField(id_col, docs.schema[id_col].dataType)
    schema = T.StructType([
        id_field, T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if with_ids else [])])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                raw = (cache.encode(text) if text else b"") + end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[at:at + 4 * capacity]
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
                    if with_ids:
                        ids.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 *([pa.array(ids, pa.binary())] if with_ids else [])], names=schema.names)

    return in_small_batches(docs.select(id_col, text_col)).mapInArrow(frees_memory(cut), schema)


def best_fit_decreasing(lengths: Sequence[int], capacity: int) -> list[list[int]]:
    """Bins as lists of lengths: each piece, largest first, goes where the least room stays."""
    bins: list[list[int]] = []
    rooms: list[int] = []
    at: dict[int, list[int]] = {}
    for length in sorted(lengths, reverse=True):
        k = bisect_left(rooms, length)
        if k < len(rooms):
            room = rooms[k]
            own = at[room].pop()
            if not at[room]:
                rooms.pop(k)
        else:
            room, own = capacity, len(bins)
            bins.append([])
        bins[own].append(length)
        left = room - length
        if left:
            if not at.setdefault(left, []):
                insort(rooms, left)
            at[left].append(own)
    return bins


def lower_bound(lengths: Sequence[int], capacity: int) -> int:
    """The larger of the volume bound and, for every threshold, the bound that counts large pieces apart."""
    ordered = np.sort(np.asarray(lengths, dtype=np.int64))
    sums = np.concatenate([[0], np.cumsum(ordered)])
    best = -(-int(sums[-1]) // capacity)
    for small in np.unique(ordered[ordered <= capacity // 2]):
        over = len(ordered) - int(np.searchsorted(ordered, capacity - small, "right"))
        half, low = int(np.searchsorted(ordered, capacity // 2, "right")), int(np.searchsorted(ordered, small, "left"))
        wide = len(ordered) - over - half
        room = wide * capacity - int(sums[len(ordered) - over] - sums[half])
        best = max(best, over + wide + max(0, -(-(int(sums[half] - sums[low]) - room) // capacity)))
    return best


def fillings(counts: np.ndarray, room: int, most: int) -> list[tuple[int, ...]]:
    """Undominated sets of pieces, up to three, that go into ``room``; fullest first, then of fewer pieces.

    A set is dominated when another one replaces one of its pieces by a larger one, or adds one, within the room.
    """
    sizes = np.flatnonzero(counts[:room + 1])
    if not len(sizes):
        return [()]
    one = int(sizes[-1])
    found = {(one,)}
    if one < room:
        pairs = sizes[sizes <= room - int(sizes[0])]
        partner = np.searchsorted(sizes, room - pairs, "right") - 1
        for a, k in zip(pairs.tolist(), partner.tolist(), strict=True):
            b = int(sizes[k])
            if b > a or b < a:
                pair = (max(a, b), min(a, b))
            elif counts[a] > 1:
                pair = (a, a)
            else:
                continue
            left = room - sum(pair)
            third = sizes[:int(np.searchsorted(sizes, left, "right"))]
            extra = next((int(c) for c in third[::-1] if counts[c] > pair.count(int(c))), 0)
            found.add(tuple(sorted((*pair, extra), reverse=True)) if extra else pair)
    # A single piece that leaves room for nothing else dominates what is less full.
    best = sorted(found, key=lambda f: (room - sum(f), len(f), [-x for x in f]))
    return best[:most]


def complete_bins(lengths: Sequence[int], capacity: int, node_budget: int = 5_000, breadth: int = 4,
                  close_budget: int | None = None) -> list[list[int]]:
    """Bins as lists of lengths, as few as the search finds; it ends at the lower bound. ``close_budget``, if given, takes
    ``node_budget``'s place where best-fit decreasing needs less than one bin in a hundred more than the lower bound."""
    incumbent, least = best_fit_decreasing(lengths, capacity), lower_bound(lengths, capacity)
    total = int(np.sum(lengths)) if len(lengths) else 0
    if len(incumbent) <= least:
        return incumbent
    if close_budget is not None and 100 * (len(incumbent) - least) < len(incumbent):
        node_budget = close_budget
    counts = np.bincount(np.asarray(lengths, dtype=np.int64), minlength=capacity + 1)
    # A stack entry: the filling put in at this depth, the alternatives left, the waste after it.
    path: list[list[int]] = []
    choices: list[list[tuple[int, ...]]] = []
    waste, nodes = [0], 0

    def options() -> list[tuple[int, ...]]:
        top = int(np.flatnonzero(counts)[-1])
        counts[top] -= 1
        found = [(top, *f) for f in fillings(counts, capacity - top, breadth)]
        counts[top] += 1
        return found[::-1]

    left = len(lengths)
    if left:
        choices.append(options())
    while choices and nodes < node_budget:
        if len(path) == len(choices):
            for size in path.pop():
                counts[size] += 1
                left += 1
            waste.pop()
        if not choices[-1]:
            choices.pop()
            continue
        filling = greedy_rest(list(choices[-1].pop()), counts, capacity)
        nodes += 1
        lost = waste[-1] + capacity - sum(filling)
        if lost > (len(incumbent) - 1) * capacity - total:
            continue
        for size in filling:
            counts[size] -= 1
            left -= 1
        path.append(filling)
        waste.append(lost)
        if left:
            choices.append(options())
        elif len(path) < len(incumbent):
            incumbent = [list(f) for f in path]
            if len(incumbent) <= least:
                break
            choices.append([])
        else:
            choices.append([])
    return incumbent


def greedy_rest(filling: list[int], counts: np.ndarray, capacity: int) -> list[int]:
    """``filling`` and, while pieces still fit, the largest of them."""
    room, taken = capacity - sum(filling), filling
    while room > 0:
        sizes = np.flatnonzero(counts[1:room + 1]) + 1
        fits = next((int(s) for s in sizes[::-1] if counts[s] > taken.count(int(s))), 0)
        if not fits:
            break
        taken = [*taken, fits]
        room -= fits
    return taken


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = 8192, node_budget: int = 5_000) -> DataFrame:
    """``pieces`` (with a column length, at most ``capacity``) with sequence_id and offset.

    Offsets are gapless from 0 within a sequence; sequence numbers are any numbers. Repeated rows are packed each.
    Empty tables give no rows.
    """
    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                        T.StructField("offset", T.LongType()), T.StructField("again", T.BooleanType())])
    columns = pieces.columns

    def packed(round_no: int, last: bool):
        def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.drop(columns="group").reset_index(drop=True)
            bins = complete_bins(rows["length"].tolist(), capacity, node_budget, close_budget=None if last else node_budget // 10)
            ordered = rows["length"].argsort(kind="stable")
            waiting: dict[int, list[int]] = {}
            for at, length in zip(ordered.tolist(), rows["length"].to_numpy()[ordered].tolist(), strict=True):
                waiting.setdefault(length, []).append(at)
            sequence, offset = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
            again = np.zeros(len(rows), bool)
            emptiest = min(range(len(bins)), key=lambda k: sum(bins[k]))
            for k, own in enumerate(bins):
                place, apart = 0, k == emptiest or capacity - sum(own) > capacity // 64
                for length in own:
                    at = waiting[length].pop()
                    sequence[at], offset[at], again[at] = (round_no << 56) | (int(key[0]) << 24) | k, place, apart
                    place += length
            return rows[columns].assign(sequence_id=sequence, offset=offset, again=again)
        return pack

    done, round_no, carried, carried_bins, last = [], 0, None, 0, False
    while True:
        groups = max(1, -(-pieces.count() // group_pieces))
        # Rows are dealt evenly, whatever their ids: copies of one row may be many.
        dealt = pieces.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(round_no)), F.lit(groups)))
        result = materialize(dealt.groupBy("group").applyInPandas(packed(round_no, last), out))
        bins = result.agg(F.count_if(F.col("offset") == 0).alias("all"), F.count_if((F.col("offset") == 0) & F.col("again")).alias("again")).first()
        saved = carried_bins - bins["all"] if carried is not None else bins["all"]
        if last or not bins["again"]:
            done.append(carried if carried is not None and saved <= 0 else result)
            break
        last = carried is not None and 100 * saved < carried_bins
        if saved > 0:
            done.append(result.filter(~F.col("again")))
            carried, carried_bins = result.filter("again"), bins["again"]
            pieces = carried.select(columns)
        round_no += 1
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    return rows.drop("again")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, **search) -> DataFrame:
    """The pieces of all documents with their place in a sequence; see :func:`token_pieces`, :func:`pack_pieces`."""
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_ids)
    return pack_pieces(materialize(pieces), capacity, **search)
