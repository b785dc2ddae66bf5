"""Scoring texts with a log-bilinear language model.

Words are counted over all training texts. The model predicts the class of the next token from the classes of the two
before it: the commonest words are classes of their own, other words share one with those that end in the same two
bytes, by hash. A context's vector is the sum of two embeddings, one by position; its product with a class's vector and a
bias give the score. The model is trained in numpy with noise-contrastive estimation: every task makes its own passes over
its texts from the same start, and the parameters are averaged by tokens. Scoring normalises over all classes, by one matrix
product over a batch's distinct contexts. A word within a shared class has its share of the class's counts, with one
more for a word never seen.

Words are 64-bit hashes. Counts are combined by batch, task and key, and stay distributed: only the commonest words (at most
``FREQUENT`` of them, as each has more than that share of all tokens) go to the tasks; other words join them by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.word_hash import WordHasher, chunks, mixed
from zoneflow.session import materialize

FREQUENT, TOP, ENDINGS, DIM, NOISE, BATCH, EPOCHS, RATE, SEED = 20_000, 255, 192, 16, 64, 1024, 2, 0.3, 17
#: The end of a text as a token, told apart from all words' hashes by its class.
END_HASH = 0


@dataclass(frozen=True)
class Classes:
    """Token classes: 0 .. ENDINGS - 1 by ending, then the end of a text, then the commonest words."""

    top: np.ndarray

    @property
    def end(self) -> int:
        return ENDINGS

    @property
    def count(self) -> int:
        return ENDINGS + 1 + len(self.top)

    def of(self, hashes: np.ndarray, lasts: np.ndarray) -> np.ndarray:
        found = ending_class(lasts)
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, hashes), len(self.top) - 1)
            found = np.where(self.top[at] == hashes, ENDINGS + 1 + at, found)
        return found

    def sequence(self, own: np.ndarray, hashes: np.ndarray, lasts: np.ndarray, texts: int) -> tuple[np.ndarray, ...]:
        """(text number, class, the class before, the one before that) of all tokens of ``texts`` texts, ends included."""
        counts = np.bincount(own, minlength=texts)
        stops = np.cumsum(counts + 1) - 1
        classes = np.full(len(own) + texts, self.end)
        place = np.ones(len(classes), dtype=bool)
        place[stops] = False
        classes[place] = self.of(hashes, lasts)
        number = np.repeat(np.arange(texts), counts + 1)
        first = np.concatenate([[0], stops[:-1] + 1]) if texts else stops
        one = np.concatenate([[self.end], classes[:-1]])
        two = np.concatenate([[self.end, self.end], classes[:-2]])[:len(classes)]
        two[np.minimum(first + 1, len(classes) - 1)[counts > 0]] = self.end
        one[first] = two[first] = self.end
        return number, classes, one, two


def ending_class(lasts: np.ndarray) -> np.ndarray:
    return (mixed(lasts.astype(np.uint64)) % np.uint64(ENDINGS)).astype(np.int64)


@dataclass
class LogBilinear:
    """One embedding a class and position before, one vector a class, one bias a class."""

    near: np.ndarray
    far: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, shares: np.ndarray) -> LogBilinear:
        draw = np.random.default_rng(SEED)
        n = len(shares)
        return cls(*(draw.normal(0, 0.1, (n, DIM)).astype(np.float32) for _ in range(3)), np.log(shares).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.near.ravel(), self.far.ravel(), self.out.ravel(), self.bias])

    @classmethod
    def of_flat(cls, flat: np.ndarray, n: int) -> LogBilinear:
        near, far, out = flat[:3 * n * DIM].reshape(3, n, DIM)
        return cls(near.copy(), far.copy(), out.copy(), flat[3 * n * DIM:].copy())

    def log10_probabilities(self, classes: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Normalised over all classes; every distinct context is computed once."""
        n = len(self.bias)
        contexts, which = np.unique(one * n + two, return_inverse=True)
        found = np.empty(len(classes))
        order = np.argsort(which, kind="stable")
        for begin in range(0, len(contexts), 8192):
            part = contexts[begin:begin + 8192]
            scores = (self.near[part // n] + self.far[part % n]).astype(np.float32) @ self.out.T.astype(np.float32)
            scores += self.bias.astype(np.float32)
            top = scores.max(axis=1)
            norm = np.log(np.exp(scores - top[:, None]).sum(axis=1)) + top
            i, j = np.searchsorted(which[order], [begin, begin + len(part)])
            rows = order[i:j]
            found[rows] = scores[which[rows] - begin, classes[rows]] - norm[which[rows] - begin]
        return found / np.log(10)


class NoiseContrast:
    """Training by noise-contrastive estimation with Adagrad; a batch's tokens share their noise."""

    def __init__(self, model: LogBilinear, shares: np.ndarray, seed: int):
        self.model, self.log_shares = model, (np.log(shares) + np.log(NOISE)).astype(np.float32)
        self.edges = np.cumsum(shares)
        self.draw = np.random.default_rng([SEED, seed])
        self.squares = LogBilinear(*(np.full_like(p, 1e-2) for p in (model.near, model.far, model.out, model.bias)))
        self.tokens = 0

    def learn(self, classes: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        self.tokens += len(classes)
        for _ in range(EPOCHS):
            order = self.draw.permutation(len(classes))
            for begin in range(0, len(order), BATCH):
                at = order[begin:begin + BATCH]
                self.step(classes[at], one[at], two[at])

    def step(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        m, n = self.model, len(self.model.bias)
        noise = np.minimum(np.searchsorted(self.edges, self.draw.random(NOISE)), n - 1)
        context = m.near[one] + m.far[two]
        real = np.einsum("ij,ij->i", context, m.out[word]) + m.bias[word] - self.log_shares[word]
        false = context @ m.out[noise].T + m.bias[noise] - self.log_shares[noise]
        up = -1 / (1 + np.exp(np.clip(real, -30, 30)))
        down = 1 / (1 + np.exp(np.clip(-false, -30, 30)))
        to_context = up[:, None] * m.out[word] + down @ m.out[noise]
        to_out = scattered(word, up[:, None] * context, n)
        np.add.at(to_out, noise, down.T @ context)
        to_bias = np.bincount(word, up, n) + np.bincount(noise, down.sum(axis=0), n)
        scale = np.float32(1 / len(word))
        for value, square, gradient in ((m.near, self.squares.near, scattered(one, to_context, n)),
                                        (m.far, self.squares.far, scattered(two, to_context, n)),
                                        (m.out, self.squares.out, to_out), (m.bias, self.squares.bias, to_bias)):
            gradient = (gradient * scale).astype(np.float32)
            square += gradient * gradient
            value -= RATE * gradient / np.sqrt(square)


def scattered(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sums of ``rows`` by ``at``."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    sums = np.zeros((n, rows.shape[1]), dtype=rows.dtype)
    sums[at[begin]] = np.add.reduceat(rows[order], begin)
    return sums


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, ending, n) of a run of texts."""
    hasher = WordHasher()
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for part in chunks(texts):
            _, hashes, lasts = hasher.word_hashes(texts[part])
            found, first, counts = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(ending_class(lasts[first]).astype(np.int32)), pa.array(counts)],
                names=["h", "ending", "n"])


def trainer(classes: Classes, shares: np.ndarray):
    """(at, tokens, sum): each task's parameters, times its tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, training = WordHasher(), NoiseContrast(LogBilinear.start(shares), shares, 0)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in chunks(texts):
                own = texts[part]
                _, word, one, two = classes.sequence(*hasher.word_hashes(own), len(own))
                training.learn(word, one, two)
        flat = training.model.flat()
        if training.tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(np.full(len(flat), training.tokens)),
                 pa.array(flat.astype(np.float64) * training.tokens)], names=["at", "tokens", "total"])
    return run


@dataclass(frozen=True)
class LanguageModel:
    classes: Classes
    net: LogBilinear
    #: (h, ending, n) of all training words.
    counts: DataFrame
    #: All training tokens and how many are distinct, ends included.
    tokens: int
    vocabulary: int
    ends: int
    #: log10 of what a shared class's words share: its counts, its words and one more.
    ending_totals: np.ndarray
    frequent: np.ndarray
    frequent_counts: np.ndarray


def train(texts: DataFrame, text_col: str = "text") -> LanguageModel:
    """A model of all rows of ``texts``. NULL texts are empty: an end only. Without rows every count is 0."""
    body = texts.select(F.col(text_col).alias("body"))
    ends = body.count()
    counts = materialize(body.mapInArrow(count_words, "h long, ending int, n long")
                         .groupBy("h", "ending").agg(F.sum("n").alias("n")))
    facts = counts.agg(F.sum("n").alias("n"), F.count("*").alias("words")).first()
    tokens, vocabulary = (facts["n"] or 0) + ends, facts["words"] + (ends > 0)
    top_rows = counts.orderBy(F.desc("n"), "h").limit(TOP).collect()
    common = counts.filter(F.col("n") * FREQUENT > tokens).select("h", "n").collect()
    top = np.sort(np.array([r["h"] for r in top_rows], dtype=np.int64).view(np.uint64))
    classes = Classes(top)

    is_top = F.col("h").isin([int(h) for h in top.view(np.int64)]) if len(top) else F.lit(False)
    shared = {r["ending"]: (r["n"], r["words"]) for r in counts.filter(~is_top).groupBy("ending").agg(
        F.sum("n").alias("n"), F.count("*").alias("words")).collect()}
    by_ending = np.array([shared.get(e, (0, 0)) for e in range(ENDINGS)], dtype=np.float64)
    top_counts = {np.int64(r["h"]).view(np.uint64): r["n"] for r in top_rows}
    sizes = np.concatenate([by_ending[:, 0], [ends], [top_counts[h] for h in top]])
    shares = (sizes + 1) / (sizes + 1).sum()

    sums = body.mapInArrow(trainer(classes, shares), "at int, tokens long, total double").groupBy("at").agg(
        (F.sum("total") / F.sum("tokens")).alias("value")).collect()  # as many rows as parameters
    net = LogBilinear.start(shares)
    if sums:
        flat = np.empty(len(sums))
        flat[[r["at"] for r in sums]] = [r["value"] for r in sums]
        net = LogBilinear.of_flat(flat, classes.count)
    order = np.argsort(np.array([r["h"] for r in common], dtype=np.int64).view(np.uint64))
    return LanguageModel(
        classes, net, counts, tokens, vocabulary, ends, np.log10(by_ending.sum(axis=1) + 1),
        np.array([r["h"] for r in common], dtype=np.int64).view(np.uint64)[order],
        np.array([r["n"] for r in common], dtype=np.int64)[order])


def scorer(model: LanguageModel, names: list[str]):
    """Per text a row with its sums over classes and frequent words and what it carries, and a row (row, h, n) for each of
    its other distinct words."""
    classes, net, ending_totals = model.classes, model.net, model.ending_totals
    frequent, frequent_counts, ends = model.frequent, model.frequent_counts, model.ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            row, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for part in chunks(texts):
                own, hashes, lasts = hasher.word_hashes(texts[part])
                count, ids = part.stop - part.start, row[part]
                number, cls, one, two = classes.sequence(own, hashes, lasts, count)
                model_sum = np.bincount(number, net.log10_probabilities(cls, one, two), count)
                # Words of shared classes: their share of the class. Its upper part is the word's count, added later.
                model_sum -= np.bincount(number, np.where(cls < ENDINGS, ending_totals[np.minimum(cls, ENDINGS - 1)], 0.0), count)
                n_tokens = np.bincount(number, minlength=count)
                at = np.minimum(np.searchsorted(frequent, hashes), max(0, len(frequent) - 1))
                known = frequent[at] == hashes if len(frequent) else np.zeros(len(hashes), dtype=bool)
                logs = np.log10(frequent_counts[at[known]] + 1.0) if len(frequent) else np.empty(0)
                base_sum = np.bincount(own[known], logs, count) + np.log10(ends + 1.0)
                single = classes.of(hashes, lasts)[known] <= ENDINGS
                model_sum += np.bincount(own[known][single], logs[single], count)
                n_known = np.bincount(own[known], minlength=count) + (ends > 0)
                rare_own, rare = own[~known], hashes[~known]
                order = np.lexsort((rare, rare_own))
                rare_own, rare = rare_own[order], rare[order]
                new = np.flatnonzero(np.concatenate([[True], (rare_own[1:] != rare_own[:-1]) | (rare[1:] != rare[:-1])])) \
                    if len(rare) else np.empty(0, np.int64)
                times = np.diff(np.concatenate([new, [len(rare)]]))
                rare_own, rare = rare_own[new], rare[new]
                # A text's sums stand on a row of their own, whose hash spreads these rows.
                spread = mixed(ids.astype(np.uint64))
                zeros = np.zeros(len(rare))
                first = pa.array(np.concatenate([np.arange(part.start, part.stop), zeros]), pa.int64(), mask=np.arange(count + len(rare)) >= count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids, ids[rare_own]])),
                     pa.array(np.concatenate([spread, rare]).view(np.int64)),
                     pa.array(np.concatenate([np.zeros(count, np.int64), times])),
                     *(pa.array(np.concatenate([x, zeros.astype(x.dtype)])) for x in
                       (n_tokens.astype(np.int64), n_known.astype(np.int64), base_sum, model_sum)),
                     *(column.take(first) for column in batch.columns[2:])], names=names)
    return run


def score(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[Column, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: id_col, what ``keep`` names, n_tokens, n_known, base_score, score.

    Both scores are log10 probabilities of the whole text with its end: by counts alone, and by the model. NULL
    texts are empty and consist of their end. Rows that repeat are scored each; empty tables give no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("body"), F.col(id_col), *keep)
    carried = rows.columns[2:]
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("row", "h", "n", "n_tokens", "n_known")),
                           *(T.StructField(c, T.DoubleType()) for c in ("base_sum", "model_sum")),
                           *(T.StructField(c, rows.schema[c].dataType) for c in carried)])
    found = rows.mapInArrow(scorer(model, schema.names), schema)
    counts = model.counts.select("h", F.col("n").alias("c")).hint("shuffle_hash")
    words = found.join(counts, "h", "left")
    logs = F.coalesce(F.col("n") * F.log10(F.col("c") + 1.0), F.lit(0.0))
    seen = F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)
    sums = words.groupBy("row").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_known") + seen).alias("n_known"),
        F.sum(F.col("base_sum") + logs).alias("base_sum"), F.sum(F.col("model_sum") + logs).alias("model_sum"),
        *[F.max(c).alias(c) for c in carried])  # one row of a text has them
    every = F.log10(F.lit(float(model.tokens + model.vocabulary + 1)))
    return sums.select(
        *carried, "n_tokens", "n_known",
        (F.col("base_sum") - F.col("n_tokens") * every).alias("base_score"), F.col("model_sum").alias("score"))
