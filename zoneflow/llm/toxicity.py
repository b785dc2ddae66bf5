"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is a sequence of words. A word's input is its own embedding, where the vocabulary has it, beside the mean of the
embeddings of its character n-grams, so that words never seen still say something. Windows of ``window`` words, each half
overlapping the next, cover the whole text, however long; every window gets two gated recurrent passes, one from each end,
attention over their states and a probability. A text's score is calibrated from its highest window.

Training: labels belong to texts, not to windows. The first passes give windows at random their text's label; later ones take of
a positive text the windows that score highest, and of a negative text those and random others, so that a single
word in a long text can be learnt and a long clean text gets no high window by chance.

Bounds, all parameters: the network is fitted on at most ``sample_docs`` labelled texts of each label and ``sample_bytes``
of them, whole texts in the order of a hash of id and text. They meet in one task, which returns a vocabulary of ``words``
and ``grams`` entries and the parameters. Scoring is one pass over all texts, in tasks, without a shuffle; a long text
passes through the network in pieces that lose no window.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.common import in_small_batches
from zoneflow.session import materialize

GRAM_SIZES, TABLE_BITS, SEED, CHUNK, LONGEST_WORD = (3, 4, 5), 18, 23, 256_000, 256
#: Bytes of a word, from its first letter: digits, ASCII letters and all of other scripts.
FOLD = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], dtype=np.uint8)
IN_WORD = np.array([chr(i).isalnum() if i < 128 else True for i in range(256)])
BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Tokens:
    """Words of a run of texts: text number, first byte and hash of each, and (word number, hash) of their n-grams."""

    texts: int
    own: np.ndarray
    starts: np.ndarray
    words: np.ndarray
    gram_word: np.ndarray
    grams: np.ndarray


def encoded(text: str | None) -> bytes:
    """UTF-8 with one byte between words."""
    return BETWEEN.sub(b" ", (text or "").encode("utf-8", "surrogatepass"))


def tokenize(raw: list[bytes]) -> Tokens:
    """Words are runs of letters and digits, A-Z in lower case, cut every 256 bytes; n-grams of bytes lie within a word and
    the byte before it. ``starts`` count from the first text's first byte."""
    data = FOLD[np.frombuffer(b" " + b" ".join(raw) + b" " * 8, dtype=np.uint8)]
    inside = IN_WORD[data]
    begin = np.maximum.accumulate(np.where(inside, 0, np.arange(1, len(data) + 1)))
    inside &= (np.arange(len(data)) - begin) % LONGEST_WORD != LONGEST_WORD - 1
    data = np.where(inside, data, 32).astype(np.uint64)
    step = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
    # A word's hash is a sum over its bytes mixed with their places.
    place = np.arange(len(data)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    mixed = np.where(inside, spread(data + (place.astype(np.uint64) << np.uint64(8))), np.uint64(0))
    words = np.add.reduceat(mixed, starts) if len(starts) else np.empty(0, np.uint64)
    words = spread(words + (ends - starts).astype(np.uint64))
    offsets = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]]) + 1 if raw else np.empty(0, np.int64)
    own = np.searchsorted(offsets, starts, "right") - 1

    number = np.full(len(data), -1, dtype=np.int64)  # of the word that a byte, or the byte before it, belongs to
    lead = np.repeat(np.arange(len(starts)), ends - starts + 1)
    number[np.arange(len(lead)) - np.repeat(np.cumsum(ends - starts + 1) - (ends - starts + 1), ends - starts + 1) + np.repeat(starts - 1, ends - starts + 1)] = lead
    gram_word, grams = [], []
    for n in GRAM_SIZES:
        value = np.zeros(len(data) - n + 1, dtype=np.uint64)
        for i in range(n):
            value = (value << np.uint64(8)) | data[i:len(data) - n + 1 + i]
        first, last = number[:len(data) - n + 1], number[n - 1:]
        fits = (first == last) & (first >= 0)
        gram_word.append(first[fits])
        grams.append(spread(value[fits] * np.uint64(8) + np.uint64(n)))
    return Tokens(len(raw), own, starts - 1, words, np.concatenate(gram_word), np.concatenate(grams))


def chunks(raw: list[bytes]) -> Iterator[slice]:
    """Runs of texts of together at most ``CHUNK`` bytes; a longer text is a run of its own."""
    begin = size = 0
    for i, text in enumerate(raw):
        if size and size + len(text) > CHUNK:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(raw):
        yield slice(begin, len(raw))


class Vocabulary:
    """Number of a hash, 0 for those it does not have. A table by the hash's first bits finds it; of two hashes with equal
    first bits the one that comes first is in."""

    def __init__(self, hashes: np.ndarray):
        slots = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        _, first = np.unique(slots, return_index=True)
        self.hashes = hashes[np.sort(first)]
        self.table = np.zeros(1 << TABLE_BITS, dtype=np.int32)
        self.table[(self.hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = np.arange(1, len(self.hashes) + 1)
        self.own = np.concatenate([np.zeros(1, np.uint64), self.hashes])

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        found = self.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
        return np.where(self.own[found] == hashes, found, 0)

    @property
    def size(self) -> int:
        return len(self.hashes) + 1


class Chooser:
    """Counts in how many texts of each label a hash stands, and chooses those for a vocabulary."""

    def __init__(self):
        self.names, self.counts = np.empty(0, np.uint64), np.empty((0, 2), np.int64)

    def add(self, texts: np.ndarray, hashes: np.ndarray, labels: np.ndarray) -> None:
        order = np.lexsort((texts, hashes))
        hashes, texts = hashes[order], texts[order]
        new = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])])) if len(order) else order
        hashes, label = hashes[new], labels[texts[new]].astype(np.int64)
        counts = np.concatenate([self.counts, np.stack([1 - label, label], axis=1)])
        self.names, index = np.unique(np.concatenate([self.names, hashes]), return_inverse=True)
        self.counts = np.stack([np.bincount(index, counts[:, i], len(self.names)).astype(np.int64) for i in (0, 1)], axis=1)

    def vocabulary(self, labels: np.ndarray, size: int) -> Vocabulary:
        """Of hashes in at least two texts and a 400th of all: those that tell the labels apart best, and the commonest, by turns."""
        common = self.counts.sum(axis=1) >= max(2, len(labels) / 400)
        names, (zeros, ones) = self.names[common], self.counts[common].T
        share_one, share_zero = (ones + 0.5) / (labels.sum() + 1), (zeros + 0.5) / ((1 - labels).sum() + 1)
        gain = np.abs(share_one - share_zero) * np.abs(np.log(share_one / share_zero))
        ranked = np.stack([np.lexsort((names, -gain)), np.lexsort((names, -(ones + zeros)))], axis=1).ravel()
        _, first = np.unique(ranked, return_index=True)
        return Vocabulary(names[ranked[np.sort(first)][:size]])


@dataclass(frozen=True)
class Sizes:
    words: int = 4096
    grams: int = 4096
    word_dim: int = 12
    gram_dim: int = 12
    hidden: int = 12
    window: int = 32
    sample_docs: int = 2048
    sample_bytes: int = 3_000_000
    #: Passes over the windows, and updates at least: small samples get more passes, up to 60.
    rounds: int = 7
    updates: int = 500
    batch: int = 128
    rate: float = 0.01

    @property
    def stride(self) -> int:
        return self.window // 2


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def summed_by(at: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """The sums of ``rows`` by ``at``."""
    return np.stack([np.bincount(at, column, count) for column in rows.T], axis=1).astype(np.float32)


@dataclass
class Inputs:
    """Words of texts as numbers, and the n-grams of each: ``grams[edges[i]:edges[i + 1]]`` are those of word i."""

    own: np.ndarray
    words: np.ndarray
    grams: np.ndarray
    edges: np.ndarray


class Network:
    """Parameters and passes; arrays are (windows, words, features)."""

    def __init__(self, sizes: Sizes, words: Vocabulary, grams: Vocabulary):
        self.sizes, self.words, self.grams = sizes, words, grams
        draw, h, d = np.random.default_rng(SEED), sizes.hidden, sizes.word_dim + sizes.gram_dim

        def start(*shape: int) -> np.ndarray:
            return draw.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        self.p = {"word": draw.normal(0, 0.3, (words.size, sizes.word_dim)).astype(np.float32),
                  "gram": draw.normal(0, 0.3, (grams.size, sizes.gram_dim)).astype(np.float32),
                  "attend": start(2 * h), "out": start(2 * h), "bias": np.zeros(1, np.float32)}
        self.p["word"][0] = self.p["gram"][0] = 0
        for side in ("fore", "back"):
            self.p |= {f"{side}_in": start(d, 3 * h), f"{side}_gate": start(h, 2 * h), f"{side}_new": start(h, h),
                       f"{side}_bias": np.zeros(3 * h, np.float32)}
        self.slope, self.offset = 1.0, 0.0

    def state(self) -> bytes:
        return pickle.dumps((self.words.hashes, self.grams.hashes, self.p, self.slope, self.offset))

    @classmethod
    def of_state(cls, sizes: Sizes, state: bytes) -> Network:
        words, grams, parameters, slope, offset = pickle.loads(state)
        found = cls(sizes, Vocabulary(words), Vocabulary(grams))
        found.p, found.slope, found.offset = parameters, slope, offset
        return found

    def inputs(self, tokens: Tokens) -> Inputs:
        grams = self.grams.numbers(tokens.grams)
        word = tokens.gram_word[grams > 0]
        order = np.argsort(word, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(tokens.words)))])
        return Inputs(tokens.own, self.words.numbers(tokens.words), grams[grams > 0][order].astype(np.int32), edges)

    def embedded(self, x: Inputs) -> np.ndarray:
        """One row per word, and a row of zeros at the end for places beyond a text."""
        count, edges = np.diff(x.edges), x.edges
        sums = np.zeros((len(x.words) + 1, self.sizes.gram_dim), dtype=np.float32)
        some = np.flatnonzero(count)
        if len(some):
            sums[some] = np.add.reduceat(self.p["gram"][x.grams], edges[some], axis=0) / np.sqrt(count[some])[:, None]
        own = np.concatenate([self.p["word"][x.words], np.zeros((1, self.sizes.word_dim), np.float32)])
        return np.concatenate([own, sums], axis=1)

    def windows(self, own: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """(text of each window, word numbers by window and place; the number of words stands for none)."""
        width, stride = self.sizes.window, self.sizes.stride
        counts = np.bincount(own, minlength=texts)
        first = np.cumsum(counts) - counts
        per = np.maximum(1, -(-(counts - width) // stride) + 1)
        text = np.repeat(np.arange(texts), per)
        begin = (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * stride
        places = begin[:, None] + np.arange(width)
        return text, np.where(places < counts[text][:, None], first[text][:, None] + places, len(own))

    def run(self, steps: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States by window and place. ``steps`` (windows, words, 3 * hidden) holds the inputs' part."""
        h, p = self.sizes.hidden, self.p
        gate_w, new_w = p[f"{side}_gate"], p[f"{side}_new"]
        state = np.zeros((len(steps), h), dtype=np.float32)
        states = np.empty((*steps.shape[:2], h), dtype=np.float32)
        order = range(steps.shape[1]) if side == "fore" else range(steps.shape[1] - 1, -1, -1)
        for t in order:
            x = steps[:, t]
            gates = x[:, :2 * h] + state @ gate_w
            np.clip(gates, -30, 30, out=gates)
            gates = 1 / (1 + np.exp(-gates))
            update, reset = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h:] + (reset * state) @ new_w)
            if keep is not None:
                keep.append((t, state, update, reset, new))
            state = state + update * (new - state)
            states[:, t] = state
        return states

    def forward(self, rows: np.ndarray, places: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logit of every window. ``rows`` are :meth:`embedded`."""
        p, none = self.p, len(rows) - 1
        sides = []
        for side in ("fore", "back"):
            projected = rows @ p[f"{side}_in"] + p[f"{side}_bias"]
            keep = [] if trace is not None else None
            sides.append(self.run(projected[places], side, keep))
            if trace is not None:
                trace[side] = keep
        states = np.concatenate(sides, axis=2)
        seen = places < none
        attention = np.where(seen, states @ p["attend"], np.float32(-1e9))
        attention = np.exp(attention - attention.max(axis=1, keepdims=True)) * seen
        attention /= np.maximum(attention.sum(axis=1, keepdims=True), np.float32(1e-9))
        pooled = np.einsum("bt,bth->bh", attention, states)
        if trace is not None:
            trace |= {"states": states, "attention": attention, "pooled": pooled, "seen": seen}
        return pooled @ p["out"] + p["bias"][0]

    def gradients(self, x: Inputs, rows: np.ndarray, places: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted logistic loss."""
        p, s, h = self.p, self.sizes, self.sizes.hidden
        trace: dict = {}
        logit = self.forward(rows, places, trace)
        up = ((sigmoid(logit) - labels) * weights / weights.sum()).astype(np.float32)
        states, attention = trace["states"], trace["attention"]
        g = {"bias": np.array([up.sum()]), "out": trace["pooled"].T @ up}
        to_pooled = up[:, None] * p["out"]
        to_attention = np.einsum("bh,bth->bt", to_pooled, states)
        to_score = attention * (to_attention - (attention * to_attention).sum(axis=1, keepdims=True))
        g["attend"] = np.einsum("bt,bth->h", to_score, states)
        to_states = attention[:, :, None] * to_pooled[:, None, :] + to_score[:, :, None] * p["attend"]
        to_rows = np.zeros_like(rows)
        for side, at in (("fore", slice(0, h)), ("back", slice(h, 2 * h))):
            gate_w, new_w, in_w = p[f"{side}_gate"], p[f"{side}_new"], p[f"{side}_in"]
            to_steps = np.empty((*places.shape, 3 * h), dtype=np.float32)
            to_gate, to_new_w = np.zeros_like(gate_w), np.zeros_like(new_w)
            carry = np.zeros((len(places), h), dtype=np.float32)
            for t, before, update, reset, new in reversed(trace[side]):
                carry = carry + to_states[:, t, at]
                to_new = carry * update * (1 - new * new)
                to_reset_state = to_new @ new_w.T
                gates = np.concatenate([carry * (new - before) * update * (1 - update), to_reset_state * before * reset * (1 - reset)], axis=1)
                to_gate += before.T @ gates
                to_new_w += (reset * before).T @ to_new
                to_steps[:, t, :2 * h], to_steps[:, t, 2 * h:] = gates, to_new
                carry = carry * (1 - update) + to_reset_state * reset + gates @ gate_w.T
            flat = to_steps.reshape(-1, 3 * h)
            g |= {f"{side}_gate": to_gate, f"{side}_new": to_new_w, f"{side}_bias": flat.sum(axis=0)}
            summed = summed_by(places.ravel(), flat, len(rows))
            g[f"{side}_in"] = rows.T @ summed
            to_rows += summed @ in_w.T
        to_rows[-1] = 0
        used = np.unique(places)
        used = used[used < len(rows) - 1]
        g["word"] = summed_by(x.words[used], to_rows[used, :s.word_dim], len(p["word"]))
        count = np.diff(x.edges)
        share = to_rows[used, s.word_dim:] / np.sqrt(np.maximum(count[used], 1))[:, None]
        at = np.repeat(x.edges[used], count[used]) + np.arange(count[used].sum()) - np.repeat(np.cumsum(count[used]) - count[used], count[used])
        g["gram"] = summed_by(x.grams[at], np.repeat(share, count[used], axis=0), len(p["gram"]))
        g["word"][0] = g["gram"][0] = 0
        return g

    def window_logits(self, x: Inputs, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, logit) of every window of the texts."""
        text, places = self.windows(x.own, texts)
        logits = np.empty(len(text), dtype=np.float32)
        if len(x.own) <= CHUNK:
            rows = self.embedded(x)
            for begin in range(0, len(text), 1024):
                logits[begin:begin + 1024] = self.forward(rows, places[begin:begin + 1024])
            return text, logits
        for begin in range(0, len(text), 1024):
            part, index = self.part(x, places[begin:begin + 1024])
            logits[begin:begin + 1024] = self.forward(self.embedded(part), index)
        return text, logits

    @staticmethod
    def part(x: Inputs, places: np.ndarray) -> tuple[Inputs, np.ndarray]:
        """The words that ``places`` name, and their numbers among these."""
        here, index = np.unique(places, return_inverse=True)
        index, here = index.reshape(places.shape), here[here < len(x.own)]
        count = np.diff(x.edges)[here]
        grams = np.repeat(x.edges[here], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return Inputs(x.own[here], x.words[here], x.grams[grams], np.concatenate([[0], np.cumsum(count)])), index

    def highest(self, texts: list[str | None]) -> np.ndarray:
        """The highest window's logit of every text."""
        raw = [encoded(t) for t in texts]
        found = np.full(len(texts), -np.inf)
        for run in chunks(raw):
            if len(raw[run.start]) > CHUNK:
                found[run.start] = self.highest_of_long(raw[run.start])
                continue
            text, logits = self.window_logits(self.inputs(tokenize(raw[run])), run.stop - run.start)
            np.maximum.at(found[run], text, logits)
        return found

    def highest_of_long(self, raw: bytes) -> float:
        """Piece by piece: the next piece starts with the first window that the last one does not hold whole."""
        begin, best, width, stride = 0, -np.inf, self.sizes.window, self.sizes.stride
        while True:
            piece = raw[begin:begin + CHUNK]
            last = begin + CHUNK >= len(raw)
            tokens = tokenize([piece])
            x = self.inputs(tokens)
            if last:
                return max(best, float(self.window_logits(x, 1)[1].max()))
            whole = (len(x.words) - 1 - width) // stride + 1  # without the last word, which may be cut
            words = (whole - 1) * stride + width
            cut = Inputs(x.own[:words], x.words[:words], x.grams[:x.edges[words]], x.edges[:words + 1])
            best = max(best, float(self.window_logits(cut, 1)[1].max()))
            begin += int(tokens.starts[whole * stride])

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return sigmoid(self.slope * self.highest(texts) + self.offset)


class Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, parameters: dict[str, np.ndarray], gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        for name, g in gradients.items():
            g = g.astype(np.float32)
            m = self.m[name] = 0.9 * self.m.get(name, 0) + np.float32(0.1) * g
            v = self.v[name] = 0.999 * self.v.get(name, 0) + np.float32(0.001) * g * g
            scale = np.float32(self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t))
            parameters[name] -= scale * m / (np.sqrt(v) + np.float32(1e-7))


def cut(raw: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """(text number, piece) of texts cut between words into pieces of at most ``CHUNK`` bytes, or of one long word."""
    number, pieces = [], []
    for i, text in enumerate(raw):
        begin = 0
        while True:
            end = len(text)
            if end - begin > CHUNK:
                end = text.rfind(b" ", begin, begin + CHUNK)
                end = text.find(b" ", begin + CHUNK) if end <= begin else end
                end = len(text) if end < 0 else end
            number.append(i)
            pieces.append(text[begin:end])
            begin = end
            if end == len(text):
                break
    return np.array(number, dtype=np.int64), pieces


def joined(parts: list[Inputs]) -> Inputs:
    edges = np.concatenate([[0], *(np.diff(p.edges) for p in parts)])
    return Inputs(*(np.concatenate([getattr(p, name) for p in parts] or [np.empty(0, np.int64)]) for name in ("own", "words", "grams")),
                  np.cumsum(edges))


def fit(texts: list[str], labels: np.ndarray, sizes: Sizes = Sizes()) -> Network:
    """A network of labelled texts. Without both labels among them it scores every text with the share of label 1."""
    raw, labels = [encoded(t) for t in texts], labels.astype(np.float64)
    number, pieces = cut(raw)
    words, grams = Chooser(), Chooser()
    for run in chunks(pieces):
        tokens = tokenize(pieces[run])
        words.add(tokens.own, tokens.words, labels[number[run]])
        grams.add(tokens.own[tokens.gram_word], tokens.grams, labels[number[run]])
    network = Network(sizes, words.vocabulary(labels, sizes.words), grams.vocabulary(labels, sizes.grams))
    if not len(texts) or labels.min() == labels.max():
        share = labels.mean() if len(labels) else 0.0
        network.slope, network.offset = 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return network
    parts = []
    for run in chunks(pieces):
        parts.append(network.inputs(tokenize(pieces[run])))
        parts[-1].own = number[run][parts[-1].own]
    x = joined(parts)
    text, places = network.windows(x.own, len(texts))
    draw, adam = np.random.default_rng(SEED), Adam(sizes.rate)
    label = labels[text]
    rounds = max(sizes.rounds, min(60, -(-4 * sizes.batch * sizes.updates // len(text))))
    for turn in range(rounds):
        chosen = np.flatnonzero(draw.random(len(text)) < 0.4) if turn < 2 else promising(text, label, network.window_logits(x, len(texts))[1], draw)
        chosen = draw.permutation(chosen)
        ones = label[chosen].mean()
        weight = np.where(label == 1, 0.5 / max(ones, 1e-9), 0.5 / max(1 - ones, 1e-9))
        adam.rate = sizes.rate * (1 - turn / rounds)
        for begin in range(0, len(chosen), sizes.batch):
            at = chosen[begin:begin + sizes.batch]
            part, index = network.part(x, places[at])
            # A tenth of the words counts as unknown, so that n-grams learn too.
            part.words = np.where(draw.random(len(part.words)) < 0.1, 0, part.words)
            adam.step(network.p, network.gradients(part, network.embedded(part), index, label[at], weight[at]))
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, text, network.window_logits(x, len(texts))[1])
    calibrate(network, best, labels)
    return network


def promising(text: np.ndarray, label: np.ndarray, logits: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Windows to learn from: of a positive text the highest eighth, of a negative one the two highest and a tenth at random."""
    order = np.lexsort((-logits, text))
    per = np.bincount(text)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order)) - np.repeat(np.cumsum(per) - per, per)
    top = np.where(label == 1, place < np.maximum(1, per[text] // 8), place < 2)
    return np.flatnonzero(top | ((label == 0) & (draw.random(len(text)) < 0.1)))


def calibrate(network: Network, logits: np.ndarray, labels: np.ndarray) -> None:
    """Slope and offset that make the texts' highest logits probabilities, by Newton steps with a little shrinkage."""
    scale = max(float(logits.std()), 1e-6)
    x = np.stack([logits / scale, np.ones(len(logits))], axis=1)
    w, weight = np.zeros(2), np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels).mean())
    for _ in range(50):
        q = sigmoid(x @ w)
        g = x.T @ (weight * (q - labels)) + 1e-2 * len(labels) * np.array([w[0], 0]) * 0.01
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + np.diag([1e-4 * len(labels), 1e-6 * len(labels)])
        w = w - np.linalg.solve(hessian, g)
        if np.abs(np.linalg.solve(hessian, g)).max() < 1e-8:
            break
    network.slope, network.offset = float(w[0] / scale), float(w[1])


def learn(docs: DataFrame, labels: DataFrame, sizes: Sizes = Sizes(), id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Network:
    """A network of the documents that ``labels`` (id_col, label_col) labels with 0 or 1. Labels of other values, and texts
    that are NULL or empty, teach nothing; an id labelled both ways counts as both."""
    marks = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
    # Twice as many ids as texts are wanted, as some have no text.
    by_hash = [F.xxhash64("_id"), F.col("_id")]
    ids = [marks.filter(F.col("label") == label).distinct().orderBy(*by_hash).limit(2 * sizes.sample_docs) for label in (0, 1)]
    found = docs.filter(F.length(text_col) > 0).select(F.col(id_col).alias("_id"), F.col(text_col).alias("body")).join(
        F.broadcast(ids[0].unionAll(ids[1])), "_id")
    # An id may stand on many rows; equal rows count once.
    sample = materialize(found.select("label", F.xxhash64("_id", "body").alias("h"), F.octet_length("body").alias("size"), "body"))
    chosen = None
    first_to_here = Window.orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    for label in (0, 1):  # at most sample_docs rows without their texts in one task
        index = sample.filter(F.col("label") == label).select("label", "h", "size").distinct().orderBy("h").limit(sizes.sample_docs)
        fits = (F.sum("size").over(first_to_here) <= sizes.sample_bytes) | (F.row_number().over(Window.orderBy("h")) == 1)
        own = index.withColumn("fits", fits).filter("fits").select("label", "h")
        chosen = own if chosen is None else chosen.unionAll(own)
    texts = sample.join(F.broadcast(chosen), ["label", "h"]).dropDuplicates(["label", "h"]).select("label", "h", "body")
    state = texts.repartition(1).sortWithinPartitions("h", "label").mapInArrow(trainer(sizes), "state binary").first()
    return Network.of_state(sizes, state["state"]) if state else fit([], np.empty(0), sizes)


def trainer(sizes: Sizes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            texts += batch.column(2).to_pylist()
        if texts:
            state = fit(texts, np.array(labels, dtype=np.float64), sizes).state()
            yield pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], names=["state"])
    return run


def scorer(network: Network, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = network.probabilities(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=names)
    return run


def score(docs: DataFrame, network: Network, text_col: str = "text", keep: tuple[Column | str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: what ``keep`` names, score (0 to 1) and predicted (1 from 0.5 on).

    NULL texts are empty; an empty text is one window without words and has that window's score. Rows that repeat are scored
    each, empty tables give no rows, and columns not kept are ignored.
    """
    rows = in_small_batches(docs.select(F.col(text_col).alias("_body"), *keep))
    schema = T.StructType([*rows.schema.fields[1:], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(scorer(network, schema.names), schema)
