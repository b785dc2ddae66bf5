"""64-bit hashes of all words of many texts by whole-array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES, PIECE_BYTES = 2_000_000, 262_144
SEPARATORS = [bytes([b]) for b in (0x20, *range(0x09, 0x0E))]
FOLD = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
RADIX = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; NULL texts are empty.

    A word's hash is the difference of two running sums of ``byte * radix ** place``, divided by the power where
    the word starts (the radix is odd, so it has an inverse), and mixed.
    """

    def __init__(self):
        self.grow(1 << 16)

    def grow(self, size: int) -> None:
        """Powers of the radix and of its inverse, for buffers of ``size`` bytes."""
        def powers(base: int) -> np.ndarray:
            return np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base, dtype=np.uint64)]), dtype=np.uint64)
        self.up, self.down = powers(RADIX), powers(pow(RADIX, -1, 2 ** 64))

    def word_hashes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, hash, last two bytes as a number) of every word in order.

        Works on pieces of some ``PIECE_BYTES``, cut between words, as the buffers take many times a piece's size."""
        found, own, size, parts = [], [], 0, []
        for number, text in enumerate(texts):
            for part in pieces((text or "").encode("utf-8", "surrogatepass").translate(FOLD)):
                if parts and size + len(part) > PIECE_BYTES:
                    found.append(self._hashes(own, parts))
                    own, size, parts = [], 0, []
                own.append(number)
                parts.append(part)
                size += len(part) + 1
        found.append(self._hashes(own, parts))
        return tuple(np.concatenate([f[i] for f in found]) for i in range(3))

    def _hashes(self, numbers: list[int], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
        if len(data) >= len(self.up):
            self.grow(max(len(data), 2 * len(self.up)))
        space = IS_SPACE[data]
        word = ~space
        starts = np.flatnonzero(word & np.concatenate([[True], space[:-1]]))
        ends = np.flatnonzero(space & np.concatenate([[False], word[:-1]]))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=sums[1:])
        hashes = mixed((sums[ends] - sums[starts]) * self.down[starts] ^ (ends - starts).astype(np.uint64))
        lasts = data[ends - 1].astype(np.int64) * 256 + np.where(ends - starts > 1, data[ends - 2], 0)
        lengths = np.array([len(t) + 1 for t in raw], dtype=np.int64)
        number = np.array(numbers, dtype=np.int64)[np.searchsorted(np.cumsum(lengths), starts, "right")] if len(starts) else np.empty(0, np.int64)
        return number, hashes, lasts


def pieces(raw: bytes) -> Iterator[bytes]:
    """A text cut between words; a longer word stays whole."""
    begin = 0
    while len(raw) - begin > PIECE_BYTES:
        end = max(raw.rfind(s, begin, begin + PIECE_BYTES) for s in SEPARATORS)
        if end <= begin:
            following = [at for s in SEPARATORS if (at := raw.find(s, begin + PIECE_BYTES)) >= 0]
            end = min(following, default=len(raw))
        yield raw[begin:end]
        begin = end
    yield raw[begin:]


def chunks(texts: list[str | None]) -> Iterator[slice]:
    """Runs of texts of some megabytes; a longer text is a run of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > CHUNK_BYTES:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text or "") + 1
    if begin < len(texts):
        yield slice(begin, len(texts))
