"""Sets of word shingles as sorted 64-bit hashes, for whole Arrow batches at a time.

Words are runs of characters other than space and the controls from tab to carriage
return; A-Z count as a-z. A word's hash is a polynomial over random numbers for its
bytes, a shingle's hash a mixed sum of its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at a time; a longer text is handled alone.
SLICE = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


class Shingler:
    def __init__(self, words: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = lambda n: rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1)
        self.words = words
        values = draw(256)
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
        values[[0x20, *range(0x09, 0x0E)]] = 0  # all others are odd
        self.values, self.base, self.places = values, draw(1)[0], draw(words)
        self.powers = self._powers(64)

    def _powers(self, n: int) -> np.ndarray:
        out = np.full(n, self.base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def sets(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, offsets, hashes): row i has the sorted hashes[offsets[i] : offsets[i + 1]]."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, "right")) - 1)
            yield at, *self._slice(data[ends[at] : ends[stop]], ends[at : stop + 1] - ends[at])
            at = stop

    def _slice(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(ends) - 1
        value = self.values[data]
        word = value != 0
        first = word.copy()
        first[1:] &= ~word[:-1]
        cut = ends[1:-1][ends[1:-1] < len(data)]
        first[cut] = word[cut]
        letters = np.flatnonzero(word)
        starts = np.flatnonzero(first[letters])
        lengths = np.diff(np.r_[starts, len(letters)])
        if len(lengths) and lengths.max() > len(self.powers):
            self.powers = self._powers(int(lengths.max()))
        place = np.arange(len(letters)) - np.repeat(starts, lengths)
        terms = value[letters] * self.powers[place]
        hashes = np.add.reduceat(terms, starts) if len(starts) else terms[:0]
        hashes = mix(hashes + lengths.astype(np.uint64) * _M2)
        n = np.diff(np.searchsorted(letters[starts], ends))  # words of each row
        return self._distinct(hashes, n, rows)

    def _distinct(self, hashes: np.ndarray, n: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        k = self.words
        count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
        ends = np.r_[0, np.cumsum(count)]
        first = np.repeat(np.cumsum(n) - n, count) + np.arange(ends[-1]) - np.repeat(ends[:-1], count)
        size = np.repeat(np.minimum(n, k), count)
        total = size.astype(np.uint64) * _M1
        padded = np.r_[hashes, np.zeros(k, np.uint64)]
        for j in range(k):
            total += np.where(size > j, padded[first + j], np.uint64(0)) * self.places[j]
        out = mix(total)
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            if b - a > 1:
                out[a:b].sort()
        new = np.ones(len(out), bool)
        new[1:] = out[1:] != out[:-1]
        new[ends[:-1][count > 0]] = True
        return np.r_[0, np.cumsum(np.add.reduceat(np.r_[new, False].astype(np.int64), ends[:-1]) * (count > 0))] if rows else ends, out[new]
