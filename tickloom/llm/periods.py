"""Periodic runs of words, found with multi-scale minimizers.

Words become integers. At scale m (a power of two) every place has the hash of the m
words that start there, and of every m / 2 neighbouring places the one with the least
hash is chosen, the first one where several share it. In a run with a smallest period
q, m / 2 < q <= m, equal windows lie q apart, so a chosen place is followed by another
with the same hash q places on, and by none before: two equal stretches of m >= q words
less than q apart would give the run a smaller period. Chosen neighbours with an equal
hash, at a distance of that scale, are therefore seeds for every run of four periods or
more. A seed is extended to both sides by comparing words themselves, once per stretch.

Periods up to ``SCAN`` are found by comparing all words with those that many places on.

Everything about a document is decided within it, so documents are not shuffled. The
documents of a batch are laid out behind each other, the longest first, with a word that
occurs nowhere else between them, and are searched together: the scales that a document
is too short for end before it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import fields

#: Longest period that is looked for by lag scans; a power of two.
SCAN = 16
#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words compared at a time when a seed is extended, doubled with every step.
_STEP = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


def least(period: int) -> int:
    return max(LEAST_WORDS, LEAST_PERIODS * period)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads neighbours."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def doubled(hashes: np.ndarray, m: int) -> np.ndarray:
    """Hashes of stretches of 2 * m words from those of m words."""
    if len(hashes) <= m:
        return hashes[:0]
    return _mixed(hashes[:-m] * np.uint64(3) + _mixed(hashes[m:]))


def minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places with the least hash of any ``window`` neighbours, the first one where several share it; in order."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    at, width = np.arange(len(hashes)), 1
    while width < window:
        a, b = at[:-width], at[width:]
        at = np.where(hashes[a] <= hashes[b], a, b)
        width *= 2
    return at[np.r_[True, at[1:] != at[:-1]]]


def seeds(hashes: np.ndarray, m: int) -> Iterator[tuple[int, int]]:
    """(distance, place) of chosen neighbours with equal hashes, m / 2 < distance <= m; in order of both."""
    chosen = minimizers(hashes, m // 2)
    by = chosen[np.argsort(hashes[chosen], kind="stable")]
    same = hashes[by[1:]] == hashes[by[:-1]]
    apart = by[1:] - by[:-1]
    good = same & (apart > m // 2) & (apart <= m)
    lag, place = apart[good], by[:-1][good]
    order = np.lexsort((place, lag))
    return zip(lag[order].tolist(), place[order].tolist(), strict=True)


def extended(words: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The first and the last place (excluded) of the stretch around ``place`` whose words recur ``lag`` places on."""
    end, step = place, _STEP
    while end + lag < len(words):
        n = min(step, len(words) - lag - end)
        differ = np.flatnonzero(words[end : end + n] != words[end + lag : end + lag + n])
        end += int(differ[0]) if len(differ) else n
        if len(differ):
            break
        step *= 2
    start, step = place, _STEP
    while start > 0:
        n = min(step, start)
        differ = np.flatnonzero(words[start - n : start] != words[start - n + lag : start + lag])
        start -= n - 1 - int(differ[-1]) if len(differ) else n
        if len(differ):
            break
        step *= 2
    return start, end


def runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs, sorted.

    ``words`` are documents of the given sizes, longest first, each followed by a
    number that occurs nowhere else.
    """
    found: list[np.ndarray] = []
    places = np.r_[0, np.cumsum(sizes + 1)]

    def part(shortest: int) -> np.ndarray:
        return words[: places[np.searchsorted(-sizes, -shortest, side="right")]]

    for lag in range(1, SCAN + 1):
        own = part(least(lag))
        if len(own) <= lag:
            break
        same = np.zeros(len(own) - lag + 2, np.int8)
        same[1:-1] = own[lag:] == own[:-lag]
        turn = np.diff(same)
        first, last = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        length = last - first + lag
        good = length >= least(lag)
        found.append(np.stack([first[good], length[good], np.full(good.sum(), lag)], axis=1))
    m, hashes = 1, _mixed(words.astype(np.uint64) + np.uint64(1))
    while len(part(least(m + 1))):
        own = part(least(m + 1))
        hashes = doubled(hashes[: len(own) - m + 1], m)
        m *= 2
        if m <= SCAN:
            continue
        known, rows = (0, -1), []
        for lag, place in seeds(hashes, m):
            if known[0] == lag and place < known[1]:
                continue
            start, end = extended(own, place, lag)
            known = lag, end
            if end - start + lag >= least(lag):
                rows.append((start, end - start + lag, lag))
        found.append(np.array(rows, np.int64).reshape(-1, 3))
    every = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    # A multiple of a run's period gives the same stretch: the smallest period stays.
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    if len(every):
        every = every[np.r_[True, (every[1:, :2] != every[:-1, :2]).any(axis=1)]]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


@dataclass
class Found:
    """A document's words and its runs (start, length, period) by start, then period."""

    words: list[bytes]
    runs: np.ndarray

    def strongest(self) -> tuple[int, int, int] | None:
        """The run with the greatest length / period; ties: smallest start, then period."""
        best = None
        for start, length, period in self.runs.tolist():
            if best is None or length * best[2] > best[1] * period:
                best = start, length, period
        return best

    def collapsed(self) -> list[bytes]:
        """The words without those that a run holds after its first period."""
        if not len(self.runs):
            return self.words
        start, length, period = self.runs.T
        cover = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(cover, start + period, 1)
        np.add.at(cover, start + length, -1)
        return [self.words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]


def search(documents: list[list[bytes]]) -> list[Found]:
    """The runs of every document (a list of words)."""
    numbers: dict[bytes, int] = {}
    own = [np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64) for words in documents]
    sizes = np.array([len(w) for w in own], np.int64)
    order = np.argsort(-sizes, kind="stable")
    laid = [part for k in order.tolist() for part in (own[k], [len(numbers) + k])]
    found = runs(np.concatenate(laid).astype(np.int64), sizes[order]) if laid else np.zeros((0, 3), np.int64)
    begins = np.cumsum(sizes[order] + 1) - sizes[order] - 1
    of = np.searchsorted(begins, found[:, 0], side="right") - 1
    bounds = np.searchsorted(of, np.arange(len(order) + 1))
    out: list[Found] = [None] * len(documents)  # type: ignore[list-item]
    for n, k in enumerate(order.tolist()):
        rows = found[bounds[n] : bounds[n + 1]].copy()
        rows[:, 0] -= begins[n]
        out[k] = Found(documents[k], rows)
    return out


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Words of the documents that the query rewrites: those after some place repeat those before.

    One document in ten, by the hash of its id, gets a periodic tail. A null id gets none.
    """
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[: n - a]


def _searched(
    batch: pa.RecordBatch, rewrite: Callable[[list[bytes], int | None], list[bytes]] | None
) -> tuple[pa.Array, list[Found]]:
    # bytes.split() parts at exactly the characters \x20 and \x09 to \x0D.
    words = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
    if rewrite:
        words = [rewrite(w, i) for w, i in zip(words, batch.column(0).to_pylist(), strict=True)]
    return batch.column(0), search(words)


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``text`` without repeated periods, and ``runs`` (array of start, length, period) of every document.

    Words are stretches of [^\\x20\\x09-\\x0D]. A run is a stretch of words with
    smallest period q, of max(6, 4 q) words or more, that no neighbour extends with that
    period. Of each run the first period stays; the kept words are joined by one space.
    A text without runs comes back as it is; a null text has none and stays null. Ids are
    not looked at: rows that repeat one are documents of their own. Texts of any length
    are read whole; an empty table gives no rows; other columns are dropped.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in fields.pieces(batches):
            ids, found = _searched(batch, None)
            old = batch.column(1).to_pylist()
            texts = [b" ".join(f.collapsed()).decode() if len(f.runs) else t for f, t in zip(found, old, strict=True)]
            spans = [[{"start": s, "length": n, "period": p} for s, n, p in f.runs.tolist()] for f in found]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(texts, pa.string()), pa.array(spans, of)], names=[id_col, "text", "runs"]
            )

    schema = f"`{id_col}` {kind}, text string, runs array<struct<start:long,length:long,period:long>>"
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    rewrite: Callable[[list[bytes], int | None], list[bytes]] | None = None,
) -> DataFrame:
    """doc_id, n_runs, the strongest run and hashes of all runs and of the kept words.

    ``rewrite`` changes the words of a document first. Without a run the four columns of
    the strongest one are null. Cases as in ``collapse``; a null text has no words and
    the hashes of the empty text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    longs = ("n_runs", "start", "length", "period", "exponent_milli")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in fields.pieces(batches):
            ids, found = _searched(batch, rewrite)
            rows = []
            for f in found:
                listed = "".join([f"{s},{n},{p}\n" for s, n, p in f.runs.tolist()])
                best = f.strongest()
                facts = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                hashes = [hashlib.sha256(x).hexdigest() for x in (listed.encode(), b" ".join(f.collapsed()))]
                rows.append((len(f.runs), *facts, *hashes))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.string()) for c in columns[5:])],
                names=["doc_id", *longs, "runs_sha256", "collapsed_sha256"],
            )

    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in longs)}, runs_sha256 string, collapsed_sha256 string"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
