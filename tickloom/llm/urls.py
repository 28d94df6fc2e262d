"""URL filter: rules first, then a ratio of two character language models.

One model is trained on the URLs that a rule allows, one on those that a rule
blocks: character counts of variable order, smoothed by giving unseen characters
what the next shorter context says (Witten-Bell). A URL without a rule is allowed
when its log-likelihood difference per character reaches a threshold, which is
calibrated on all URLs with a rule.

Characters fall into ``SYMBOLS`` classes (digits are one class), contexts have up
to three of them. A model is therefore at most ``SYMBOLS ** 4`` numbers (2,560,000),
however many URLs there are; the counts come from all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SYMBOLS = 40
ORDER = 4
START, END, OTHER = 0, 1, 2
_SPECIAL = "/.-_~%:@+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Score histogram for the threshold: bins of this width around zero.
BIN, BINS = 1 / 256, 4096

Rules = Sequence[tuple[str, str]]


def _symbol_table() -> np.ndarray:
    table = np.full(256, OTHER, np.int64)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = 3 + i
    table[ord("0") : ord("9") + 1] = 29
    for i, c in enumerate(_SPECIAL):
        table[ord(c)] = 30 + i
    return table


SYMBOL = _symbol_table()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#``; path: then up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def longest_rule(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule that fits, else null. A rule is a host and the start of a path."""
    found = []
    for rule, _ in sorted(rules, key=lambda r: -len(r[0])):
        own_host, slash, own_path = rule.partition("/")
        fits = (host == own_host) | host.endswith("." + own_host)
        found.append(F.when(fits & path.startswith(slash + own_path), F.lit(rule)))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def cells(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts: one cell (context and character) per position, and positions per text."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    wide = lengths + ORDER  # three starts before, one end after
    ends = np.cumsum(wide)
    symbols = np.full(int(wide.sum()), START, np.int64)
    symbols[ends - 1] = END
    starts = ends - wide + ORDER - 1
    at = np.arange(len(data)) + np.repeat(starts - (offsets[:-1] - offsets[0]), lengths)
    symbols[at] = SYMBOL[data]
    code = np.zeros(len(symbols), np.int64)
    for back in range(ORDER):
        code[back:] += symbols[: len(symbols) - back] * SYMBOLS**back
    keep = np.ones(len(symbols), bool)
    for k in range(ORDER - 1):
        keep[ends - wide + k] = False
    return code[keep], lengths + 1


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(character | three before) for every cell, from counts of the same shape."""
    tables = [counts.reshape((SYMBOLS,) * ORDER).astype(float)]
    while tables[-1].ndim > 1:
        tables.append(tables[-1].sum(axis=0))
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for table in reversed(tables):
        total, kinds = table.sum(-1, keepdims=True), (table > 0).sum(-1, keepdims=True)
        weight = np.maximum(total + kinds, 1)
        p = np.where(total > 0, (table + kinds * p) / weight, np.broadcast_to(p, table.shape))
    return np.log(p).ravel()


def train(urls: DataFrame, label: str) -> np.ndarray:
    """Log ratio per cell. ``urls`` has ``_url`` and a boolean column that is null without a rule."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 * SYMBOLS**ORDER, np.int64)
        for batch in batches:
            code, n = cells(batch.column(0))
            side = np.repeat(np.asarray(batch.column(1).cast(pa.int64())), n)
            sums += np.bincount(code + side * SYMBOLS**ORDER, minlength=len(sums))
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["cell", "n"])

    known = urls.where(F.col(label).isNotNull()).select("_url", label)
    found = known.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(2 * SYMBOLS**ORDER, np.int64)
    rows = found.toArrow()  # at most 2 * SYMBOLS ** ORDER rows
    counts[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    blocked, allowed = counts.reshape(2, -1)
    return (log_model(allowed) - log_model(blocked)).astype(np.float32)


def scored(urls: DataFrame, ratio) -> DataFrame:
    """Adds ``score``, the log ratio per character (the end counts as one)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, n = cells(batch.column("_url"))
            total = np.r_[0.0, np.cumsum(ratio.value[code], dtype=np.float64)]
            ends = np.cumsum(n)
            value = (total[ends] - total[ends - n]) / n if len(n) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(value)], names=[*batch.schema.names, "score"]
            )

    schema = T.StructType([*urls.schema.fields, T.StructField("score", T.DoubleType())])
    return urls.mapInArrow(score, schema)


def calibrate(known: DataFrame, label: str) -> float:
    """Threshold with the best mean of both sides' accuracy over all rows with a label."""
    bins = F.least(F.greatest(F.floor(F.col("score") / BIN) + BINS // 2, F.lit(0)), F.lit(BINS - 1))
    rows = known.groupBy(bins.alias("b"), F.col(label).alias("side")).count().collect()
    sides = np.zeros((2, BINS + 1))
    for b, side, n in rows:
        sides[int(side), int(b)] += n
    if not sides.any(axis=1).all():
        return 0.0
    share = sides / sides.sum(axis=1, keepdims=True)
    blocked_below = np.r_[0.0, np.cumsum(share[0])[:-1]]
    allowed_from = 1 - np.r_[0.0, np.cumsum(share[1])[:-1]]
    quality = blocked_below + allowed_from
    best = np.flatnonzero(quality >= quality.max() - 1e-9)
    middle = best[np.argmin(np.abs(best - math.ceil(best.mean())))]
    return float((middle - BINS // 2) * BIN)


def judge(pages: DataFrame, rules: Rules, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, score and verdict (``allow`` or ``block``) of every URL.

    Null URLs and URLs without ``://`` have an empty host and path, match no rule and
    are judged as the empty text. Any length is read whole. Repeated rows count as
    often as they occur. Without allowed or without blocked URLs the threshold is 0.
    An empty table gives no rows; other columns are ignored.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    verdicts = [F.when(F.col("rule") == rule, F.lit(verdict)) for rule, verdict in rules]
    by_rule = F.coalesce(*verdicts) if verdicts else F.lit(None).cast("string")
    rows = rows.select(
        "*", F.concat("host", "path").alias("_url"), (by_rule == "allow").alias("_allowed")
    )
    ratio = pages.sparkSession.sparkContext.broadcast(train(rows, "_allowed"))
    all_scored = scored(rows, ratio)
    threshold = calibrate(scored(rows.where(F.col("_allowed").isNotNull()), ratio), "_allowed")
    allowed = F.coalesce(F.col("_allowed"), F.col("score") >= threshold)
    return all_scored.select(
        "page_id", "host", "path", "rule", "score",
        F.when(allowed, F.lit("allow")).otherwise(F.lit("block")).alias("verdict"),
    )
