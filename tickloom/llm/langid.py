"""Language identification by a bidirectional gated recurrent network over bytes.

One byte is one step. In each direction a unit keeps ``HIDDEN`` numbers h and moves
them by a gate f towards a candidate c:

    f = sigmoid(F[byte] + U h),  c = tanh(C[byte] + V h),  h <- h + f * (c - h)

From both directions' states at a position a linear layer gives the probabilities
of the languages there; those of a document are the mean over all its positions.
The text is read in segments of ``SEGMENT`` bytes, each from a zero state, so memory
does not depend on its length and every byte is a position.

Training is plain numpy: backpropagation through time and Adam on a sample of at
most ``SAMPLE`` segments of each of the ``LANGUAGES`` most frequent languages, drawn by
a hash of the text. That sample is all that comes to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import fields

HIDDEN = 8
SEGMENT = 256
LANES = 1024
PAD = 256
#: The sample: segments per language, languages, bytes of a training segment.
SAMPLE, LANGUAGES, TRAIN_BYTES = 1024, 256, 96
ROUNDS, BATCH, RATE = 300, 192, 0.02
UNKNOWN = "und"
#: Letters and the few numbers that are no decimal digits.
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """``table``: per direction, input to gate and candidate by byte; ``turn``: the same from the state."""

    languages: list[str]
    table: np.ndarray  # 2 x 2H x 257
    turn: np.ndarray  # 2 x 2H x H
    out: np.ndarray  # L x 2H
    bias: np.ndarray  # L

    def states(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x: steps x lanes. States after each step (2 x (steps + 1) x H x lanes), activations."""
        steps, lanes = x.shape
        h = np.zeros((2, steps + 1, HIDDEN, lanes), np.float32)
        act = np.empty((2, steps, 2 * HIDDEN, lanes), np.float32)
        for d, order in enumerate((x, x[::-1])):
            table, turn = self.table[d], self.turn[d]
            for t in range(steps):
                a = act[d, t]
                np.take(table, order[t], axis=1, out=a, mode="clip")
                a += turn @ h[d, t]
                np.tanh(a, out=a)
                a[:HIDDEN] *= 0.5
                a[:HIDDEN] += 0.5
                np.subtract(a[HIDDEN:], h[d, t], out=h[d, t + 1])
                h[d, t + 1] *= a[:HIDDEN]
                h[d, t + 1] += h[d, t]
        return h, act

    def chances(self, x: np.ndarray) -> np.ndarray:
        """Probabilities at every position: steps x L x lanes. Padding changes no state."""
        steps, lanes = x.shape
        h = np.zeros((2, steps + 1, HIDDEN, lanes), np.float32)
        a, move = np.empty((2 * HIDDEN, lanes), np.float32), np.empty((HIDDEN, lanes), np.float32)
        for d, order in enumerate((x, x[::-1])):
            table, turn, own = self.table[d], self.turn[d], h[d]
            for t in range(steps):
                np.take(table, order[t], axis=1, out=a, mode="clip")
                a += turn @ own[t]
                np.tanh(a, out=a)
                a[:HIDDEN] += 1.0
                a[:HIDDEN] *= 0.5
                np.subtract(a[HIDDEN:], own[t], out=move)
                move *= a[:HIDDEN]
                np.add(own[t], move, out=own[t + 1])
        return self._softmax(h)

    def _softmax(self, h: np.ndarray) -> np.ndarray:
        p = np.matmul(self.out[:, :HIDDEN], h[0, 1:])
        p += np.matmul(self.out[:, HIDDEN:], h[1, :0:-1])
        p += self.bias[:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[list[np.ndarray], float]:
        """Of the mean cross-entropy over all positions (padding left out); y: language per lane."""
        h, act = self.states(x)
        p = self._softmax(h)
        steps, lanes = x.shape
        real = (x != PAD).astype(np.float32)
        weight = real / max(real.sum(), 1)
        loss = -float((np.log(np.maximum(p[:, y, np.arange(lanes)], 1e-9)) * weight).sum())
        p[:, y, np.arange(lanes)] -= 1
        p *= weight[:, None, :]
        ahead, back = h[0, 1:], h[1, :0:-1]
        g_out = np.concatenate(
            [np.einsum("tlb,thb->lh", p, ahead, optimize=True), np.einsum("tlb,thb->lh", p, back, optimize=True)], axis=1
        )
        g_bias = p.sum(axis=(0, 2))
        g_table, g_turn = np.zeros_like(self.table), np.zeros_like(self.turn)
        for d, order in enumerate((x, x[::-1])):
            above = np.einsum("lh,tlb->thb", self.out[:, d * HIDDEN : (d + 1) * HIDDEN], p, optimize=True)
            above = above[::-1] if d else above
            carry = np.zeros((HIDDEN, lanes), np.float32)
            for t in range(steps - 1, -1, -1):
                f, c, before = act[d, t, :HIDDEN], act[d, t, HIDDEN:], h[d, t]
                g = above[t] + carry
                # tanh(a) = 2 f - 1, so df/da = 2 f (1 - f)
                inner = np.concatenate([g * (c - before) * 2 * f * (1 - f), g * f * (1 - c * c)])
                carry = g * (1 - f) + self.turn[d].T @ inner
                g_turn[d] += inner @ before.T
                for row in range(2 * HIDDEN):
                    g_table[d, row] += np.bincount(order[t], inner[row], minlength=PAD + 1)
        g_table[:, :, PAD] = 0
        return [g_table, g_turn, g_out, g_bias], loss


def fit(segments: list[bytes], labels: list[str], seed: int = 7) -> Network:
    """Adam on balanced batches: every language gives the same number of segments."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    n = max(len(languages), 1)
    net = Network(
        languages,
        rng.normal(0, 0.3, (2, 2 * HIDDEN, PAD + 1)).astype(np.float32),
        rng.normal(0, 0.3, (2, 2 * HIDDEN, HIDDEN)).astype(np.float32),
        rng.normal(0, 0.3, (n, 2 * HIDDEN)).astype(np.float32),
        np.zeros(n, np.float32),
    )
    net.table[:, :HIDDEN, PAD] = -30.0
    net.table[:, HIDDEN:, PAD] = 0.0
    if len(languages) < 2:
        return net
    x = padded(segments, TRAIN_BYTES)
    y = np.array([languages.index(v) for v in labels])
    own = [np.flatnonzero(y == k) for k in range(n)]
    values = [net.table, net.turn, net.out, net.bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, ROUNDS + 1):
        pick = np.concatenate([rng.choice(o, max(1, BATCH // n)) for o in own])
        grads, _ = net.gradients(x[:, pick], y[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 3 * (1 - step / (ROUNDS + 1)))
        for v, g, m, s in zip(values, grads, first, second, strict=True):
            g *= min(1.0, 1.0 / max(norm, 1e-9))
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
    return net


def padded(segments: list[bytes], steps: int) -> np.ndarray:
    """steps x lanes, filled up with ``PAD``."""
    x = np.full((len(segments), steps), PAD, np.int64)
    for row, s in zip(x, segments, strict=True):
        own = np.frombuffer(s[:steps], np.uint8)
        row[: len(own)] = own
    return np.ascontiguousarray(x.T)


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities over all positions of each text (texts x L); rows of empty texts are zero."""
    sums = np.zeros((len(texts), len(net.languages)))
    lengths = np.array([len(t) for t in texts])
    counts = -(-lengths // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    place = (np.arange(len(owner)) - first[owner]) * SEGMENT
    size = np.minimum(lengths[owner] - place, SEGMENT)
    order = np.argsort(-size, kind="stable")
    for at in range(0, len(order), LANES):
        pick = order[at : at + LANES]
        steps = int(size[pick[0]])
        x = padded([texts[owner[k]][place[k] : place[k] + SEGMENT] for k in pick], steps)
        real = np.arange(steps)[:, None] < size[pick]
        p = net.chances(x)
        np.add.at(sums, owner[pick], np.einsum("tlb,tb->bl", p, real.astype(np.float32), optimize=True))
    return sums / np.maximum(lengths, 1)[:, None]


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def sample(docs: DataFrame, text_col: str, lang_col: str) -> tuple[list[bytes], list[str]]:
    """Segments at hashed places of texts with the smallest hashes, the same number per language."""
    rows = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    # Texts that repeat are drawn once, so the share is set by the number of distinct ones; the estimate
    # is off by a few hundredths.
    distinct = F.approx_count_distinct(F.xxhash64("text")).alias("texts")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), distinct)
    counts = counts.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return [], []
    share = F.create_map(
        *(F.lit(v) for r in counts for v in (r["lang"], min(1.0, 3 * SAMPLE / max(r["texts"], 1))))
    )
    u = F.shiftrightunsigned(F.xxhash64("text"), 11) / F.lit(float(1 << 53))
    at = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - TRAIN_BYTES, F.lit(1))) + 1
    few = rows.withColumn("u", u).where(F.col("u") <= F.element_at(share, F.col("lang"))).select(
        "lang", "u", F.substr("text", at.cast("int"), F.lit(TRAIN_BYTES)).alias("segment")
    )
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("u", "segment"))
    found = few.distinct().withColumn("n", nth).where(F.col("n") <= SAMPLE).orderBy("lang", "n").collect()
    return [r["segment"].encode() for r in found], [r["lang"] for r in found]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Network:
    return fit(*sample(docs, text_col, lang_col))


def identify(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, from the text alone.

    The score is the language's mean probability. A null text, an empty one and one
    without any letter get ``und`` and score 0, as do all texts if nothing was learned.
    Texts are read whole; equal texts get equal results; an empty table gives no rows.
    Other columns are kept; columns named lang_pred or score are replaced.
    """
    spark = docs.sparkSession
    # Plain values: a task has no module to look the class up in.
    model = spark.sparkContext.broadcast((net.languages, net.table, net.turn, net.out, net.bias))
    rows = docs.drop("lang_pred", "score")
    schema = type(rows.schema)([*rows.schema.fields]).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(*model.value)
        names = np.array([*net.languages, UNKNOWN], dtype=object)
        for batch in fields.pieces(batches):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            known = np.array([bool(net.languages) and has_letter(t) for t in texts], bool)
            p = pooled(net, [t.encode() if k else b"" for t, k in zip(texts, known, strict=True)])
            best = p.argmax(axis=1) if p.shape[1] else np.zeros(len(texts), int)
            score = p.max(axis=1) if p.shape[1] else np.zeros(len(texts))
            pred = names[np.where(known, best, len(net.languages))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(np.where(known, np.clip(score, 0, 1), 0.0))],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return rows.mapInArrow(run, schema)
