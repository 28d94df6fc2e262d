"""Quality of whole documents by a convolutional network over bytes, in numpy.

A byte has ``DIMS`` learned numbers; ``FILTERS`` learned filters look at every ``WIDTH``
neighbouring bytes. A document is cut into chunks of ``CHUNK`` bytes that overlap by
``WIDTH`` - 1, the last one ending with the document, so every stretch of ``WIDTH``
bytes lies in one. Each chunk keeps the largest answer of every filter; a linear layer
makes a logit of them, and the document's probability is the sigmoid of the mean logit
of all its chunks. What no filter answers to counts too: a chunk that repeats a few
words leaves most filters low. Chunks are taken ``LANES`` at a time, so memory does not
depend on a document's length.

Training is plain numpy: the gradient of the cross-entropy goes back to the places that
won the pooling, steps are Adam's. It learns from ``CROPS`` chunks of each of at most
``SAMPLE`` distinct texts per label, drawn by a hash of the text. That sample is all that
comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import fields

WIDTH, DIMS, FILTERS = 8, 8, 16
CHUNK = 256
STRIDE = CHUNK - WIDTH + 1
LANES = 64
PAD = 256
#: The sample: distinct texts per label, chunks of each.
SAMPLE, CROPS = 2048, 4
ROUNDS, BATCH, RATE = 800, 96, 0.02
#: Scores from here on mean label 1.
LIMIT = 0.3


@dataclass
class Network:
    """``byte``: 257 x DIMS; ``kernel``: WIDTH x DIMS x FILTERS; a logit from the pooled answers."""

    byte: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray  # FILTERS
    out: np.ndarray  # FILTERS
    bias: np.ndarray  # 1

    def tables(self) -> np.ndarray:
        """What each byte adds to every filter at each of its places: WIDTH x 257 x FILTERS."""
        return np.matmul(self.byte[None], self.kernel).astype(np.float32)

    def answers(self, x: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Filters at all places of chunks: chunks x places x FILTERS."""
        places = x.shape[1] - WIDTH + 1
        total = np.take(tables[0], x[:, :places], axis=0)
        part = np.empty_like(total)
        for k in range(1, WIDTH):
            np.take(tables[k], x[:, k : k + places], axis=0, out=part, mode="clip")
            total += part
        return total

    def pooled(self, x: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The largest answers of every chunk, at least zero: chunks x FILTERS."""
        return np.maximum(self.answers(x, tables).max(axis=1) + self.shift, 0)

    def logits(self, x: np.ndarray, tables: np.ndarray) -> np.ndarray:
        return self.pooled(x, tables) @ self.out + self.bias[0]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[list[np.ndarray], float]:
        """Of the mean cross-entropy of the chunks with labels ``y``."""
        answers = self.answers(x, np.matmul(self.byte[None], self.kernel))
        at = answers.argmax(axis=1)
        raw = np.take_along_axis(answers, at[:, None], axis=1)[:, 0] + self.shift
        pooled = np.maximum(raw, 0)
        z = pooled @ self.out + self.bias[0]
        loss = float(np.mean(np.logaddexp(0, z) - y * z))
        g = (1 / (1 + np.exp(-z)) - y) / len(y)
        g_raw = g[:, None] * self.out * (raw > 0)
        own = np.take_along_axis(x, (at[:, :, None] + np.arange(WIDTH)).reshape(len(x), -1), axis=1)
        own = own.reshape(len(x), FILTERS, WIDTH)
        g_kernel = np.einsum("bf,bfwd->wdf", g_raw, self.byte[own], optimize=True)
        back = np.einsum("bf,wdf->bfwd", g_raw, self.kernel, optimize=True).reshape(-1, DIMS)
        g_byte = np.zeros_like(self.byte)
        np.add.at(g_byte, own.ravel(), back)
        return [g_byte, g_kernel, g_raw.sum(axis=0), pooled.T @ g, np.array([g.sum()])], loss


def fit(chunks: list[bytes], labels: list[int], seed: int = 5) -> Network:
    """Adam on batches with as many chunks of either label.

    With one label only all scores are that label's, without any they are one half.
    """
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.5, (PAD + 1, DIMS)), rng.normal(0, 0.2, (WIDTH, DIMS, FILTERS)),
        np.zeros(FILTERS), rng.normal(0, 0.3, FILTERS), np.zeros(1),
    )
    y = np.array(labels, float)
    own = [np.flatnonzero(y == k) for k in (0, 1)]
    if not all(len(o) for o in own):
        net.out[:] = 0
        net.bias[:] = 0 if not len(y) else 40 if len(own[1]) else -40
        return net
    x = padded(chunks)
    values = [net.byte, net.kernel, net.shift, net.out, net.bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, ROUNDS + 1):
        pick = np.concatenate([rng.choice(o, BATCH // 2) for o in own])
        grads, _ = net.gradients(x[pick], y[pick])
        rate = RATE * min(1.0, 2 * (1 - step / (ROUNDS + 1)))
        for v, g, m, s in zip(values, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def padded(chunks: list[bytes]) -> np.ndarray:
    """chunks x CHUNK byte values, filled up with ``PAD``."""
    x = np.full((len(chunks), CHUNK), PAD, np.int64)
    for row, c in zip(x, chunks, strict=True):
        own = np.frombuffer(c[:CHUNK], np.uint8)
        row[: len(own)] = own
    return x


def places(size: int) -> list[int]:
    """Where the chunks of a document of so many bytes begin; an empty one has one, too."""
    last = max(size - CHUNK, 0)
    return [*range(0, last, STRIDE), last]


def scores(net: Network, tables: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Probability of label 1 of every text."""
    owner, start = [], []
    for k, t in enumerate(texts):
        own = places(len(t))
        owner += [k] * len(own)
        start += own
    of = np.array(owner, np.int64)
    sums = np.zeros(len(texts))
    for at in range(0, len(owner), LANES):
        pick = range(at, min(at + LANES, len(owner)))
        x = padded([texts[owner[k]][start[k] : start[k] + CHUNK] for k in pick])
        np.add.at(sums, of[at : at + LANES], net.logits(x, tables))
    mean = sums / np.maximum(np.bincount(of, minlength=len(texts)), 1)
    return 1 / (1 + np.exp(-np.clip(mean, -40, 40)))


def sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str
) -> tuple[list[bytes], list[int]]:
    """Chunks at hashed places of the texts with the smallest hashes, ``SAMPLE`` texts per label at most.

    Shares are set by the number of distinct texts, so texts that repeat crowd out no
    other. Only hashes meet the labels, and then the chunks of the texts drawn.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    known = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")
    )
    counts = rows.select("_id", "h").join(known, "_id").groupBy("label").agg(F.approx_count_distinct("h").alias("n"))
    # The estimate is off by a few hundredths; three times as many as needed are surely enough.
    share = {r["label"]: min(1.0, 3 * SAMPLE / max(r["n"], 1)) for r in counts.collect()}  # two rows at most
    if not share:
        return [], []
    u = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    places = F.greatest(F.length("text") - CHUNK, F.lit(0)) + 1
    chunks = F.array(*(
        F.substr("text", (F.pmod(F.xxhash64("text", F.lit(n)), places) + 1).cast("int"), F.lit(CHUNK)) for n in range(CROPS)
    ))
    drawn = rows.where(u <= max(share.values())).select("_id", u.alias("u"), F.array_distinct(chunks).alias("chunks"))
    few = drawn.join(known, "_id").select("label", "u", "chunks").distinct()
    found = []
    for label in sorted(share):
        found += few.where((F.col("label") == label) & (F.col("u") <= share[label])).orderBy("u", "chunks").limit(SAMPLE).collect()
    pairs = [(c.encode()[:CHUNK], r["label"]) for r in found for c in r["chunks"]]
    return [c for c, _ in pairs], [label for _, label in pairs]


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Network:
    """Learns from the texts of documents with a label of 0 or 1; other labels and null ids are left out."""
    return fit(*sample(docs, labels, id_col, text_col, label_col))


def score(docs: DataFrame, net: Network, text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``limit`` on), from the text alone.

    A null text counts as an empty one; both get a score. Texts are read whole; equal
    texts get equal scores; an empty table gives no rows. Without any label to learn
    from all scores are one half, with one label only they are that label's. Other
    columns are kept; columns named score or predicted are replaced.
    """
    spark = docs.sparkSession
    # Plain values: a task has no module to look the class up in.
    model = spark.sparkContext.broadcast((net.byte, net.kernel, net.shift, net.out, net.bias))
    rows = docs.drop("score", "predicted")
    schema = type(rows.schema)([*rows.schema.fields]).add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(*(v.astype(np.float32) for v in model.value))
        tables = net.tables()
        for batch in fields.pieces(batches):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            p = scores(net, tables, [(t or "").encode() for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p), pa.array((p >= limit).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    return rows.mapInArrow(run, schema)
