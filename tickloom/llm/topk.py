"""Exact top-k by inner product with a vector-approximation file.

Vectors are cut into blocks. Within a block each dimension is divided into
``CELLS`` cells of equal width; the approximation of a vector is its cell numbers,
one byte each. Scanning the cells of all blocks gives a lower and an upper bound of
every score. Exact vectors are then read in the order of their upper bounds: first
a few per query, then only those whose bound still reaches the k-th exact score.

Equal vectors have equal scores, so they are one entry that keeps its k + 1
smallest ids: ties go to smaller ids, and one id may be the query's own. A vector
that a third of all rows share thus costs as much as any other.

Queries are taken in chunks of about ``CHUNK`` distinct vectors, which is what is
broadcast at a time; each chunk scans the approximations once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.sources.tables import staged

CELLS = 64
BLOCK = 8192
CHUNK = 4096
FIRST_READ = 16
_SLICE = 128
#: Integers below this size take part; their inner products fit 38 decimal digits up to 2 ** 14 dimensions.
LARGE = 1 << 56
#: Below this size inner products of up to 2 ** 9 dimensions fit 64 bits.
SMALL = 1 << 27


def quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v = floor(scale * x) as array<long>; only vectors with finite components below ``LARGE``."""
    x = F.col(vector_col)
    good = F.col(id_col).isNotNull() & x.isNotNull() & ~F.exists(
        x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) >= float(LARGE // scale))
    )
    v = F.transform(x, lambda e: F.floor(e.cast("double") * scale))
    return vectors.where(good).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """uid (smallest id), v and the ``keep`` smallest ids of every distinct vector."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("_n", nth).where(F.col("_n") <= keep)
    ids = F.sort_array(F.collect_list("vec_id"))
    return few.groupBy("v").agg(F.min("vec_id").alias("uid"), ids.alias("ids"))


def approximations(vectors: DataFrame) -> DataFrame:
    """One row per block and number of dimensions: ids, cells, and the cells' bounds."""

    def block(uids: list[int], rows: list[np.ndarray]) -> dict:
        v = np.array(rows, np.int64).reshape(len(rows), -1)
        low = v.min(axis=0) if v.size else np.zeros(v.shape[1], np.int64)
        width = (v.max(axis=0) - low) // CELLS + 1 if v.size else low + 1
        return {
            "dim": v.shape[1], "uids": np.array(uids, np.int64).tobytes(),
            "cells": ((v - low) // width).astype(np.uint8).tobytes(),
            "low": low.tobytes(), "width": width.astype(np.int64).tobytes(),
        }

    schema = pa.schema(
        [("dim", pa.int64())] + [(n, pa.binary()) for n in ("uids", "cells", "low", "width")]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for uid, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                row = v.values.to_numpy(zero_copy_only=False)
                uids, rows = waiting.setdefault(len(row), ([], []))
                uids.append(uid)
                rows.append(row)
                if len(rows) == BLOCK:
                    yield pa.RecordBatch.from_pylist([block(*waiting.pop(len(row)))], schema)
        for uids, rows in waiting.values():
            yield pa.RecordBatch.from_pylist([block(uids, rows)], schema)

    return vectors.select("uid", "v").mapInArrow(
        build, "dim long, uids binary, cells binary, low binary, width binary"
    )


def bounds(q: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray):
    """Lower and upper bound of every inner product of ``q`` with the vectors in the cells."""
    floor = (low + cells * width).astype(float)
    spread = (width - 1).astype(float)
    at_floor = q @ floor.T
    below = np.minimum(q, 0) @ spread
    above = np.maximum(q, 0) @ spread
    size = np.abs(q).max(initial=0) * (np.abs(floor).max(initial=0) + spread.max(initial=0)) * (q.shape[1] + 1)
    if size < 2.0**52:
        return at_floor + below[:, None], at_floor + above[:, None]
    # Doubles round; each bound moves outwards by more than all roundings together.
    slack = (np.abs(q) @ np.abs(floor).T + (above - below)[:, None]) * ((q.shape[1] + 8) * 2.0**-50) + 1
    return at_floor + below[:, None] - slack, at_floor + above[:, None] + slack


def scan(blocks: DataFrame, queries, k: int) -> DataFrame:
    """(qid, uid, low, high) of all vectors that may be among a query's k best of their block."""
    schema = pa.schema([("qid", pa.int64()), ("uid", pa.int64()), ("low", pa.float64()), ("high", pa.float64())])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qids, vectors = queries.value.get(row["dim"], (None, None))
                if qids is None:
                    continue
                uids = np.frombuffer(row["uids"], np.int64)
                cells = np.frombuffer(row["cells"], np.uint8).reshape(len(uids), -1).astype(np.int64)
                low, width = np.frombuffer(row["low"], np.int64), np.frombuffer(row["width"], np.int64)
                for at in range(0, len(qids), _SLICE):
                    q = vectors[at : at + _SLICE].astype(float)
                    least, most = bounds(q, cells, low, width)
                    nth = max(least.shape[1] - k, 0)
                    floor = np.partition(least, nth, axis=1)[:, nth : nth + 1]
                    i, j = np.nonzero(most >= floor)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(qids[at : at + _SLICE][i]), pa.array(uids[j]), pa.array(least[i, j]), pa.array(most[i, j])],
                        schema=schema,
                    )

    return blocks.mapInArrow(candidates, "qid long, uid long, low double, high double")


def _nth_best(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Per qid the n-th largest value, or the smallest if there are fewer."""
    best = Window.partitionBy("qid").orderBy(F.desc(by))
    top = rows.select("qid", by).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= n)
    return top.groupBy("qid").agg(F.min(by).alias("least"), F.count(F.lit(1)).alias("_have"))


def _exact(pairs: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """Reads the vectors of the pairs and adds their score."""
    short = F.aggregate(F.zip_with("v", "q", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    whole = "decimal(38,0)"
    long = F.aggregate(
        F.zip_with("v", "q", lambda a, b: (a.cast("decimal(18,0)") * b.cast("decimal(18,0)")).cast(whole)),
        F.lit(0).cast(whole), lambda s, x: (s + x).cast(whole),
    )
    wide = lambda c: (F.size(c) > 512) | F.exists(c, lambda e: F.abs(e) >= SMALL)
    product = F.when(wide("v") | wide("q"), long).otherwise(short.cast(whole))
    return (
        pairs.select("qid", "uid").join(vectors.select("uid", "v", "ids"), "uid")
        .join(queries.select(F.col("uid").alias("qid"), F.col("v").alias("q")), "qid")
        .select("qid", "uid", "ids", product.alias("score"))
    )


def _chunk(queries: DataFrame, chunks: int, number: int) -> dict:
    """The query vectors of a chunk by number of dimensions."""
    rows = queries.where(F.pmod(F.xxhash64("uid"), F.lit(chunks)) == number).select("uid", "v").toArrow()
    out: dict[int, tuple[list, list]] = {}
    for uid, v in zip(rows.column("uid").to_pylist(), rows.column("v").to_pylist(), strict=True):
        ids, vs = out.setdefault(len(v), ([], []))
        ids.append(uid)
        vs.append(v)
    return {d: (np.array(i, np.int64), np.array(v, np.int64).reshape(len(i), d)) for d, (i, v) in out.items()}


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best other vectors.

    Scores are inner products of floor(scale * x); ties go to the smaller id. Rows
    without an id and vectors that are null or hold a null, NaN or infinite component
    take no part; vectors of another number of dimensions than the query's are not
    compared with it. Rows with the same id and vector are one; an empty table or no query
    gives no rows. Results are exact for all components below ``LARGE`` / scale; vectors
    with larger ones, whose products no longer fit a score, take no part either. A score
    beyond 64 bits is null, its rank is right. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = staged(quantised(vectors, scale, id_col, vector_col), "topk-rows")
    table = staged(distinct_vectors(rows.distinct(), k + 1), "topk-vectors")
    asked = rows.where(is_query).distinct()
    owners = staged(asked.join(table.select("v", "uid"), "v").select("uid", "vec_id"), "topk-owners")
    queries = staged(table.join(owners.select("uid").distinct(), "uid", "left_semi"), "topk-queries")
    blocks = staged(approximations(table), "topk-cells")
    chunks = max(1, math.ceil(queries.count() / CHUNK))
    found = None
    for number in range(chunks):
        part = spark.sparkContext.broadcast(_chunk(queries, chunks, number))
        one = staged(scan(blocks, part, k + 1), "topk-candidates")
        found = one if found is None else found.unionByName(one)
    floor = _nth_best(found, "low", k + 1)
    certain = found.join(floor, "qid").where(F.col("high") >= F.col("least"))
    order = Window.partitionBy("qid").orderBy(F.desc("high"), "uid")
    ranked = staged(certain.select("qid", "uid", "high", F.row_number().over(order).alias("n")), "topk-ranked")
    first = staged(_exact(ranked.where(F.col("n") <= FIRST_READ), table, queries), "topk-first")
    limit = _nth_best(first, "score", k + 1)
    open_ = ranked.where(F.col("n") > FIRST_READ).join(limit, "qid")
    more = _exact(open_.where((F.col("high") >= F.col("least")) | (F.col("_have") <= k)), table, queries)
    scores = first.unionByName(more).select("qid", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    lists = (
        scores.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
        .groupBy("qid")
        .agg(F.sort_array(F.collect_list(F.struct("_n", "vec_id", "score"))).alias("best"))
    )
    own = owners.join(lists, owners.uid == lists.qid)
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("vec_id")), 1, k)
    return own.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("p", "b")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"),
        F.col("b.score").try_cast("long").alias("score"),
    )
