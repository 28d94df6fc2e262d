"""Centroid clustering with a progressive search in Walsh-Hadamard coefficients.

Vectors and centroids become integers and are transformed exactly. The transform keeps
distances up to a fixed factor, so the squared differences of any coefficients add up
to a lower bound of the distance. Coefficients are taken from coarse to fine (by their
number of sign changes): the centroid that is nearest in the first one is finished at
once and gives an upper bound, every centroid whose sum is strictly above it goes, and
those that are left are finished, so ties are decided on exact distances.

A round is one pass over the table. Every task sums up the members of each centroid and
gives one row per centroid; only those sums meet in a shuffle, and only the centroids
come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.sources.tables import staged

#: Rows searched at a time.
ROWS = 4096
#: Integers up to this size are searched in 64 bits, all others as Python's integers.
SMALL = 1 << 20
_LONG = (1 << 63) - 1


def order(dims: int) -> np.ndarray:
    """The coefficients from coarse to fine: rows of the transform by their sign changes."""
    rows = transform(np.eye(dims, dtype=np.int64), np.arange(dims))
    return np.argsort((np.diff(rows, axis=0) != 0).sum(axis=0), kind="stable")


def transform(rows: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of every row, in the order given."""
    n, dims = rows.shape
    half = 1
    while half < dims:
        pair = rows.reshape(n, dims // (2 * half), 2, half)
        a, b = pair[:, :, 0], pair[:, :, 1]
        rows = np.stack([a + b, a - b], axis=2).reshape(n, dims)
        half *= 2
    return rows[:, by]


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of every row, ties to the smaller number.

    Both are arrays of coefficients. Integers of 64 bits or Python's integers (``object``).
    """
    n, dims = rows.shape
    sums = (rows[:, :1] - centroids[:, :1].T) ** 2
    guess = sums.argmin(axis=1)
    bound = ((rows - centroids[guess]) ** 2).sum(axis=1)
    alive = sums <= bound[:, None]
    done = 1
    while done < dims:
        i, j = np.nonzero(alive)
        part = slice(done, 2 * done)
        sums[i, j] += ((rows[i, part] - centroids[j, part]) ** 2).sum(axis=1)
        alive[i, j] = sums[i, j] <= bound[i]
        done *= 2
    # The guess has its own bound, so every row has a finished centroid.
    sums = np.where(alive, sums, bound[:, None] + 1)
    best = sums.argmin(axis=1)
    return best, sums[np.arange(n), best] // dims


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: int64 where all are small, else Python's integers.

    ``scale`` is a power of two, so the product of doubles is exact; beyond 2 ** 53
    a double is an integer itself.
    """
    if not x.size or np.abs(x).max() <= SMALL // scale:
        return np.floor(x * scale).astype(np.int64)
    exact = [int(v) * scale if abs(v) >= 2.0**53 else int(np.floor(v * scale)) for v in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def kept(vectors: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v (doubles) of the rows with an id and exactly ``dims`` finite components."""
    x = F.col(vector_col)
    good = F.col(id_col).isNotNull() & (F.size(x) == dims) & ~F.exists(
        x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))
    )
    return vectors.where(good).select(F.col(id_col).cast("long").alias("vec_id"), x.cast("array<double>").alias("v"))


def starts(rows: DataFrame, k: int, scale: int) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids; every task keeps ``k`` rows."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return [whole(np.array(r["v"], float), scale).tolist() for r in first]


def _searched(batches, centroids: list[list[int]], scale: int, dims: int) -> Iterator[tuple]:
    """vec_id, integers, numbers and distances of rows, in pieces."""
    by = order(dims)
    exact = np.array(centroids, object).reshape(-1, dims)
    small = bool((abs(exact) <= SMALL).all())
    wide = transform(exact, by)
    for batch in batches:
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        for at in range(0, len(x), ROWS):
            v = whole(x[at : at + ROWS], scale)
            v = v if small else v.astype(object)
            found = nearest(transform(v, by), wide.astype(v.dtype))
            yield batch.column(0).slice(at, ROWS), v, *found


def moved(rows: DataFrame, centroids: list[list[int]], scale: int, dims: int) -> list[list[int]]:
    """The floored means of every centroid's vectors; a centroid without any stays."""
    schema = "cluster int, n long, sums array<string>"

    def rows_of(totals: dict[int, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(totals), pa.int32()),
                pa.array([n for n, _ in totals.values()], pa.int64()),
                pa.array([[str(s) for s in sums] for _, sums in totals.values()], pa.list_(pa.string())),
            ],
            names=["cluster", "n", "sums"],
        )

    def add(totals: dict[int, list], cluster: int, n: int, sums: np.ndarray) -> None:
        old = totals.setdefault(cluster, [0, np.zeros(dims, object)])
        old[0] += n
        old[1] = old[1] + sums

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for _, v, best, _ in _searched(batches, centroids, scale, dims):
            for cluster in np.unique(best).tolist():
                own = v[best == cluster]
                add(totals, cluster, len(own), own.sum(axis=0).astype(object))
        yield rows_of(totals)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                add(totals, r["cluster"], r["n"], np.array([int(s) for s in r["sums"]], object))
        yield rows_of(totals)

    sums = rows.mapInArrow(members, schema).repartition("cluster").mapInArrow(merged, schema)
    new = [list(c) for c in centroids]
    for r in sums.collect():
        new[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
    return new


def assigned(rows: DataFrame, centroids: list[list[int]], scale: int, dims: int) -> DataFrame:
    """vec_id, cluster and distance of every row; a distance beyond 64 bits is null."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, best, distance in _searched(batches, centroids, scale, dims):
            long = [d if d <= _LONG else None for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(best.astype(np.int32)), pa.array(long, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    return rows.mapInArrow(search, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector kept.

    Kept are rows with an id and exactly ``dims`` (a power of two) components, none of
    them null, NaN or infinite; the others give no row. Components become
    floor(scale * x), ``scale`` a power of two. Ties of distances go to the smaller
    number. Rows that repeat an id are vectors of their own; where they would both be
    starts the smaller vector comes first. With fewer than ``k`` vectors each is a
    start; an empty table gives no rows. Integers of any size are exact; distances and
    sums that do not fit 64 bits are null. Other columns are ignored.
    """
    rows = kept(vectors, dims, id_col, vector_col)
    centroids = starts(rows, k, scale)
    for _ in range(rounds if centroids else 0):
        centroids = moved(rows, centroids, scale, dims)
    found = staged(assigned(rows, centroids, scale, dims), "centroids-assigned")
    distance = F.col("distance").cast("decimal(38,0)")
    sums = found.groupBy("cluster").agg(
        F.sum(distance).alias("total"), F.max(F.col("distance").isNull()).alias("beyond")
    ).collect()  # one row per centroid
    total = {r["cluster"]: None if r["beyond"] else int(r["total"]) for r in sums}
    over_all = None if None in total.values() else sum(total.values())

    def long(n: int | None) -> int | None:
        return n if n is not None and n <= _LONG else None

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = [(c, long(total[c]), long(over_all), digests[c]) for c in total]
    of = vectors.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # At most k rows.
    return found.join(F.broadcast(of), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
