"""Shards by longest-processing-time scheduling.

Documents with equal texts form a group that stays together. Groups, the largest
first, go to the shard with the least bytes, taken from a heap.

The driver never sees groups one by one. Group sizes are put into classes by their
nine leading bits, so there are at most 512 classes for each power of two
(``MAX_CLASSES`` in all), and a class is handed out as a whole: ``allot`` gives the
shards the counts that the heap would give to that many groups of the class's mean
size. Sizes below 512 bytes have a class each; within a class sizes differ by less
than 1/256. A task then turns a group's number within its class into a shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.ranks import numbered
from tickloom.sources.tables import staged

SIZE_BITS = 9
MAX_CLASSES = (1 << SIZE_BITS) * (64 - SIZE_BITS)
#: Class numbers are powers of two times this plus the leading bits.
_STEP = 1 << SIZE_BITS


def size_class(size: Column) -> Column:
    """Number of the class of a size; larger sizes have larger numbers."""
    bits = F.length(F.bin(size))
    shift = F.greatest(bits - SIZE_BITS, F.lit(0))
    return (shift * _STEP + F.call_function("shiftright", size, shift)).cast("long")


def allot(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs (class, first number, end, shard) from rows (class, groups, bytes).

    Exact LPT where a class has up to ``4 * shards`` groups; more are poured in at
    once up to a common level and the rest goes through the heap.
    """
    loads = np.zeros(shards)
    runs = []
    for number, groups, total in sorted(classes, reverse=True):
        mean, left, given = total / groups, groups, np.zeros(shards, np.int64)
        if left > 4 * shards:
            order = np.sort(loads)
            levels = (np.cumsum(order) + (left - shards) * mean) / np.arange(1, shards + 1)
            reached = np.flatnonzero(levels > order)
            level = levels[reached[-1]] if len(reached) else order[0]
            given = np.maximum(0, np.floor((level - loads) / mean)).astype(np.int64)
            left -= int(given.sum())
        heap = [(load, s) for s, load in enumerate(loads + given * mean)]
        heapq.heapify(heap)
        for _ in range(left):
            load, s = heap[0]
            heapq.heapreplace(heap, (load + mean, s))
            given[s] += 1
        loads += given * mean
        ends = np.cumsum(given)
        runs += [(number, int(e - n), int(e), s) for s, (n, e) in enumerate(zip(given, ends, strict=True)) if n]
    return runs


def shard_documents(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 within the shard).

    A null text counts as an empty one: size ``overhead``, and one group with the
    empty texts. Repeated rows are documents of their own and stay with their
    group. An empty table gives no rows; other columns are ignored. A group larger
    than a fair share fills its shard alone, because groups stay whole.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("_group"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("_group", "size").agg((F.count(F.lit(1)) * F.col("size")).alias("_total"))
    groups = numbered(
        groups.select("_group", "_total", size_class(F.col("_total")).alias("_class")), "_class", "_number"
    )
    sums = groups.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.sum("_total").alias("b"))
    runs = sorted(allot([tuple(r) for r in sums.collect()], shards))
    classes = np.array([r[0] for r in runs], np.int64)
    firsts = np.array([r[1] for r in runs], np.int64)
    targets = np.array([r[3] for r in runs], np.int32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("_class").to_numpy(zero_copy_only=False)
            number = batch.column("_number").to_numpy(zero_copy_only=False)
            low = np.searchsorted(classes, own, "left")
            high = np.searchsorted(classes, own, "right")
            while (wide := high - low > 1).any():
                middle = (low + high) // 2
                right = wide & (firsts[np.minimum(middle, len(firsts) - 1)] <= number)
                low, high = np.where(right, middle, low), np.where(wide & ~right, middle, high)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_group"), pa.array(targets[low] if len(low) else targets[:0])],
                names=["_group", "shard"],
            )

    placed = groups.select("_group", "_class", "_number").mapInArrow(place, "_group binary, shard int")
    return numbered(rows.join(placed, "_group").drop("_group"), "shard", "slot")
