"""Gapless numbers within keys, without bringing a key to one task.

Every task counts the rows of its own partition per key and the rows are written
once. The counts per (key, partition) are summed up in partition order, and each
row adds the total of the partitions before its own. A key may hold any share of
the rows; the keys themselves must be few per partition (shards, lengths, size
classes), because a task keeps one counter for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sources.tables import staged


def running_count(keys: np.ndarray, seen: dict[int, int]) -> np.ndarray:
    """How many rows with the same key came before each row; ``seen`` goes on."""
    if not len(keys):
        return np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    counts = np.diff(np.r_[starts, len(keys)])
    before = np.array([seen.get(int(k), 0) for k in ordered[starts]], np.int64)
    for k, n in zip(ordered[starts], counts, strict=True):
        seen[int(k)] = seen.get(int(k), 0) + int(n)
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - np.repeat(starts, counts) + np.repeat(before, counts)
    return out


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... within each value of the integer column ``key``."""
    part, local, before = f"{name}_part", f"{name}_local", f"{name}_before"
    schema = T.StructType(
        [*df.schema.fields, T.StructField(part, T.LongType()), T.StructField(local, T.LongType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        at = TaskContext.get().partitionId()
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            columns = [
                *batch.columns,
                pa.array(np.full(batch.num_rows, at, np.int64)),
                pa.array(running_count(keys, seen)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, part, local])

    return with_offsets(staged(df.mapInArrow(count, schema), name), key, part, local).withColumn(
        name, F.col(local) + F.col(before)
    ).drop(part, local, before)


def with_offsets(rows: DataFrame, key: str, part: str, local: str) -> DataFrame:
    """Adds ``<name>_before``: rows of the key in earlier partitions. ``rows`` is a written table."""
    before = part.removesuffix("_part") + "_before"
    counts = rows.groupBy(key, part).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        key, part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(before)
    )
    return rows.join(offsets, [key, part])
