"""Column names that cannot clash with those an operator adds, and batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hide(df: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, list[tuple[str, str]]]:
    """``df`` with all columns but ``keep`` renamed, and the pairs (old name, new name) in order."""
    names = [(c, c if c in keep else f"_in{i}") for i, c in enumerate(df.columns)]
    return df.select(*(F.col(f"`{old}`").alias(new) for old, new in names)), names


#: Bytes of an Arrow batch that are turned into Python objects at a time; a longer row comes alone.
PIECE = 4 << 20


def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``PIECE`` bytes."""
    for batch in batches:
        rows = max(1, batch.num_rows * PIECE // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
