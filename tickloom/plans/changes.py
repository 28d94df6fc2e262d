"""What a run has changed in a stored table, by date and instrument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schema import INSTRUMENT_DAY


def digests(rows: DataFrame, by: Sequence[str] = INSTRUMENT_DAY) -> DataFrame:
    """Per group the number of rows and a sum of their hashes, which no order changes."""
    whole = F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.sum(whole).alias("hash_sum"))


def differing(before: DataFrame, after: DataFrame, by: Sequence[str] = INSTRUMENT_DAY) -> DataFrame:
    """The groups whose digests differ, or that only one side has; null keys are groups, too.

    The sides are put below each other and counted, so it is one aggregate and no join.
    """
    both = before.select(*by, "row_count", "hash_sum", F.lit(1).alias("_side")).unionByName(
        after.select(*by, "row_count", "hash_sum", F.lit(-1).alias("_side"))
    )
    kinds = F.count_distinct(F.struct("row_count", "hash_sum"))
    return both.groupBy(*by).agg(kinds.alias("_kinds"), F.sum("_side").alias("_balance")).where(
        "_kinds > 1 OR _balance <> 0"
    ).select(*by)
