"""Joins on keys that may be null, as grouping treats them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hint=None) -> DataFrame:
    """Equi-join on ``keys``, null equal to null; the left side's keys are kept."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    if hint is not None:
        other = hint(other)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    joined = left.join(other, same, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"_r_{k}" for k in keys])
