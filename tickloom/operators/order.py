"""Sorted and top-n outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_rows(
    rows: DataFrame,
    by: Sequence[str] = ("trade_dt", "stock_symbol", "event_seq_nb"),
    tiebreak: Sequence[str] = ("latest_trade", "stock_exchange", "arrival_tm"),
) -> DataFrame:
    """All rows in order. The tie columns also let a range split a repeated key."""
    return rows.orderBy(*by, *[c for c in tiebreak if c in rows.columns])


def first_n(rows: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """The first rows in the given total order; each task keeps ``n`` rows."""
    return rows.orderBy(*by).limit(n)


def latest_n(rows: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """The last rows in the given total order, latest first."""
    return rows.orderBy(*[F.desc(c) for c in by]).limit(n)
