"""Sums of prices that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A price to twelve digits, and a sum of up to 10 ** 10 of the largest.
_PRICE = "decimal(26,12)"
SUM = "decimal(36,12)"

#: A sum in decimals, a sum of the prices too large for them (or not finite), and their number.
MEASURES = ("sum", "rest", "count")


def sums(price: Column) -> dict[str, Column]:
    """Aggregates of ``price``, by measure."""
    exact = price.try_cast(_PRICE)
    return {
        "sum": F.sum(exact).cast(SUM),
        "rest": F.sum(F.when(exact.isNull(), price.cast("double"))),
        "count": F.count(price),
    }


def resummed(prefix: str, where: Column | None = None) -> dict[str, Column]:
    """Sums of the measures in columns named ``<prefix><measure>``; use ``over`` for a window."""
    found = {}
    for m in MEASURES:
        value = F.col(f"{prefix}{m}")
        found[m] = F.sum(value if where is None else F.when(where, value))
    return found


def added(*parts: dict[str, Column]) -> dict[str, Column]:
    """The measures of several disjoint sets of rows together; up to three parts."""
    zero = {"sum": F.lit(0).cast(SUM), "rest": F.lit(0.0), "count": F.lit(0).cast("bigint")}
    found = {}
    for m in MEASURES:
        values = [F.coalesce(p[m].cast(SUM) if m == "sum" else p[m], zero[m]) for p in parts]
        total = values[0]
        for v in values[1:]:
            total = total + v
        found[m] = total
    return found


def mean(total: dict[str, Column]) -> Column:
    return F.when(total["count"] > 0, (total["sum"].cast("double") + total["rest"]) / total["count"])
