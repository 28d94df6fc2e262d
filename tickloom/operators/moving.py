"""Time-range indicators over trades."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import exact
from tickloom.functions.nullsafe import join_on
from tickloom.functions.timeaxis import MINUTE, epoch_micros, slice_start
from tickloom.schema import SYMBOL_DAY


def moving_average(
    trades: DataFrame,
    minutes: int = 180,
    by: Sequence[str] = SYMBOL_DAY,
    time: str = "latest_trade",
    price: str = "trade_pr",
    out: str = "mov_avg_pr",
    last: Mapping[str, str] | None = None,
    tiebreak: Sequence[str] = ("event_seq_nb",),
) -> DataFrame:
    """Average price of the last ``minutes`` up to each trade, trades at its instant included.

    Equals ``avg(price)`` over a RANGE frame of that width, in linear time. A
    frame reaching from one slice into an earlier one is a running sum from the
    start of its own slice, whole slices, and a running sum back from the end of
    the first, so a row is added a fixed number of times however many rows a frame
    holds, and nothing is ever subtracted. Prices are added as decimals, so the result
    does not depend on the order of the rows or on how they are partitioned.

    Trades of one instant share the result: they are merged within tasks first, so
    a window never holds more than one row per microsecond of a minute, and the
    averages are joined back on the instant, where Spark can split a large one.

    ``last`` names columns to add, each with the last value (nulls respected) of a
    column, or of the average itself, in a frame that ends at the current row. The
    frame's last rows are those at the row's own instant, whatever its width.
    """
    if minutes < 1:
        raise ValueError("minutes must be positive")
    last = last or {}
    rows = trades.withColumn("_us", epoch_micros(trades, time))
    found = [
        F.max(F.struct(*tiebreak, c)).getField(c).alias(new) for new, c in last.items() if c != out
    ]
    sums = [e.alias(f"_{m}") for m, e in exact.sums(F.col(price)).items()]
    instants = rows.groupBy(*by, "_us").agg(*sums, *found)
    averages = _averages(instants, by, minutes * MINUTE, MINUTE, out)
    names = [F.col(out if c == out else new).alias(new) for new, c in last.items()]
    averages = averages.select(*by, "_us", out, *names)
    return join_on(rows, averages, [*by, "_us"], "left").select(*trades.columns, out, *last)


def framed(rows: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """The instants of ``rows`` with what their own slice and the frame's first one add to the frame.

    ``rows`` has ``_us``, ``_slice`` and the measures ``_sum``, ``_rest``, ``_count``.
    Adds ``_in_<measure>`` and ``_out_<measure>``; rows without a count leave nothing behind.
    """
    measures = [f"_{m}" for m in exact.MEASURES]
    # A row moved ahead by the frame width lands in the slice whose frames it leaves.
    twice = F.expr(
        f"explode(array(struct(true AS enters, _us AS us, _slice AS slice), "
        f"struct(false AS enters, _us + {width}L AS us, _slice + {width}L AS slice)))"
    )
    both = rows.withColumn("_as", twice).where("_as.enters OR _count > 0").withColumns(
        {"_us": F.col("_as.us"), "_slice": F.col("_as.slice"), "_enters": F.col("_as.enters")}
    )
    group = Window.partitionBy(*by, "_slice")
    first, current = Window.unboundedPreceding, Window.currentRow
    up_to = group.orderBy("_us").rangeBetween(first, current)
    down_to = group.orderBy(F.desc("_us")).rangeBetween(first, current)
    enters = F.col("_enters")
    return both.withColumns(
        {
            **{f"_in_{m}": e.over(up_to) for m, e in exact.resummed("_", enters).items()},
            **{f"_out_{m}": e.over(down_to) for m, e in exact.resummed("_", ~enters).items()},
        }
    ).where(enters).select(*rows.columns, *[f"_{p}{m}" for p in ("in", "out") for m in measures])


def between(by: Sequence[str], width: int, step: int, prefix: str = "_") -> dict[str, Column]:
    """Measures of the whole slices strictly between the first and the last of a frame, over rows per slice."""
    inner = Window.partitionBy(*by).orderBy("_slice").rangeBetween(step - width, -step)
    return {m: e.over(inner) for m, e in exact.resummed(prefix).items()}


def measured(prefix: str) -> dict[str, Column]:
    return {m: F.col(f"{prefix}{m}") for m in exact.MEASURES}


def _averages(rows: DataFrame, by: Sequence[str], width: int, step: int, out: str) -> DataFrame:
    """Add the average over ``width`` to rows with ``_us`` and the measures.

    ``step`` is the slice width and divides ``width``.
    """
    sliced = rows.withColumn("_slice", slice_start(F.col("_us"), step))
    sums = framed(sliced, by, width)
    parts = [measured("_in_"), measured("_out_")]
    if width > step:
        totals = sliced.groupBy(*by, "_slice").agg(*[e.alias(f"_{m}") for m, e in exact.resummed("_").items()])
        middles = totals.select(
            *by, "_slice", *[e.alias(f"_mid_{m}") for m, e in between(by, width, step).items()]
        )
        sums = join_on(sums, middles, [*by, "_slice"], "left")
        parts.append(measured("_mid_"))
    return sums.withColumn(out, exact.mean(exact.added(*parts)))


def last_value_range(
    trades: DataFrame,
    value: str,
    by: Sequence[str] = SYMBOL_DAY,
    time: str = "latest_trade",
    tiebreak: Sequence[str] = ("event_seq_nb",),
    out: str = "last_value",
) -> DataFrame:
    """Last value of a RANGE frame that ends at the current row, nulls respected.

    The frame's last rows are those at the row's own instant, whatever its width,
    so this is the value of the highest ``tiebreak`` there. The input is read twice;
    for columns beside a moving average use its ``last``.
    """
    key = [*by, time]
    last = F.max(F.struct(*tiebreak, value)).getField(value).alias(out)
    return join_on(trades, trades.groupBy(*key).agg(last), key, "left")
