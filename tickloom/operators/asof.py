"""Trades and quotes on one time line, and the last trade as of each quote."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.timeaxis import epoch_micros
from tickloom.operators.minutes import NEVER, group_key, look_up, timed, value_index
from tickloom.schema import INSTRUMENT_DAY, QUOTE_TYPE, TIMELINE, TRADE_TYPE

FILLED = {"trade_pr": "last_trade_price", "mov_avg_pr": "last_mov_avg_price"}


def _shaped(rows: DataFrame, rec_type: str, time: str, extra: Sequence[str] = ()) -> DataFrame:
    """The time line's columns, typed nulls where ``rows`` has none."""
    columns = []
    for field in TIMELINE.fields:
        if field.name == "rec_type":
            value = F.lit(rec_type)
        elif field.name == "event_tm":
            value = F.col(time)
        elif field.name in rows.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return rows.select(*columns, *extra)


def merged_timeline(
    trades: DataFrame,
    quotes: DataFrame,
    seeds: DataFrame | None = None,
    close: str | None = None,
) -> DataFrame:
    """Trades, quotes and carried-in trades in the common shape, duplicates kept.

    ``seeds`` holds the last trade of the prior day under the later date. With
    ``close`` their price is also given in a column of that name. The order lives
    in the operators that need it; nothing is sorted here.
    """
    parts = [
        _shaped(trades, TRADE_TYPE, "latest_trade"),
        _shaped(quotes, QUOTE_TYPE, "latest_quote"),
    ]
    if seeds is not None:
        extra = [] if close is None else [F.col("trade_pr").alias(close)]
        parts.append(_shaped(seeds, TRADE_TYPE, "latest_trade", extra))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


def forward_fill(
    timeline: DataFrame,
    by: Sequence[str] = INSTRUMENT_DAY,
    columns: Mapping[str, str] = FILLED,
    inclusive: bool = True,
) -> DataFrame:
    """Last non-null value of each column up to each row, as a new column.

    Rows are ordered by time; at one instant trades come before quotes, or after
    them when ``inclusive`` is false. A trade without a price comes before the
    priced ones of its instant, and shows the last one of an earlier instant. Quotes
    hold none of the columns themselves.
    """
    rows = timed(timeline, "event_tm")
    # A trade looks before its own instant, because its own value comes first.
    own = F.col("rec_type") == QUOTE_TYPE if inclusive else F.lit(False)
    asked = rows.withColumns({"_key": group_key(by), "_seen": F.col("_us") - F.when(own, 0).otherwise(1)})
    found = look_up(asked, value_index(asked, asked, ["_key"], list(columns)), ["_key"])
    new = {
        out: F.coalesce(c, F.col("_found")[c], f"_carry_{c}") for c, out in columns.items()
    }
    return found.withColumns(new).select(*timeline.columns, *columns.values())


def asof_last_trade(
    trades: DataFrame,
    quotes: DataFrame,
    seeds: DataFrame | None = None,
    inclusive: bool = True,
    close: str | None = None,
) -> DataFrame:
    """Each quote with the last trade price and average as of its time.

    A quote sees the trades of its own date and instrument and the carried-in one.
    Trades are merged into the minute index, and each quote meets its minute once.
    """
    spread = [] if close is None else [close]
    values = _shaped(trades, TRADE_TYPE, "latest_trade")
    if seeds is not None:
        extra = [] if close is None else [F.col("trade_pr").alias(close)]
        carried = _shaped(seeds, TRADE_TYPE, "latest_trade", extra)
        values = values.unionByName(carried, allowMissingColumns=True)
    elif close is not None:
        values = values.withColumn(close, F.lit(None).cast("float"))
    values = timed(values, "event_tm").withColumn("_key", group_key(INSTRUMENT_DAY))
    return _asked(quotes, inclusive, {"_key": group_key(INSTRUMENT_DAY)}, values, spread)


def asof_stored(trades: DataFrame, quotes: DataFrame, inclusive: bool = True) -> DataFrame:
    """``asof_last_trade`` without carried-in trades, for two tables written by ``save_co_partitioned``.

    Their buckets are by date, instrument and minute, which is what trades are merged
    by and quotes are joined by, so neither is shuffled; only rows that stand for a
    minute are. A quote without an instrument or a time sees nothing.
    """
    keys = list(INSTRUMENT_DAY)
    time = F.coalesce(epoch_micros(trades, "latest_trade"), F.lit(NEVER))
    values = trades.withColumn("_us", time).withColumnRenamed("minute", "_slice")
    return _asked(quotes, inclusive, {}, values, [], keys)


def _asked(
    quotes: DataFrame, inclusive: bool, key: Mapping[str, Column], values: DataFrame, spread: Sequence[str],
    keys: Sequence[str] = ("_key",),
) -> DataFrame:
    """Quotes in the time line's columns with what the index of ``values`` has for them."""
    stored = "minute" in quotes.columns
    asked = _shaped(quotes, QUOTE_TYPE, "latest_quote", ["minute"] if stored else []).drop(*FILLED)
    if stored:
        us = F.coalesce(epoch_micros(asked, "event_tm"), F.lit(NEVER))
        asked = asked.withColumn("_us", us).withColumnRenamed("minute", "_slice")
    else:
        asked = timed(asked, "event_tm")
    asked = asked.withColumns({**key, "_seen": F.col("_us") - (0 if inclusive else 1)})
    index = value_index(values, asked, keys, list(FILLED), spread)
    found = look_up(asked, index, keys, how="left" if stored else "inner")
    names = [c for c in TIMELINE.names if c not in FILLED]
    new = {out: F.coalesce(F.col("_found")[c], f"_carry_{c}") for c, out in FILLED.items()}
    return found.withColumns(new).select(*names, *spread, *FILLED.values())
