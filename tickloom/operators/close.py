"""Last trade of a day and what later days make of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.nullsafe import join_on
from tickloom.functions.timeaxis import MINUTE, epoch_micros, next_date, slice_start
from tickloom.schema import INSTRUMENT, INSTRUMENT_DAY


def last_trades(
    trades: DataFrame,
    by: Sequence[str] = INSTRUMENT_DAY,
    time: str = "latest_trade",
    values: Sequence[str] = ("trade_pr",),
    tiebreak: Sequence[str] = ("event_seq_nb",),
) -> DataFrame:
    """The last trade of each group, exactly one row even where trades tie."""
    last = F.max(F.struct(time, *tiebreak, *values)).alias("_last")
    return trades.groupBy(*by).agg(last).select(*by, "_last.*")


def next_dates(dates: DataFrame, trade_dates: DataFrame) -> DataFrame:
    """For each date its prior trading date: the latest earlier one with any trade.

    Both frames hold distinct ``trade_dt`` values, at most one row per calendar
    day of the table, so one task orders them.
    """
    marked = dates.select("trade_dt", F.lit(None).cast("date").alias("_traded")).unionByName(
        trade_dates.select("trade_dt", F.col("trade_dt").alias("_traded"))
    )
    days = marked.groupBy("trade_dt").agg(F.max("_traded").alias("_traded"))
    before = Window.orderBy("trade_dt").rowsBetween(Window.unboundedPreceding, -1)
    return days.select(
        "trade_dt", F.last("_traded", ignorenulls=True).over(before).alias("prior_dt")
    ).where(F.col("prior_dt").isNotNull())


def prior_day_close(
    trades: DataFrame,
    calendar: str = "calendar",
    dates: DataFrame | None = None,
    values: Sequence[str] = ("trade_pr",),
    days: DataFrame | None = None,
) -> DataFrame:
    """Per date and instrument the last trade of the prior day, under the later date.

    ``calendar``: the prior day is the day before. ``trading``: it is the latest
    earlier date with any trade; ``dates`` is then a frame whose ``trade_dt``
    values need a close (the trades' own dates by default). ``days`` gives the prior
    date of each date instead, as ``trade_dt`` and ``prior_dt``.
    """
    last = last_trades(trades, values=values)
    if days is not None:
        return _under_later(last, days)
    if calendar == "calendar":
        return last.withColumn("trade_dt", next_date(F.col("trade_dt")))
    if calendar != "trading":
        raise ValueError(f"unknown calendar {calendar!r}")
    traded = trades.select("trade_dt").distinct()
    wanted = traded if dates is None else dates.select("trade_dt").distinct()
    prior = next_dates(wanted, traded)
    return _under_later(last, prior)


def _under_later(last: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of each prior date under the date it is prior to."""
    # One row per calendar day: small whatever the number of trades.
    targets = days.select(F.col("trade_dt").alias("_target"), "prior_dt")
    return (
        last.join(F.broadcast(targets), F.col("trade_dt") == F.col("prior_dt"))
        .withColumn("trade_dt", F.col("_target"))
        .drop("_target", "prior_dt")
    )


def last_value_unbounded(
    trades: DataFrame,
    values: Sequence[str] = ("trade_pr",),
    by: Sequence[str] = INSTRUMENT_DAY,
    time: str = "latest_trade",
    tiebreak: Sequence[str] = ("event_seq_nb",),
) -> DataFrame:
    """Each trade with the last values of its whole group as ``last_<value>``.

    The last trades are merged before the shuffle and joined back, so no task
    holds a group; the join chooses broadcast or sort-merge from their size.
    """
    last = last_trades(trades, by, time, values, tiebreak)
    last = last.select(*by, *[F.col(v).alias(f"last_{v}") for v in values])
    return join_on(trades, last, by, "left")


def dense_rank_latest(
    rows: DataFrame,
    by: Sequence[str] = INSTRUMENT_DAY,
    time: str = "latest_trade",
    out: str = "time_rank",
) -> DataFrame:
    """Dense rank by time, latest first; rows at one instant share a rank.

    The rank is that of the distinct instant within its minute plus the number of
    distinct instants in later minutes, so no window holds more than a minute's
    instants or a day's minutes. Rows meet their instant in a join.
    """
    timed = rows.withColumn("_us", epoch_micros(rows, time))
    minute = slice_start(F.col("_us"), MINUTE)
    instants = timed.select(*by, "_us").distinct().withColumn("_slice", minute)
    sizes = instants.groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    later = Window.partitionBy(*by).orderBy(F.desc("_slice"))
    later = later.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_slice", F.sum("_size").over(later).alias("_offset"))
    within = F.dense_rank().over(Window.partitionBy(*by, "_slice").orderBy(F.desc("_us")))
    rank = (within + F.coalesce("_offset", F.lit(0))).cast("int")
    ranked = join_on(instants, offsets, [*by, "_slice"], "left").withColumn(out, rank)
    found = join_on(timed, ranked.select(*by, "_us", out), [*by, "_us"], "left")
    return found.select(*rows.columns, out)


def latest_ranked(
    rows: DataFrame, by: Sequence[str] = INSTRUMENT_DAY, time: str = "latest_trade"
) -> DataFrame:
    """All rows of rank 1 by latest time, ties kept."""
    found = rows.where(F.col(time).isNotNull())
    best = found.groupBy(*by).agg(F.max(time).alias(time))
    return join_on(found, best, [*by, time], "left_semi")


def movement(price: Column, close: Column) -> Column:
    return price.cast("double") - close.cast("double")


def with_movement(rows: DataFrame, close: str = "close_pr") -> DataFrame:
    """Bid and ask movement from the close, null where there is no close."""
    return rows.withColumns(
        {
            "bid_move": movement(F.col("bid_pr"), F.col(close)),
            "ask_move": movement(F.col("ask_pr"), F.col(close)),
        }
    )


def join_close(
    quotes: DataFrame, close: DataFrame, price: str = "trade_pr", out: str = "close_pr"
) -> DataFrame:
    """Quotes with the close of their date and instrument, null where there is none.

    ``close`` has one row per date and instrument. No hint is given: a close table
    read from files is broadcast when its known size allows, and sort-merged with
    skewed instruments split otherwise.
    """
    return join_on(
        quotes, close.select(*INSTRUMENT_DAY, F.col(price).alias(out)), INSTRUMENT_DAY, "left"
    )


def price_movement(quotes: DataFrame, close: DataFrame, price: str = "trade_pr") -> DataFrame:
    """Quotes with prior close, bid movement and ask movement."""
    return with_movement(join_close(quotes, close, price))


def instrument_rows(rows: DataFrame, symbol: str) -> DataFrame:
    """Rows of one symbol; the predicate reaches the scan."""
    return rows.where(F.col(INSTRUMENT[0]) == symbol)
