"""End-of-day correction: the latest version of each event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.nullsafe import join_on
from tickloom.schema import QUOTE, QUOTE_TYPE, TRADE, TRADE_TYPE

# The two correction keys.
BATCH_KEY = ("trade_dt", "rec_type", "symbol", "arrival_tm", "event_seq_nb")
EVENT_KEY = ("trade_dt", "rec_type", "symbol", "exchange", "event_tm", "event_seq_nb")

# The columns of the two record types.
TRADE_EVENT = (
    "trade_dt", "rec_type", "symbol", "exchange", "event_tm", "event_seq_nb", "arrival_tm",
    "trade_pr",
)
QUOTE_EVENT = (
    "trade_dt", "rec_type", "symbol", "exchange", "event_tm", "event_seq_nb", "arrival_tm",
    "bid_pr", "bid_size", "ask_pr", "ask_size",
)


def latest_event_time(
    df: DataFrame, key: Sequence[str] = BATCH_KEY, time: str = "event_tm", out: str = "latest_tm"
) -> DataFrame:
    return df.groupBy(*key).agg(F.max(time).alias(out))


def keep_latest_ties(
    df: DataFrame, key: Sequence[str] = BATCH_KEY, time: str = "event_tm"
) -> DataFrame:
    """Rows whose time is the largest of their key, all of them when several tie.

    The aggregate merges within tasks, and the join may split the rows of a key.
    """
    best = df.groupBy(*key).agg(F.max(time).alias(time))
    return join_on(df.where(F.col(time).isNotNull()), best, [*key, time], "left_semi")


def keep_latest_one(
    df: DataFrame, key: Sequence[str] = EVENT_KEY, time: str = "arrival_tm"
) -> DataFrame:
    """One row per key: the largest time, and the largest values where times tie.

    The aggregate merges the copies of a key before the shuffle.
    """
    rest = [c for c in df.columns if c not in key and c != time]
    best = F.max(F.struct(time, *rest)).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, "_best.*").select(*df.columns)


def correct_latest(df: DataFrame, preset: str = "reference") -> DataFrame:
    """Corrected events.

    ``reference``: per (date, type, symbol, arrival, sequence) the rows at the
    latest event time. ``latest_arrival``: per (date, type, symbol, exchange,
    event time, sequence) the row that arrived last.
    """
    if preset == "reference":
        return keep_latest_ties(df, BATCH_KEY, "event_tm")
    if preset == "latest_arrival":
        return keep_latest_one(df, EVENT_KEY, "arrival_tm")
    raise ValueError(f"unknown preset {preset!r}")


def project_trades(events: DataFrame) -> DataFrame:
    return events.select(*TRADE_EVENT)


def project_quotes(events: DataFrame) -> DataFrame:
    return events.select(*QUOTE_EVENT)


def load_trades(events: DataFrame, preset: str = "reference") -> DataFrame:
    """Corrected trades of all dates."""
    rows = project_trades(events.where(F.col("rec_type") == TRADE_TYPE))
    names = {"symbol": "stock_symbol", "exchange": "stock_exchange", "event_tm": "latest_trade"}
    return correct_latest(rows, preset).withColumnsRenamed(names).select(*TRADE.names)


def load_quotes(events: DataFrame, preset: str = "reference") -> DataFrame:
    """Corrected quotes of all dates."""
    rows = project_quotes(events.where(F.col("rec_type") == QUOTE_TYPE))
    names = {"symbol": "stock_symbol", "exchange": "stock_exchange", "event_tm": "latest_quote"}
    return correct_latest(rows, preset).withColumnsRenamed(names).select(*QUOTE.names)


def time_only_matches(
    df: DataFrame, price: str, key: Sequence[str] = BATCH_KEY, time: str = "event_tm"
) -> DataFrame:
    """What joining the latest times back on time alone attaches to each key.

    Such a join pairs every key with every row of any symbol at the same instant.
    The pairs are not produced: rows are counted per instant, and each key then
    meets one row. Gives the number of rows a key would get and their price range.
    """
    instants = df.groupBy(time).agg(
        F.count(F.lit(1)).alias("matched_rows"),
        F.min(price).alias("min_pr"),
        F.max(price).alias("max_pr"),
    )
    latest = latest_event_time(df, key, time, "latest_tm")
    return latest.join(instants.withColumnRenamed(time, "latest_tm"), "latest_tm")
