"""The staging tables as views, so that SQL text can use them by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tickloom.operators.asof import asof_last_trade, merged_timeline
from tickloom.operators.enrich import carried_trades
from tickloom.operators.moving import moving_average
from tickloom.sources.tables import STAGING_NAMES, register_views

# The columns of the trade views.
TRADE_COLUMNS = (
    "trade_dt", "stock_symbol", "stock_exchange", "latest_trade", "event_seq_nb", "trade_pr",
)


def register_staging(
    trades: DataFrame,
    quotes: DataFrame,
    names: Sequence[str] = STAGING_NAMES,
    minutes: int = 180,
    calendar: str = "calendar",
) -> None:
    """Register staging views of all dates; a ``trade_dt`` predicate picks a day.

    The last average up to a trade is the average at that trade, so the last-trade
    views rename it. ``prev_temp_last_trade`` gives the carried-in trades.
    """
    plain = trades.select(*TRADE_COLUMNS)
    averaged = moving_average(plain, minutes)

    def seeds() -> DataFrame:
        return carried_trades(averaged, quotes, calendar)

    def quote_update() -> DataFrame:
        return asof_last_trade(averaged, quotes, seeds())

    views = {
        "tmp_trade_moving_avg": lambda: plain,
        "temp_trade_moving_avg": lambda: averaged,
        "tmp_last_trade": lambda: plain,
        "temp_last_trade": lambda: averaged.withColumnRenamed("mov_avg_pr", "last_mov_avg_pr"),
        "prev_temp_last_trade": lambda: seeds().withColumnRenamed("mov_avg_pr", "last_mov_avg_pr"),
        "quotes": lambda: quotes,
        "quote_union": lambda: merged_timeline(averaged, quotes),
        "quote_update": quote_update,
    }
    register_views({name: views[name]() for name in names})
