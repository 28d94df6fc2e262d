"""Quotes enriched with trade indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import exact
from tickloom.functions.timeaxis import MINUTE
from tickloom.operators.asof import asof_last_trade
from tickloom.operators.close import next_dates, prior_day_close, with_movement
from tickloom.operators.minutes import group_key, look_up, pages, so_far, timed
from tickloom.operators.moving import between, framed, measured
from tickloom.schema import ENRICHED, QUOTE_TYPE, SYMBOL_DAY


def carried_trades(
    averaged: DataFrame, quotes: DataFrame, calendar: str = "calendar", days: DataFrame | None = None
) -> DataFrame:
    """The last trade of the prior day of each quote date, with its average."""
    dates = quotes.select("trade_dt") if calendar == "trading" and days is None else None
    return prior_day_close(averaged, calendar, dates, ("trade_pr", "mov_avg_pr"), days)


def enrich_averaged(
    averaged: DataFrame,
    quotes: DataFrame,
    inclusive: bool = True,
    calendar: str = "calendar",
    days: DataFrame | None = None,
) -> DataFrame:
    """Enriched quotes from trades that already have ``mov_avg_pr``.

    ``days`` may name the prior date of each date, where the trades given are not all
    there are. The prior close travels with the carried-in trade through the minutes the
    as-of fill needs anyway, so attaching it costs no join.
    """
    seeds = carried_trades(averaged, quotes, calendar, days)
    filled = asof_last_trade(averaged, quotes, seeds, inclusive, "close_pr")
    return with_movement(filled).select(*ENRICHED.names)


_MEASURED = ", ".join(exact.MEASURES)


def _total(v: str) -> dict[str, Column]:
    """Measures of a frame: what its end slices hold (fields of ``v``) and the whole ones between."""
    return exact.added({m: F.col(f"{v}.{m}") for m in exact.MEASURES}, measured("_mid_"))


def trade_index(trades: DataFrame, quotes: DataFrame, minutes: int, calendar: str = "calendar") -> DataFrame:
    """The minute index of last price and moving average, straight from trades without averages.

    Per symbol and date (``_day``), exchange (``_x``), minute and page. Trades are merged
    per instant, quotes only mark their minutes. The frame sums of ``moving_average``
    are taken over the instants of a minute; the whole minutes between, what earlier
    minutes have left and the close of the prior day come from windows over one row per
    minute, all in one shuffle by symbol.
    """
    if minutes < 1:
        raise ValueError("minutes must be positive")
    width = minutes * MINUTE
    key = ["_day", "_x"]
    minute = [*key, "_slice"]
    day, x = group_key(SYMBOL_DAY).alias("_day"), group_key(["stock_exchange"]).alias("_x")
    sold = timed(trades, "latest_trade").select(
        day, x, "_slice", "_us", F.expr("struct(event_seq_nb AS seq, trade_pr AS price) AS _trade")
    )
    # Quotes only mark their minutes.
    asked = timed(quotes, "latest_quote").select(day, x, "_slice").distinct()
    instants = sold.groupBy(*minute, "_us").agg(
        *[e.alias(f"_{m}") for m, e in exact.sums(F.col("_trade.price")).items()],
        F.expr("max(IF(_trade.price IS NOT NULL, _trade, NULL)).price AS _price"),
        F.max("_trade").alias("_last"),
    )
    near = exact.added(measured("_in_"), measured("_out_"))
    traded = framed(instants, ["_day"], width).withColumns(near)
    own = so_far(key)
    # The average of an instant is null if neither it nor the whole minutes hold a price.
    value = F.struct(
        *[
            F.last(F.expr(e), ignorenulls=True).over(own).alias(name)
            for name, e in (
                ("price", "IF(_price IS NOT NULL, struct(_us AS us, _price AS value), NULL)"),
                ("every", f"struct(_us AS us, {_MEASURED})"),
                ("sure", f"IF(count > 0, struct(_us AS us, {_MEASURED}), NULL)"),
                ("close", f"struct(_us AS us, _last.seq, _last.price, {_MEASURED})"),
            )
        ],
        F.struct(*[e.over(own).alias(m) for m, e in exact.resummed("_").items()]).alias("own"),
    )
    found = pages(traded, key, value)
    ends = found.where("_to IS NULL").select(*minute, "_end").unionByName(asked, allowMissingColumns=True)
    left = _left_behind(ends, trades, quotes, width, calendar)
    lists = F.expr("transform(_list, e -> struct(e.us, struct(e.v.price, e.v.every, e.v.sure) AS v)) AS _list")
    return left.join(found.select(*minute, lists, "_from", "_to"), minute, "left")


def _last_mean(v: str) -> Column:
    """(us, value): the last average of a minute that is not null, from the values ``v`` of its last instant.

    The minutes between are the same for all instants of a minute. Where they hold a
    price, every instant has an average; where not, those that find one themselves.
    """
    chosen = f"IF(_mid_count > 0, {v}.every, {v}.sure)"
    total = exact.added({m: F.expr(f"{chosen}.{m}") for m in exact.MEASURES}, measured("_mid_"))
    us = F.expr(f"{chosen}.us")
    return F.when(us.isNotNull(), F.struct(us.alias("us"), exact.mean(total).alias("value")))


def _left_behind(
    ends: DataFrame, trades: DataFrame, quotes: DataFrame, width: int, calendar: str
) -> DataFrame:
    """Per minute what the index needs from other minutes, from the last values of each minute.

    ``_mid_<measure>``: the whole minutes between the ends of a frame; ``_carry_price``
    and ``_carry_mean`` (us, value); ``_seed`` (us, price, mean): the prior day's last trade.
    """
    # Two rows per minute and exchange at most: bounded by the calendar, however many trades a symbol has.
    near = ends.withColumn("_symbol", group_key(["_day.stock_symbol"])).repartition("_symbol")
    rows = near.groupBy("_symbol", "_day", "_x", "_slice").agg(F.max("_end").alias("_end")).select(
        "*", F.expr("datediff(_day.trade_dt, DATE'1970-01-01') AS _number"),
        *[F.col(f"_end.own.{m}").alias(f"_{m}") for m in exact.MEASURES],
    )
    if width > MINUTE:
        middles = between(["_symbol", "_day"], width, MINUTE)
    else:
        middles = {m: F.lit(None).cast(kind) for m, kind in zip(exact.MEASURES, (exact.SUM, "double", "bigint"))}
    rows = rows.withColumns({f"_mid_{m}": e for m, e in middles.items()})
    rows = rows.withColumns({
        "_mean": _last_mean("_end"), "_close_mean": exact.mean(_total("_end.close")),
    })
    before = Window.partitionBy("_symbol", "_day", "_x").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    days_before = Window.partitionBy("_symbol", "_x").orderBy("_number").rangeBetween(Window.unboundedPreceding, -1)
    last = F.expr(
        "IF(_end IS NULL, NULL, struct(_day.trade_dt AS date, _end.close.us, _end.close.seq, _end.close.price, _close_mean AS mean))"
    )
    rows = rows.select(
        "_day", "_x", "_slice", *[f"_mid_{m}" for m in exact.MEASURES],
        F.last("_end.price", ignorenulls=True).over(before).alias("_carry_price"),
        F.last("_mean", ignorenulls=True).over(before).alias("_carry_mean"),
        F.max(last).over(days_before).alias("_earlier"),
    )
    if calendar == "calendar":
        prior = "date_sub(_day.trade_dt, 1)"
    elif calendar == "trading":
        prior = "_prior"
        # One row per calendar day.
        days = next_dates(quotes.select("trade_dt").distinct(), trades.select("trade_dt").distinct())
        days = days.select(F.col("trade_dt").alias("_date"), F.col("prior_dt").alias("_prior"))
        rows = rows.join(F.broadcast(days), F.expr("_day.trade_dt = _date"), "left").drop("_date")
    else:
        raise ValueError(f"unknown calendar {calendar!r}")
    return rows.withColumn("_seed", F.expr(f"IF(_earlier.date = {prior}, _earlier, NULL)")).drop("_earlier", "_prior")


def enrich_quotes(
    trades: DataFrame,
    quotes: DataFrame,
    minutes: int = 180,
    inclusive: bool = True,
    calendar: str = "calendar",
) -> DataFrame:
    """Each quote with last trade price, its moving average, prior close and movement.

    Any number of dates is handled in one pass. Equals ``enrich_averaged`` over the
    trades' ``moving_average``; averages are worked out where a quote asks for them, and
    each quote meets the trades in one join.
    """
    index = trade_index(trades, quotes, minutes, calendar)
    asked = timed(quotes, "latest_quote").withColumns({
        "_day": group_key(SYMBOL_DAY), "_x": group_key(["stock_exchange"]),
        "_seen": F.col("_us") - (0 if inclusive else 1),
    })
    found = look_up(asked, index, ["_day", "_x"]).withColumns({
        "_price": F.expr("coalesce(_found.price, _carry_price)"),
        "_average": F.coalesce(_last_mean("_found"), "_carry_mean"),
    })

    def latest(own: str, seeded: str) -> Column:
        """The value of the minutes, or the carried-in trade's where that is later or the only one."""
        return F.expr(
            f"IF(_seed.us <= _seen AND ({own}.us IS NULL OR _seed.us > {own}.us) AND _seed.{seeded} IS NOT NULL, "
            f"_seed.{seeded}, {own}.value)"
        )

    filled = found.withColumnRenamed("latest_quote", "event_tm").withColumns({
        "rec_type": F.lit(QUOTE_TYPE),
        "last_trade_price": latest("_price", "price"),
        "last_mov_avg_price": latest("_average", "mean"),
        "close_pr": F.col("_seed.price"),
    })
    return with_movement(filled).select(*ENRICHED.names)
