import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rows import DAY1, DAY2, DAY4, quote, quotes, trade, trades
from tickloom.operators import close, order


def sample(spark):
    return trades(spark, [
        trade(DAY1, "15:0", 8.0, 1), trade(DAY1, "16:0", 9.0, 2), trade(DAY1, "16:0", 7.0, 3),
        trade(DAY1, "10:0", 5.0, 4, exchange="X"), trade(DAY2, "10:0", 6.0, 5, symbol="B"),
    ])


def test_close_is_one_row_per_instrument_under_the_next_date(spark):
    rows = close.prior_day_close(sample(spark)).collect()
    got = {(r.trade_dt, r.stock_symbol, r.stock_exchange): r.trade_pr for r in rows}
    assert got == {
        (DAY2, "A", "NYSE"): 7.0, (DAY2, "A", "X"): 5.0,
        (DAY2 + dt.timedelta(days=1), "B", "NYSE"): 6.0,
    }


def test_trading_calendar_skips_days_without_trades(spark):
    dates = quotes(spark, [quote(DAY2, "9:0", 1.0), quote(DAY4, "9:0", 1.0)])
    rows = close.prior_day_close(sample(spark), "trading", dates).collect()
    got = {(r.trade_dt, r.stock_symbol, r.stock_exchange): r.trade_pr for r in rows}
    assert got == {
        (DAY2, "A", "NYSE"): 7.0, (DAY2, "A", "X"): 5.0, (DAY4, "B", "NYSE"): 6.0,
    }
    with pytest.raises(ValueError):
        close.prior_day_close(sample(spark), "lunar")


def test_movement(spark):
    q = quotes(spark, [quote(DAY2, "9:0", 9.0, 1), quote(DAY2, "9:0", 9.0, 2, symbol="C"),
                       quote(DAY2, "9:1", None, 3)])
    rows = close.price_movement(q, close.prior_day_close(sample(spark))).collect()
    got = {r.event_seq_nb: (r.close_pr, r.bid_move, r.ask_move) for r in rows}
    assert got == {1: (7.0, 2.0, 3.0), 2: (None, None, None), 3: (7.0, None, None)}


def test_ranks(spark):
    rng = random.Random(2)
    rows = [
        trade(DAY1, f"9:{rng.randrange(5)}:{rng.randrange(3)}", 1.0, i,
              rng.choice(["A", None]), rng.choice(["X", "Y"]))
        for i in range(120)
    ]
    out = close.dense_rank_latest(trades(spark, rows)).collect()
    for r in out:
        times = {s[4] for s in rows if (s[2], s[3]) == (r.stock_symbol, r.stock_exchange)}
        assert r.time_rank == sorted(times, reverse=True).index(r.latest_trade) + 1
    assert len(out) == len(rows)


def test_top_rank_keeps_ties(spark):
    rows = close.latest_ranked(sample(spark)).collect()
    assert sorted(r.trade_pr for r in rows) == [5.0, 6.0, 7.0, 9.0]


def test_last_value_of_the_whole_group(spark):
    rows = close.last_value_unbounded(sample(spark)).collect()
    assert {r.event_seq_nb: r.last_trade_pr for r in rows} == {1: 7.0, 2: 7.0, 3: 7.0, 4: 5.0, 5: 6.0}


def test_top_n_and_sort(spark):
    df = sample(spark)
    latest = order.latest_n(df, 2, ["latest_trade", "event_seq_nb"]).collect()
    assert [r.event_seq_nb for r in latest] == [5, 3]
    first = order.first_n(df, 2, ["trade_dt", "stock_symbol", "latest_trade"]).collect()
    assert [r.event_seq_nb for r in first] == [4, 1]
    assert [r.event_seq_nb for r in order.sort_rows(df.repartition(3)).collect()] == [1, 2, 3, 4, 5]
    assert close.instrument_rows(df, "B").count() == 1


def test_null_symbols_form_a_group(spark):
    df = trades(spark, [trade(DAY1, "9:0", 1.0, 1, symbol=None), trade(DAY1, "9:1", 2.0, 2, symbol=None)])
    rows = close.last_value_unbounded(df).collect()
    assert {r.last_trade_pr for r in rows} == {2.0}
    found = close.latest_ranked(df).where(F.col("stock_symbol").isNull())
    assert [r.event_seq_nb for r in found.collect()] == [2]
