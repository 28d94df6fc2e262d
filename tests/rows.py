"""Small hand-made tables."""

from __future__ import annotations

import datetime as dt

from tickloom.schema import EVENT, QUOTE, TRADE

DAY1 = dt.date(2020, 8, 3)
DAY2 = dt.date(2020, 8, 4)
DAY4 = dt.date(2020, 8, 6)


def at(day, text):
    parts = [int(p) for p in text.split(":")]
    return dt.datetime(day.year, day.month, day.day, *parts)


def trade(day, time, price, seq=1, symbol="A", exchange="NYSE", arrival=None, time_day=None):
    when = at(time_day or day, time)
    return (day, "T", symbol, exchange, when, seq, arrival or when, price)


def quote(day, time, bid, seq=1, symbol="A", exchange="NYSE", ask=None):
    when = at(day, time)
    ask = None if bid is None else ask or bid + 1.0
    return (day, "Q", symbol, exchange, when, seq, when, bid, 10, ask, 20)


def event(day, kind, symbol, exchange, time, seq, arrival, price):
    values = (price, None, None, None, None) if kind == "T" else (None, price, 1, price, 1)
    return (day, kind, symbol, exchange, at(day, time), seq, at(day, arrival), *values, kind)


def trades(spark, rows):
    return spark.createDataFrame(rows, TRADE)


def quotes(spark, rows):
    return spark.createDataFrame(rows, QUOTE)


def events(spark, rows):
    return spark.createDataFrame(rows, EVENT)
