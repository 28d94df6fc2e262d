import random

import pytest

from rows import DAY1, DAY2, DAY4, quote, quotes, trade, trades
from tickloom.operators import asof, enrich, minutes, moving
from tickloom.queries import feed


def random_feed(seed, n=300):
    """Busy and idle minutes, shared instants, null prices, times and names, two exchanges."""
    rng = random.Random(seed)
    t, q = [], []
    for i in range(n):
        symbol = "HOT" if rng.random() < 0.6 else rng.choice(["A", None])
        exchange = rng.choice(["X", "X", "Y", None])
        minute = rng.choice([rng.randrange(24 * 60), 600, 601, 779, 780, 781])
        time = f"{minute // 60}:{minute % 60}:{rng.choice([0, 0, 1, 2, rng.randrange(60)])}"
        day = rng.choice([DAY1, DAY2, DAY4])
        if rng.random() < 0.5:
            row = trade(day, time, None if rng.random() < 0.25 else rng.randrange(1, 800) / 8, i, symbol, exchange)
            t.append((*row[:4], None, *row[5:]) if rng.random() < 0.03 else row)
        else:
            row = quote(day, time, 1.0, i, symbol, exchange)
            q.append((*row[:4], None, *row[5:]) if rng.random() < 0.03 else row)
    return t, q


def result(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("width", [1, 3, 64])
@pytest.mark.parametrize("inclusive,calendar,span", [(True, "calendar", 180), (False, "trading", 1)])
def test_enrichment_equals_averages_and_fill(spark, monkeypatch, width, inclusive, calendar, span):
    monkeypatch.setattr(minutes, "WIDTH", width)
    t, q = random_feed(width * 7 + span)
    df, asked = trades(spark, t), quotes(spark, q)
    one = enrich.enrich_quotes(df, asked, span, inclusive, calendar)
    two = enrich.enrich_averaged(moving.moving_average(df, span), asked, inclusive, calendar)
    assert result(one) == result(two)
    assert one.count() == len(q)


@pytest.mark.parametrize("width", [1, 2, 64])
def test_pages_do_not_change_the_fill(spark, monkeypatch, width):
    t, q = random_feed(11)
    line = asof.merged_timeline(moving.moving_average(trades(spark, t)), quotes(spark, q))
    whole = [result(asof.forward_fill(line, inclusive=i)) for i in (True, False)]
    monkeypatch.setattr(minutes, "WIDTH", width)
    assert [result(asof.forward_fill(line, inclusive=i)) for i in (True, False)] == whole


def test_a_busy_minute_has_pages_of_bounded_width(spark, monkeypatch):
    monkeypatch.setattr(minutes, "WIDTH", 4)
    t = [trade(DAY2, f"9:0:{i}", float(i), i) for i in range(23)]
    index = enrich.trade_index(trades(spark, t), quotes(spark, []), 180).collect()
    assert sorted(len(r["_list"]) for r in index) == [3, 4, 4, 4, 4, 4]
    spans = sorted((r["_from"] or 0, r["_to"] or 1 << 62) for r in index)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_enrichment_has_six_exchanges_at_most(spark):
    sf_dir = "/root/testdata/sf0.01"
    df = enrich.enrich_quotes(feed.trades(spark, sf_dir), feed.quotes(spark, sf_dir))
    df.toArrow()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    nodes = [line.lstrip(" :+*-") for line in final.splitlines()]
    assert sum(n.startswith(("Exchange", "BroadcastExchange")) for n in nodes) <= 6
    quotes_scans = [n for n in nodes if "FileScan" in n and "NOT" in n]
    assert len(quotes_scans) == 2  # to mark minutes and to be enriched


@pytest.mark.parametrize("make", [
    lambda t, q: moving.moving_average(t), enrich.enrich_quotes,
])
def test_sums_do_not_depend_on_partitions(spark, make):
    rng = random.Random(5)
    t = [
        trade(DAY2, f"{rng.randrange(24)}:{rng.randrange(60)}:{rng.randrange(60)}", rng.choice([0.1, 3.7e-5, 123456.79, 9e9]) * rng.random(), i)
        for i in range(400)
    ]
    q = [quote(DAY2, f"{rng.randrange(24)}:{rng.randrange(60)}", 1.0, 1000 + i) for i in range(50)]
    found = []
    for n in (3, 211):
        rng.shuffle(t)
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            found.append(result(make(trades(spark, t).repartition(n), quotes(spark, q))))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1]


def test_prices_beyond_decimals_still_count(spark):
    rows = [trade(DAY2, "9:0", 3e30, 1), trade(DAY2, "9:1", 1e30, 2), trade(DAY2, "9:2", 4.0, 3)]
    out = moving.moving_average(trades(spark, rows)).collect()
    assert {r.event_seq_nb: r.mov_avg_pr for r in out} == pytest.approx({1: 3e30, 2: 2e30, 3: 4e30 / 3}, rel=1e-6)
