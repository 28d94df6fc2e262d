import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rows import DAY1, DAY2, DAY4, quote, quotes, trade, trades
from tickloom.operators import asof, enrich, moving
from tickloom.schema import ENRICHED, INSTRUMENT_DAY, TIMELINE


def sample(spark):
    t = [
        trade(DAY1, "15:0", 8.0, 1), trade(DAY2, "10:0", 10.0, 3), trade(DAY2, "12:0", 14.0, 4),
        trade(DAY2, "16:0", 20.0, 6),
    ]
    q = [
        quote(DAY2, "9:0", 9.0, 2), quote(DAY2, "12:0", 9.0, 5), quote(DAY2, "16:30", 9.0, 7),
        quote(DAY4, "9:0", 9.0, 8),
    ]
    return trades(spark, t), quotes(spark, q)


@pytest.mark.parametrize("calendar", ["calendar", "trading"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_worked_sample(spark, calendar, inclusive):
    out = enrich.enrich_quotes(
        *sample(spark), inclusive=inclusive, calendar=calendar
    )
    assert out.columns == ENRICHED.names
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in ENRICHED.fields]
    got = {
        r.event_seq_nb: (r.last_trade_price, r.last_mov_avg_price, r.close_pr, r.bid_move)
        for r in out.collect()
    }
    carried = (20.0, 20.0, 20.0, -11.0) if calendar == "trading" else (None,) * 4
    assert got == {
        2: (8.0, 8.0, 8.0, 1.0),
        5: (14.0, 12.0, 8.0, 1.0) if inclusive else (10.0, 10.0, 8.0, 1.0),
        7: (20.0, 20.0, 8.0, 1.0),
        8: carried,
    }


def random_feed(seed, n=240):
    rng = random.Random(seed)
    t, q = [], []
    for i in range(n):
        symbol, exchange = ("HOT", "X") if rng.random() < 0.5 else (
            rng.choice(["A", None]), rng.choice(["X", "Y"]))
        time = f"{rng.choice([9, 10])}:{rng.randrange(4)}:{rng.randrange(3)}"
        day = rng.choice([DAY1, DAY2])
        if rng.random() < 0.4:
            price = None if rng.random() < 0.3 else float(rng.randrange(50))
            t.append(trade(day, time, price, i, symbol, exchange))
        else:
            q.append(quote(day, time, 1.0, i, symbol, exchange))
    return t, q


def brute_last(t, q, inclusive):
    """Price of the last priced trade for each quote, as the definition says."""
    out = {}
    for r in q:
        seen = [
            s for s in t
            if s[7] is not None and (s[0], s[2], s[3]) == (r[0], r[2], r[3])
            and (s[4] < r[4] or (inclusive and s[4] == r[4]))
        ]
        out[r[5]] = max(seen, key=lambda s: (s[4], s[5]))[7] if seen else None
    return out


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("seed", [1])
def test_against_brute_force(spark, seed, inclusive):
    t, q = random_feed(seed)
    averaged = moving.moving_average(trades(spark, t))
    out = asof.asof_last_trade(
        averaged, quotes(spark, q), inclusive=inclusive
    ).collect()
    assert {r.event_seq_nb: r.last_trade_price for r in out} == brute_last(t, q, inclusive)
    assert len(out) == len(q)


@pytest.mark.parametrize("inclusive", [True, False])
def test_fill_equals_a_plain_window(spark, inclusive):
    t, q = random_feed(7)
    averaged = moving.moving_average(trades(spark, t))
    timeline = asof.merged_timeline(averaged, quotes(spark, q))
    kind = F.desc("rec_type") if inclusive else F.asc("rec_type")
    order = Window.partitionBy(*INSTRUMENT_DAY).orderBy(
        "event_tm", kind, F.col("trade_pr").isNotNull(), "event_seq_nb"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = timeline.withColumns({
        out: F.last(c, ignorenulls=True).over(order) for c, out in asof.FILLED.items()
    })
    quote = lambda df: sorted(map(str, df.where("rec_type = 'Q'").drop("last_mov_avg_price").collect()))
    filled = asof.forward_fill(timeline, inclusive=inclusive)
    assert quote(filled) == quote(plain)
    assert filled.count() == plain.count()
    joined = asof.asof_last_trade(averaged, quotes(spark, q), inclusive=inclusive)
    assert sorted(map(str, joined.collect())) == sorted(
        map(str, filled.where("rec_type = 'Q'").drop(*asof.FILLED).select(*joined.columns).collect())
    )


def test_row_order_and_partitions_do_not_matter(spark):
    t, q = random_feed(4)
    one = enrich.enrich_quotes(trades(spark, t).coalesce(1), quotes(spark, q).coalesce(1))
    two = enrich.enrich_quotes(
        trades(spark, t[::-1]).repartition(5), quotes(spark, q[::-1]).repartition(6)
    )
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_two_trades_at_the_last_instant(spark):
    t = [trade(DAY1, "15:0", 8.0, 2), trade(DAY1, "15:0", 9.0, 1), trade(DAY1, "15:0", 7.0, 3)]
    averaged = moving.moving_average(trades(spark, t))
    q = quotes(spark, [quote(DAY1, "16:0", 1.0, 4), quote(DAY2, "9:0", 1.0, 5)])
    seeds = enrich.carried_trades(averaged, q)
    assert seeds.count() == 1
    out = asof.asof_last_trade(averaged, q, seeds).collect()
    assert {r.event_seq_nb: r.last_trade_price for r in out} == {4: 7.0, 5: 7.0}


def test_symbol_without_trades_and_exchanges_kept_apart(spark):
    t = [trade(DAY2, "9:0", 5.0, 1, exchange="X"), trade(DAY2, "9:30", 7.0, 2, exchange="Y")]
    q = [
        quote(DAY2, "10:0", 1.0, 3, exchange="X"), quote(DAY2, "10:0", 1.0, 4, exchange="Y"),
        quote(DAY2, "10:0", 1.0, 5, symbol="B"),
    ]
    out = enrich.enrich_quotes(trades(spark, t), quotes(spark, q)).collect()
    got = {r.event_seq_nb: (r.last_trade_price, r.last_mov_avg_price) for r in out}
    assert got == {3: (5.0, 5.0), 4: (7.0, 6.0), 5: (None, None)}


def test_empty_sides(spark):
    t, q = sample(spark)
    none_t, none_q = trades(spark, []), quotes(spark, [])
    assert enrich.enrich_quotes(t, none_q).count() == 0
    out = enrich.enrich_quotes(none_t, q)
    assert out.count() == 4
    assert out.where(F.coalesce("last_trade_price", "close_pr").isNotNull()).count() == 0


def test_event_time_on_the_day_before_its_trade_date(spark):
    t = [trade(DAY2, "23:0", 5.0, 1, time_day=DAY1)]
    out = enrich.enrich_quotes(trades(spark, t), quotes(spark, [quote(DAY2, "9:0", 1.0, 2)]))
    assert out.collect()[0].last_trade_price == 5.0


def test_timeline_shape(spark):
    t, q = sample(spark)
    averaged = moving.moving_average(t)
    line = asof.merged_timeline(averaged, q, enrich.carried_trades(averaged, q))
    assert line.columns == TIMELINE.names
    assert [f.dataType for f in line.schema.fields] == [f.dataType for f in TIMELINE.fields]
    assert line.count() == 4 + 4 + 2


def test_a_fill_needs_the_sequence(spark):
    t, q = sample(spark)
    line = asof.merged_timeline(moving.moving_average(t), q).drop("event_seq_nb")
    with pytest.raises(Exception):
        asof.forward_fill(line).collect()
