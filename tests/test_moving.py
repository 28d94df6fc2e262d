import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rows import DAY1, DAY2, trade, trades
from tickloom.operators import moving


def brute(rows, minutes):
    out = []
    for r in rows:
        frame = [
            s[7] for s in rows
            if (s[0], s[2]) == (r[0], r[2]) and s[7] is not None
            and r[4] - dt.timedelta(minutes=minutes) <= s[4] <= r[4]
        ]
        average = sum(frame) / len(frame) if frame else None
        out.append((*r, average))
    return sorted(out, key=str)


def same(got, expected):
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:-1] == b[:-1]
        assert a[-1] == b[-1] or a[-1] == pytest.approx(b[-1], rel=1e-12)


def random_trades(seed, n=250):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        symbol = "HOT" if rng.random() < 0.5 else rng.choice(["A", None])
        minute = rng.choice([rng.randrange(24 * 60), 600 + rng.randrange(4)])
        time = f"{minute // 60}:{minute % 60}:{rng.choice([0, 0, 30])}"
        price = None if rng.random() < 0.1 else rng.randrange(1, 1000) / 8
        day = rng.choice([DAY1, DAY2, dt.date(1969, 12, 31)])
        rows.append(trade(day, time, price, i, symbol, rng.choice(["X", "Y"])))
    return rows


@pytest.mark.parametrize("minutes", [1, 180, 2000])
def test_against_brute_force(spark, minutes):
    rows = random_trades(minutes)
    out = moving.moving_average(trades(spark, rows), minutes)
    same(sorted((tuple(r) for r in out.collect()), key=str), brute(rows, minutes))


def test_times_without_zone(spark):
    rows = random_trades(9)
    df = trades(spark, rows)
    plain = df.withColumn("latest_trade", F.col("latest_trade").cast("timestamp_ntz"))
    out = moving.moving_average(plain, 180)
    same(sorted((tuple(r) for r in out.collect()), key=str), brute(rows, 180))


def test_frame_edges_are_included(spark):
    rows = [trade(DAY2, "9:0", 8.0, 1), trade(DAY2, "12:0", 16.0, 2), trade(DAY2, "12:0:1", 32.0, 3)]
    out = moving.moving_average(trades(spark, rows), 180)
    assert {r.event_seq_nb: r.mov_avg_pr for r in out.collect()} == {1: 8.0, 2: 12.0, 3: 24.0}


def test_average_is_shared_by_exchanges_and_split_by_day(spark):
    rows = [
        trade(DAY1, "23:59", 100.0, 1), trade(DAY2, "0:1", 2.0, 2, exchange="X"),
        trade(DAY2, "0:2", 4.0, 3, exchange="Y"), trade(DAY2, "0:2", 60.0, 4, symbol="B"),
    ]
    out = moving.moving_average(trades(spark, rows)).collect()
    assert {r.event_seq_nb: r.mov_avg_pr for r in out} == {1: 100.0, 2: 2.0, 3: 3.0, 4: 60.0}


def test_width_must_be_positive(spark):
    with pytest.raises(ValueError):
        moving.moving_average(trades(spark, []), 0)


def test_empty(spark):
    assert moving.moving_average(trades(spark, [])).count() == 0


def test_last_average_of_the_range_is_the_rows_own(spark):
    averaged = moving.moving_average(trades(spark, random_trades(3)))
    out = moving.last_value_range(averaged, "mov_avg_pr", out="last_mov")
    assert out.where(~F.col("mov_avg_pr").eqNullSafe(F.col("last_mov"))).count() == 0
    assert out.count() == averaged.count()


def test_last_value_of_the_range_respects_nulls(spark):
    rows = [trade(DAY2, "9:0", 5.0, 1), trade(DAY2, "9:0", None, 2), trade(DAY2, "9:1", 6.0, 3)]
    out = moving.last_value_range(trades(spark, rows), "trade_pr").collect()
    assert {r.event_seq_nb: r.last_value for r in out} == {1: None, 2: None, 3: 6.0}


def test_last_value_beside_the_average(spark):
    rows = random_trades(6)
    df = trades(spark, rows)
    out = moving.moving_average(df, last={"last_value": "trade_pr", "last_mov": "mov_avg_pr"})
    other = moving.last_value_range(moving.moving_average(df), "trade_pr")
    assert sorted(map(str, out.drop("last_mov").select(*other.columns).collect())) == sorted(
        map(str, other.collect())
    )
    assert out.where(~F.col("mov_avg_pr").eqNullSafe(F.col("last_mov"))).count() == 0
