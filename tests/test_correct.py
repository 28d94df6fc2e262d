import random

import pytest
from pyspark.sql import functions as F

from rows import DAY4, event, events
from tickloom.operators import correct

SAMPLE = [
    event(DAY4, "T", "A", "NYSE", "9:30", 1, "10:0", 10.0),
    event(DAY4, "T", "B", "NASDAQ", "9:30", 1, "10:0", 20.0),
    event(DAY4, "T", "A", "NYSE", "11:0", 2, "12:0", 12.0),
    event(DAY4, "T", "A", "NYSE", "11:0", 2, "13:0", 13.0),
    event(DAY4, "T", "A", "NASDAQ", "15:0", 3, "16:0", 99.0),
]


def prices(df):
    return sorted(r.trade_pr for r in df.collect())


def test_reference_preset_keeps_each_arrival(spark):
    out = correct.load_trades(events(spark, SAMPLE), "reference")
    assert prices(out) == [10.0, 12.0, 13.0, 20.0, 99.0]


def test_latest_arrival_preset_replaces_resends(spark):
    out = correct.load_trades(events(spark, SAMPLE), "latest_arrival")
    assert prices(out) == [10.0, 13.0, 20.0, 99.0]


def test_unknown_preset(spark):
    with pytest.raises(ValueError):
        correct.correct_latest(events(spark, SAMPLE), "other")


def test_time_only_matches_counts_the_mixed_rows(spark):
    out = correct.time_only_matches(events(spark, SAMPLE), "trade_pr").collect()
    assert sum(r.matched_rows for r in out) == 9
    b = next(r for r in out if r.symbol == "B")
    assert (b.matched_rows, b.min_pr, b.max_pr) == (2, 10.0, 20.0)


def test_latest_per_key_with_ties_nulls_and_copies(spark):
    rng = random.Random(5)
    data = []
    for _ in range(300):
        hot = rng.random() < 0.4
        symbol = "HOT" if hot else rng.choice(["A", "B", None])
        seq = 1 if hot else rng.choice([1, 2, 3, None])
        row = event(DAY4, "T", symbol, rng.choice(["X", "Y"]), f"9:{rng.randrange(3)}", seq,
                    "17:0", float(rng.randrange(4)))
        data.append(row)
    best = {}
    for r in data:
        key = (r[0], r[1], r[2], r[6], r[5])
        best[key] = max(best.get(key, r[4]), r[4])
    expected = sorted(str(tuple(r)) for r in data if r[4] == best[(r[0], r[1], r[2], r[6], r[5])])
    out = correct.keep_latest_ties(events(spark, data))
    assert sorted(str(tuple(r)) for r in out.collect()) == expected


def test_one_row_per_key_whatever_the_input_order(spark):
    df = events(spark, SAMPLE * 3)
    one = correct.keep_latest_one(df.repartition(7, F.rand()))
    other = correct.keep_latest_one(df.coalesce(1).orderBy(F.desc("trade_pr")))
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert one.count() == 4


def test_empty_input(spark):
    empty = events(spark, [])
    for preset in ("reference", "latest_arrival"):
        assert correct.load_trades(empty, preset).count() == 0
        assert correct.load_quotes(empty, preset).count() == 0
