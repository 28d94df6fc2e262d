"""Runs that copy what has not changed give what runs from scratch give."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rows import DAY1, DAY2, DAY4, quote, quotes, trade, trades
from tickloom.plans import audit, changes
from tickloom.plans.pipeline import (
    PipelineConfig,
    landed_events,
    load_raw,
    read_changes,
    read_totals,
    record_settings,
    run_pipeline,
    settled_dates,
    wanted_dates,
)
from tickloom.schema import ENRICHED
from tickloom.sources import feeds, tables

TRADE = "{day},{day} {arrive}.0,T,{symbol},{day} {time}.0,{seq},{exchange},{price}"
QUOTE = "{day},{day} {arrive}.0,Q,{symbol},{day} {time}.0,{seq},{exchange},{price},10,{price}9,20"


def lines(rng, first, n, arrive, days=(DAY1, DAY2, DAY4), symbols="ABC"):
    out = []
    for i in range(n):
        form = TRADE if rng.random() < 0.5 else QUOTE
        out.append(form.format(
            day=rng.choice(days), arrive=arrive, symbol=rng.choice(symbols), exchange=rng.choice(["X", "Y"]), seq=first + i,
            time=f"{rng.randrange(9, 16):02d}:{rng.randrange(60):02d}:00", price=f"{rng.randrange(100, 900) / 8}"))
    return out


def write(folder, text):
    folder.mkdir(parents=True)
    (folder / "feed.txt").write_text("\n".join(text) + "\n")
    return f"{folder}/*.txt"


def rows(df):
    return sorted(map(str, df.select(*ENRICHED.names).collect()))


@pytest.mark.parametrize("calendar", ["calendar", "trading"])
def test_batches_one_by_one_equal_one_batch(spark, tmp_path, calendar):
    rng = random.Random(len(calendar))
    globs = [
        write(tmp_path / "1", lines(rng, 0, 60, "17:00:00")),
        write(tmp_path / "2", lines(rng, 100, 3, "18:00:00", days=(DAY1,), symbols="A")),
    ]
    step = str(tmp_path / "steps")
    for n, glob in enumerate(globs):
        run_pipeline(spark, PipelineConfig(step, csv_globs=[glob], batch_id=str(n), calendar=calendar))
    whole = PipelineConfig(str(tmp_path / "whole"), csv_globs=globs, batch_id="0", calendar=calendar)
    run_pipeline(spark, whole)
    both = [rows(spark.read.schema(ENRICHED).parquet(f"{root}/enriched")) for root in (step, whole.out_root)]
    assert both[0] == both[1] and len(both[0]) > 20
    last = read_changes(spark, PipelineConfig(step, batch_id="1")).where("batch_id = '1'").collect()
    assert last and {(r.trade_dt, r.stock_symbol) for r in last} == {(DAY1, "A")}


def test_other_settings_and_a_broken_run_leave_nothing_to_copy(spark, tmp_path):
    glob = write(tmp_path / "1", lines(random.Random(3), 0, 40, "17:00:00"))
    out = str(tmp_path / "out")
    conf = PipelineConfig(out, csv_globs=[glob], batch_id="1", minutes=180)
    run_pipeline(spark, conf)
    assert settled_dates(spark, conf) == {DAY1, DAY2, DAY4}
    narrow = PipelineConfig(out, csv_globs=[glob], batch_id="1", minutes=1)
    assert settled_dates(spark, narrow) == set()
    got = rows(run_pipeline(spark, narrow))
    fresh = PipelineConfig(str(tmp_path / "fresh"), csv_globs=[glob], batch_id="1", minutes=1)
    assert got == rows(run_pipeline(spark, fresh))
    broken = PipelineConfig(out, csv_globs=[glob], batch_id="1", minutes=0)
    with pytest.raises(ValueError):
        run_pipeline(spark, broken)
    assert settled_dates(spark, narrow) == set()


def test_differing_groups(spark):
    old = trades(spark, [trade(DAY1, "9:0", 1.0, 1), trade(DAY1, "9:1", 1.0, 2, symbol="B"), trade(DAY2, "9:0", 1.0, 3, symbol=None)])
    new = trades(spark, [trade(DAY1, "9:0", 1.0, 1), trade(DAY1, "9:1", 2.0, 2, symbol="B"), trade(DAY4, "9:0", 1.0, 4)])
    found = changes.differing(changes.digests(old), changes.digests(new)).collect()
    assert {(r.trade_dt, r.stock_symbol) for r in found} == {(DAY1, "B"), (DAY2, None), (DAY4, "A")}
    twice = changes.differing(changes.digests(old), changes.digests(old.union(old.limit(1))))
    assert twice.count() == 1
    assert changes.differing(changes.digests(old), changes.digests(old.repartition(7))).count() == 0


def test_a_file_in_two_globs_is_landed_once(spark, tmp_path):
    glob = write(tmp_path / "odd [name] {x}", lines(random.Random(1), 0, 10, "17:00:00"))
    whole = glob.replace("odd [name] {x}", "odd*")
    conf = PipelineConfig(str(tmp_path / "out"), csv_globs=[whole, whole.replace("*.txt", "f*.txt")], batch_id="1")
    assert load_raw(spark, conf) == []
    totals = read_totals(spark, conf).first()
    assert (totals.row_count, totals.rejected) == (10, 0)
    other = PipelineConfig(conf.out_root, csv_globs=[whole], batch_id="2")
    assert load_raw(spark, other)
    assert {r.batch_id: r.row_count for r in read_totals(spark, conf).collect()} == {"1": 10, "2": 0}
    (tmp_path / "odd [name] {x}" / "feed.txt").write_text("changed\n")
    load_raw(spark, other)
    assert {r.batch_id: r.rejected for r in read_totals(spark, conf).collect()} == {"1": 0, "2": 1}
    one = feeds.read_lines(spark, feeds.exactly(str(tmp_path / "odd [name] {x}" / "feed.txt")), provenance=True).first()
    assert one["_file"].endswith("feed.txt") and one["_file_size"] == 8 and one["_file_time"] is not None


def test_dates_are_pruned_at_run_time(spark, tmp_path):
    glob = write(tmp_path / "1", lines(random.Random(2), 0, 30, "17:00:00"))
    conf = PipelineConfig(str(tmp_path / "out"), csv_globs=[glob], batch_id="1")
    load_raw(spark, conf)
    (days,) = wanted_dates(spark, conf, "test", {"one": [DAY2]})
    df = landed_events(spark, conf, "T", days)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and str(DAY2) not in plan
    assert {r.trade_dt for r in df.collect()} == {DAY2}
    assert re.search(r"dynamicpruning#\d+ \[trade_dt#", df._jdf.queryExecution().optimizedPlan().toString())


def test_the_write_counts_in_one_pass(spark, tmp_path):
    glob = write(tmp_path / "1", [*lines(random.Random(4), 0, 20, "17:00:00"), "bad", "worse"])
    conf = PipelineConfig(str(tmp_path / "out"), csv_globs=[glob], batch_id="1")
    load_raw(spark, conf)
    assert read_totals(spark, conf).first()[:2] == (22, 2)
    counted = spark.read.parquet(conf.table("audit")).agg(F.sum("row_count")).first()[0]
    assert counted == 22


def test_settings_keep_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(audit, "MOST_FILES", 3)
    conf = PipelineConfig(str(tmp_path / "out"), batch_id="1")
    for i in range(9):
        record_settings(spark, conf, [DAY1, DAY2], conf.settings() if i % 2 else "")
        record_settings(spark, conf, [DAY4], conf.settings())
        assert len(tables.data_files(spark, conf.table("settings"))) <= 3
        assert settled_dates(spark, conf) == ({DAY1, DAY2, DAY4} if i % 2 else {DAY4})
