import datetime as dt

import pytest

from rows import DAY1, DAY2
from tickloom.plans import audit
from tickloom.plans.pipeline import (
    PipelineConfig,
    affected_dates,
    read_audit,
    read_quarantine,
    run_pipeline,
)

TRADE = "{day},{day} {arrive}.0,T,{symbol},{day} {time}.0,{seq},NYSE,{price}"
QUOTE = "{day},{day} {arrive}.0,Q,{symbol},{day} {time}.0,{seq},NYSE,{price},10,{price}9,20"


def line(form, day, time, seq, price, symbol="A", arrive="17:00:00"):
    return form.format(day=day, time=time, seq=seq, price=price, symbol=symbol, arrive=arrive)


def write(root, day, lines):
    folder = root / "csv" / str(day) / "NYSE"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "feed.txt").write_text("\n".join(lines) + "\n")
    return f"{root}/csv/{day}/NYSE/*.txt"


def feeds(root):
    one = write(root, DAY1, [
        line(TRADE, DAY1, "15:00:00", 1, "8.0"), line(QUOTE, DAY1, "16:00:00", 2, "7.5"), "bad",
    ])
    two = write(root, DAY2, [
        line(QUOTE, DAY2, "09:00:00", 1, "9.0"), line(TRADE, DAY2, "10:00:00", 2, "10.0"),
        line(QUOTE, DAY2, "12:00:00", 3, "9.5"), line("X,{day}", DAY2, "", 0, ""),
    ])
    return one, two


def values(df):
    rows = df.orderBy("trade_dt", "event_tm").collect()
    return [(r.trade_dt, r.event_seq_nb, r.last_trade_price, r.close_pr, r.bid_move) for r in rows]


EXPECTED_1 = [(DAY1, 2, 8.0, None, None)]
EXPECTED_2 = [(DAY2, 1, 8.0, 8.0, 1.0), (DAY2, 3, 10.0, 8.0, 1.5)]


@pytest.mark.parametrize("preset", ["reference", "latest_arrival"])
def test_two_dates_at_once_and_again(spark, tmp_path, preset):
    conf = PipelineConfig(
        str(tmp_path / "out"), csv_globs=list(feeds(tmp_path)), batch_id="b1", preset=preset,
    )
    for _ in range(2 if preset == "reference" else 1):
        assert values(run_pipeline(spark, conf)) == EXPECTED_1 + EXPECTED_2
    assert read_quarantine(spark, conf).count() == 2
    counts = read_audit(spark, conf).groupBy("partition").sum("row_count").collect()
    assert {r["partition"]: r["sum(row_count)"] for r in counts} == {"T": 2, "Q": 3, "B": 2}
    log = spark.read.parquet(conf.table("job_status"))
    assert audit.job_status(log, "b1").first().status == audit.SUCCESS


def test_a_later_batch_sees_the_day_before(spark, tmp_path):
    one, two = feeds(tmp_path)
    out = str(tmp_path / "out")
    first = run_pipeline(spark, PipelineConfig(out, csv_globs=[one], batch_id="1"))
    assert values(first) == EXPECTED_1
    for calendar in ("calendar", "trading"):
        conf = PipelineConfig(out, csv_globs=[two], batch_id="2", calendar=calendar)
        assert values(run_pipeline(spark, conf)) == EXPECTED_2
    assert values(spark.read.parquet(f"{out}/enriched")) == EXPECTED_1 + EXPECTED_2


def test_only_bad_lines(spark, tmp_path):
    glob = write(tmp_path, DAY1, ["bad", "worse"])
    conf = PipelineConfig(str(tmp_path / "out"), csv_globs=[glob], batch_id="1")
    assert run_pipeline(spark, conf).count() == 0
    assert read_quarantine(spark, conf).count() == 2


def test_a_failing_step_is_logged_and_raised(spark, tmp_path):
    conf = PipelineConfig(
        str(tmp_path / "out"), csv_globs=[f"{tmp_path}/nothing/*.txt"], batch_id="1"
    )
    with pytest.raises(Exception):
        run_pipeline(spark, conf)
    log = spark.read.parquet(conf.table("job_status"))
    assert audit.job_status(log, "1").first().status == audit.FAILED
    assert log.where("trade_date IS NULL").count() == 0


def latest(spark, conf):
    log = spark.read.parquet(conf.table("job_status"))
    return {r.trade_date: r.status for r in audit.latest_status(log).collect()}


@pytest.mark.parametrize("preset", ["reference", "latest_arrival"])
def test_a_second_batch_of_a_date_adds_to_the_first(spark, tmp_path, preset):
    out = str(tmp_path / "out")
    one = write(tmp_path / "1", DAY1, [
        line(TRADE, DAY1, "10:00:00", 1, "8.0"), line(QUOTE, DAY1, "11:00:00", 2, "7.5"),
        line(TRADE, DAY1, "12:00:00", 3, "9.0"), line(QUOTE, DAY1, "13:00:00", 4, "7.5"),
    ])
    two = write(tmp_path / "2", DAY1, [line(TRADE, DAY1, "12:00:00", 3, "9.5", arrive="18:00:00")])
    run_pipeline(spark, PipelineConfig(out, csv_globs=[one], batch_id="1", preset=preset))
    conf = PipelineConfig(out, csv_globs=[two], batch_id="2", preset=preset)
    got = values(run_pipeline(spark, conf))
    seen = 9.5 if preset == "latest_arrival" else got[1][2]
    assert [g[:3] for g in got] == [(DAY1, 2, 8.0), (DAY1, 4, seen)] and seen in (9.0, 9.5)
    trades = spark.read.parquet(f"{out}/trade")
    assert trades.count() == (2 if preset == "latest_arrival" else 3)
    assert set(latest(spark, conf).values()) == {audit.SUCCESS}


def test_a_changed_close_reaches_the_next_date(spark, tmp_path):
    out, (one, two) = str(tmp_path / "out"), feeds(tmp_path)
    run_pipeline(spark, PipelineConfig(out, csv_globs=[one, two], batch_id="1"))
    late = write(tmp_path / "late", DAY1, [line(TRADE, DAY1, "15:30:00", 9, "6.0")])
    for calendar in ("calendar", "trading"):
        conf = PipelineConfig(out, csv_globs=[late], batch_id="2", calendar=calendar)
        got = values(run_pipeline(spark, conf))
        assert got == [(DAY1, 2, 6.0, None, None), (DAY2, 1, 6.0, 6.0, 3.0), (DAY2, 3, 10.0, 6.0, 3.5)]


def test_a_file_delivered_twice_counts_once(spark, tmp_path):
    out, globs = str(tmp_path / "out"), list(feeds(tmp_path))
    for batch in ("1", "2"):
        got = run_pipeline(spark, PipelineConfig(out, csv_globs=globs, batch_id=batch))
        assert values(got) == EXPECTED_1 + EXPECTED_2
    assert spark.read.parquet(f"{out}/trade").count() == 2


def test_a_date_that_loses_its_rows_ends_empty(spark, tmp_path):
    out, (one, two) = str(tmp_path / "out"), feeds(tmp_path)
    run_pipeline(spark, PipelineConfig(out, csv_globs=[one, two], batch_id="1"))
    run_pipeline(spark, PipelineConfig(out, csv_globs=[two], batch_id="1"))
    got = values(spark.read.parquet(f"{out}/enriched"))
    assert got == [(DAY2, 1, None, None, None), (DAY2, 3, 10.0, None, None)]
    assert spark.read.parquet(f"{out}/trade").where(f"trade_dt = '{DAY1}'").count() == 0


def test_dates_that_see_a_changed_date():
    a, b, c, d = (dt.date(2024, 1, n) for n in (5, 8, 9, 10))
    assert affected_dates([a], [a, b], [a, b, c], "trading") == [a, b]
    assert affected_dates([b], [a, c], [a, b, c, d], "trading") == [b, c]
    assert affected_dates([b], [a, b, c], [a, b, c, d], "calendar") == [b, c]
    assert affected_dates([a], [a], [c, d], "trading") == [a, c, d]
