import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.schema import EVENT
from tickloom.sources import feeds

HEAD = "2020-08-06,2020-08-06 10:00:00.5,{},A,2020-08-06 09:30:00.123456,7,NYSE"
T_LINE = HEAD.format("T") + ",75.5"
Q_LINE = HEAD.format("Q") + ",75.5,100,76.25,200"

CSV_CASES = [
    (T_LINE, "T", None),
    (Q_LINE, "Q", None),
    (T_LINE + ",extra,fields", "T", None),
    (Q_LINE + ",x", "Q", None),
    ("", "B", feeds.TOO_FEW_FIELDS),
    ("a,b", "B", feeds.TOO_FEW_FIELDS),
    (HEAD.format("T"), "B", feeds.TOO_FEW_FIELDS),
    (HEAD.format("Q") + ",75.5,100,76.25", "B", feeds.TOO_FEW_FIELDS),
    (HEAD.format("X") + ",75.5", "B", feeds.UNKNOWN_TYPE),
    (HEAD.format("t") + ",75.5", "B", feeds.UNKNOWN_TYPE),
    (HEAD.format("T") + ",abc", "B", feeds.BAD_VALUE),
    (HEAD.format("T") + ",", "B", feeds.BAD_VALUE),
    (HEAD.format("T") + ",nan", "B", feeds.BAD_VALUE),
    (HEAD.format("T") + ",inf", "B", feeds.BAD_VALUE),
    (HEAD.format("T") + ",1e50", "B", feeds.BAD_VALUE),
    (HEAD.format("T") + ",1.5f", "B", feeds.BAD_VALUE),
    (HEAD.format("T") + ",1e2", "T", None),
    (HEAD.format("T") + ", 7.5 ", "T", None),
    (HEAD.format("Q") + ",75.5,1.5,76.25,200", "B", feeds.BAD_VALUE),
    (HEAD.format("Q") + ",75.5,1_000,76.25,200", "B", feeds.BAD_VALUE),
    (HEAD.format("Q") + ",75.5,99999999999,76.25,200", "B", feeds.BAD_VALUE),
    (T_LINE.replace("2020-08-06,", "2020-8-6,", 1), "B", feeds.BAD_VALUE),
    (T_LINE.replace("2020-08-06,", "2020-02-30,", 1), "B", feeds.BAD_VALUE),
    (T_LINE.replace("09:30:00.123456", "09:30:00"), "B", feeds.BAD_VALUE),
    (T_LINE.replace("09:30:00.123456", "09:30:00.1234567"), "B", feeds.BAD_VALUE),
]

J_HEAD = (
    '{"event_type":"%s","trade_dt":"2020-08-06","symbol":"A","exchange":"NASDAQ",'
    '"event_tm":"2020-08-06 09:30:00.5","event_seq_nb":7,"file_tm":"2020-08-06 10:00:00.0"'
)
J_T = J_HEAD % "T" + ',"price":75.5}'
J_Q = J_HEAD % "Q" + ',"bid_pr":75.5,"bid_size":100,"ask_pr":76.25,"ask_size":200}'

JSON_CASES = [
    (J_T, "T", None),
    (J_Q, "Q", None),
    (J_T.replace("75.5", "75"), "T", None),
    (J_T.replace("}", ',"more":{"a":[1]}}'), "T", None),
    ("", "B", feeds.BAD_JSON),
    ("5", "B", feeds.BAD_JSON),
    ("null", "B", feeds.BAD_JSON),
    ("[" + J_T + "]", "B", feeds.BAD_JSON),
    (J_T + " tail", "B", feeds.BAD_JSON),
    (J_T + "," + J_T, "B", feeds.BAD_JSON),
    (J_T + J_T, "B", feeds.BAD_JSON),
    (J_T[:-1], "B", feeds.BAD_JSON),
    (J_T.replace('"', "'"), "B", feeds.BAD_JSON),
    (J_T.replace('"event_type":"T",', ""), "B", feeds.BAD_JSON),
    (J_T.replace('"T"', '"X"'), "B", feeds.UNKNOWN_TYPE),
    (J_T.replace(',"price":75.5', ""), "B", feeds.MISSING_FIELD),
    (J_T.replace('"exchange":"NASDAQ",', ""), "B", feeds.MISSING_FIELD),
    (J_Q.replace(',"ask_size":200', ""), "B", feeds.MISSING_FIELD),
    (J_T.replace("75.5", '"abc"'), "B", feeds.BAD_VALUE),
    (J_T.replace("75.5", '"75.5"'), "B", feeds.BAD_VALUE),
    (J_T.replace("75.5", "NaN"), "B", feeds.BAD_VALUE),
    (J_T.replace("75.5", "1e50"), "B", feeds.BAD_VALUE),
    (J_T.replace(":7,", ":7.5,"), "B", feeds.BAD_VALUE),
    (J_T.replace(":7,", ":99999999999,"), "B", feeds.BAD_VALUE),
    (J_T.replace('09:30:00.5"', '09:30:00"'), "B", feeds.BAD_VALUE),
    (J_T.replace('"trade_dt":"2020-08-06"', '"trade_dt":null'), "B", feeds.BAD_VALUE),
    # JSON null is a value where the event table allows one.
    (J_T.replace("75.5", "null"), "T", None),
    (J_Q.replace("100", "null"), "Q", None),
    (J_T.replace('"symbol":"A"', '"symbol":null'), "T", None),
    # A trade's other keys do not matter.
    (J_T.replace("}", ',"bid_pr":"abc"}'), "T", None),
]


def lines(spark, cases):
    return spark.createDataFrame([(c[0],) for c in cases], "value string").coalesce(1)


@pytest.mark.parametrize("parse, cases", [
    (feeds.parse_csv_feed, CSV_CASES), (feeds.parse_json_feed, JSON_CASES),
])
def test_routing(spark, parse, cases):
    rows = parse(lines(spark, cases)).collect()
    got = [(r.partition, r["_reason"]) for r in rows]
    wrong = [(c, g) for c, g in zip(cases, got, strict=True) if (c[1], c[2]) != g]
    assert wrong == []
    for case, row in zip(cases, rows):
        if row.partition == "B":
            assert row["_raw"] == case[0]
            assert all(row[name] is None for name in EVENT.names if name != "partition")
        else:
            assert row["_raw"] is None and row.rec_type == row.partition


def test_csv_values(spark):
    t, q = feeds.parse_csv_feed(lines(spark, CSV_CASES[:2])).collect()
    common = (
        dt.date(2020, 8, 6), "A", "NYSE", dt.datetime(2020, 8, 6, 9, 30, 0, 123456), 7,
        dt.datetime(2020, 8, 6, 10, 0, 0, 500000),
    )
    for row in (t, q):
        assert (row.trade_dt, row.symbol, row.exchange, row.event_tm, row.event_seq_nb,
                row.arrival_tm) == common
    assert (t.trade_pr, t.bid_pr, t.bid_size, t.ask_pr, t.ask_size) == (75.5, None, None, None, None)
    assert (q.trade_pr, q.bid_pr, q.bid_size, q.ask_pr, q.ask_size) == (None, 75.5, 100, 76.25, 200)


def test_json_values(spark):
    t, q, whole = feeds.parse_json_feed(lines(spark, JSON_CASES[:3])).collect()
    assert (t.trade_pr, t.event_tm) == (75.5, dt.datetime(2020, 8, 6, 9, 30, 0, 500000))
    assert (q.bid_pr, q.bid_size, q.ask_pr, q.ask_size, q.trade_pr) == (75.5, 100, 76.25, 200, None)
    assert whole.trade_pr == 75.0


def test_schema(spark):
    out = feeds.parse_csv_feed(lines(spark, CSV_CASES))
    assert out.columns == [*EVENT.names, "_raw", "_reason"]
    assert [f.dataType for f in out.schema.fields[:13]] == [f.dataType for f in EVENT.fields]


def test_every_line_is_kept(spark):
    both = feeds.union_feeds(
        feeds.parse_csv_feed(lines(spark, CSV_CASES)),
        feeds.parse_json_feed(lines(spark, JSON_CASES)),
    )
    total = len(CSV_CASES) + len(JSON_CASES)
    good, bad = feeds.accepted(both).count(), feeds.quarantined(both).count()
    assert (both.count(), good + bad) == (total, total)
    assert bad == sum(c[1] == "B" for c in CSV_CASES + JSON_CASES)


def test_reading_serialised_events_again_changes_nothing(spark):
    first = feeds.accepted(feeds.parse_csv_feed(lines(spark, CSV_CASES)))
    micros = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    fields = [
        F.date_format("trade_dt", "yyyy-MM-dd"), F.date_format("arrival_tm", micros),
        F.col("rec_type"), F.col("symbol"), F.date_format("event_tm", micros),
        F.col("event_seq_nb"), F.col("exchange"), F.coalesce("trade_pr", "bid_pr"),
        F.col("bid_size"), F.col("ask_pr"), F.col("ask_size"),
    ]
    text = first.select(F.concat_ws(",", *[f.cast("string") for f in fields]).alias("value"))
    again = feeds.accepted(feeds.parse_csv_feed(text))
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))


def test_parse_holds_without_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        test_routing(spark, feeds.parse_csv_feed, CSV_CASES)
        test_routing(spark, feeds.parse_json_feed, JSON_CASES)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_ingest_reads_all_globs(spark, tmp_path):
    for day in ("2020-08-05", "2020-08-06"):
        (tmp_path / "csv" / day / "NYSE").mkdir(parents=True)
        (tmp_path / "csv" / day / "NYSE" / "a.txt").write_text(f"{T_LINE}\n{Q_LINE}\nbad\n")
        (tmp_path / "json" / day / "NASDAQ").mkdir(parents=True)
        (tmp_path / "json" / day / "NASDAQ" / "b.txt").write_text(f"{J_T}\n{{\n")
    globs = [f"{tmp_path}/csv/*/NYSE/*.txt"], [f"{tmp_path}/json/*/NASDAQ/*.txt"]
    counts = feeds.ingest(spark, *globs).groupBy("partition").count().collect()
    assert {r.partition: r["count"] for r in counts} == {"T": 4, "Q": 2, "B": 4}
    with pytest.raises(ValueError):
        feeds.ingest(spark)
