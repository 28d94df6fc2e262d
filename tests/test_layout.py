"""How tables lie on disk, and what that saves."""

import glob
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rows import DAY1, DAY2, DAY4, quote, quotes, trade, trades
from tickloom.operators import asof, moving
from tickloom.queries import feed
from tickloom.sources import tables

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture
def all_partitions(spark):
    """Small as they are, ranges stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_symbol_touches_few_row_groups(spark, tmp_path, all_partitions):
    """Of the files and row groups of all dates together those with the symbol within their bounds."""
    rows = feed.trades(spark, SF_DIR).withColumn("trade_dt", F.lit("2024-01-15").cast("date"))
    tables.write_clustered(rows, str(tmp_path / "sorted"))
    tables.write_by_date(rows.repartition(4), str(tmp_path / "plain"))

    def touched(root, symbol):
        found = groups = 0
        for path in glob.glob(f"{root}/*/*.parquet"):
            meta = pq.read_metadata(path)
            column = meta.schema.names.index("stock_symbol")
            for g in range(meta.num_row_groups):
                bounds = meta.row_group(g).column(column).statistics
                groups += 1
                found += bounds.min <= symbol <= bounds.max
        return found, groups

    found, groups = touched(tmp_path / "sorted", "S7")
    assert groups >= 4 and found <= 2
    assert touched(tmp_path / "plain", "S7")[0] == touched(tmp_path / "plain", "S7")[1]


def test_clustered_dates_are_in_order_over_their_files(spark, tmp_path):
    rows = feed.quotes(spark, SF_DIR)
    tables.write_clustered(rows, str(tmp_path / "t"))
    for day in glob.glob(str(tmp_path / "t/*"))[:5]:
        keys = []
        for path in sorted(glob.glob(f"{day}/*.parquet")):
            part = pq.read_table(path).select(["stock_symbol", "latest_quote", "event_seq_nb"]).to_pylist()
            keys.append([tuple(r.values()) for r in part])
            assert keys[-1] == sorted(keys[-1])
        ends = sorted((k[0], k[-1]) for k in keys if k)
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    tables.write_clustered(rows.where("trade_dt = '2024-01-15'").limit(3), str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.where("trade_dt = '2024-01-15'").count() == 3
    assert back.where("trade_dt <> '2024-01-15'").count() == rows.where("trade_dt <> '2024-01-15'").count()


def test_a_hot_symbol_is_spread_over_files(spark, tmp_path, all_partitions):
    rows = [trade(DAY1, f"9:{i // 60}:{i % 60}", 1.0, i, symbol="HOT" if i % 3 else f"S{i % 5}") for i in range(900)]
    tables.write_clustered(trades(spark, rows), str(tmp_path / "t"))
    sizes = [pq.read_metadata(p).num_rows for p in glob.glob(str(tmp_path / "t/*/*.parquet"))]
    assert sum(sizes) == 900 and max(sizes) < 450


def test_stored_dates_are_not_written_again(spark, tmp_path):
    root = str(tmp_path / "t")
    day = lambda *days: trades(spark, [trade(d, "9:0", 1.0, i) for i, d in enumerate(days)])
    tables.write_once(day(DAY1, DAY2), root)
    with pytest.raises(FileExistsError, match=str(DAY2)):
        tables.write_once(day(DAY2, DAY4), root)
    assert spark.read.parquet(root).count() == 2
    tables.write_once(day(DAY4), root)
    tables.write_once(day(), root)
    assert tables.partition_values(spark, root, "trade_dt") == {str(DAY1), str(DAY2), str(DAY4)}
    assert tables.partition_values(spark, str(tmp_path / "none"), "trade_dt") == set()


def test_bucketed_sides_are_not_shuffled(spark, tmp_path):
    averaged = moving.moving_average(feed.trades(spark, SF_DIR))
    stored = [
        tables.save_co_partitioned(df, f"layout_{name}", f"latest_{name}", 4, str(tmp_path / name))
        for name, df in (("trade", averaged), ("quote", feed.quotes(spark, SF_DIR)))
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = asof.asof_stored(*stored)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [(len(x) - len(x.lstrip(" :+*-")), x.lstrip(" :+*-")) for x in plan.splitlines()]
        scans = [i for i, (_, x) in enumerate(lines) if re.search("FileScan.*layout_(trade|quote)", x)]
        free = 0
        for i in scans:
            assert "Bucketed: true" in lines[i][1]
            above, depth = [], lines[i][0]
            for d, x in reversed(lines[:i]):
                if d < depth:
                    above.append(x)
                    depth = d
            free += not any(x.startswith("Exchange") for x in above)
        # Quotes and the trades' pages reach the result without an exchange; what stands for a minute has one.
        assert free == 2
        other = asof.asof_last_trade(averaged, feed.quotes(spark, SF_DIR))
        assert sorted(map(str, df.collect())) == sorted(map(str, other.select(*df.columns).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE layout_trade")
        spark.sql("DROP TABLE layout_quote")


def test_a_hot_minute_and_rows_without_an_instrument(spark, tmp_path):
    t = [trade(DAY1, "9:0:1", 5.0, 1), trade(DAY1, "9:0:1", 6.0, 2), trade(DAY1, "9:5", 7.0, 3, symbol=None)]
    q = [quote(DAY1, "9:0:1", 1.0, 4), quote(DAY1, "9:30", 1.0, 5), quote(DAY1, "9:30", 1.0, 6, symbol=None), quote(DAY2, "9:0", 1.0, 7)]
    averaged = moving.moving_average(trades(spark, t))
    stored = [
        tables.save_co_partitioned(df, f"hot_{name}", f"latest_{name}", 2, str(tmp_path / name))
        for name, df in (("trade", averaged), ("quote", quotes(spark, q)))
    ]
    seen = lambda **k: {r.event_seq_nb: r.last_trade_price for r in asof.asof_stored(*stored, **k).collect()}
    assert seen() == {4: 6.0, 5: 6.0, 6: None, 7: None}
    assert seen(inclusive=False) == {4: None, 5: 6.0, 6: None, 7: None}
