"""Every registered query against its SQL, all rows."""

import pytest

import __spark_entry__ as entry_module
from compare import compare, connect
from tickloom.queries.oracle import all_oracles
from tickloom.queries.registry import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_them():
    assert entry_module.queries().keys() >= QUERIES.keys()
    assert entry_module.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1


def test_the_feed_with_ties_and_gaps_can_tell_the_rules_apart():
    """Strict and inclusive, ties kept and dropped, calendar and trading days give other rows."""
    con = connect("/root/testdata/sf0.01")
    rows = lambda name: set(con.execute(ORACLES[name]).fetchall())
    assert len(rows("asof_bucketed") ^ rows("asof_by_instant")) > 100
    assert len(rows("prior_close_weekdays") ^ rows("prior_close_calendar_weekdays")) > 100
    for name, columns in (
        ("prior_close_ranked_tied", "trade_dt, stock_symbol, stock_exchange"),
        ("eod_trades_tied", "trade_dt, stock_symbol, arrival_tm, event_seq_nb"),
        ("eod_quotes_tied", "trade_dt, stock_symbol, arrival_tm, event_seq_nb"),
        ("dense_rank_split", "trade_dt, stock_symbol, stock_exchange, time_rank"),
    ):
        kept, groups = con.execute(
            f"SELECT count(*), count(DISTINCT ({columns})) FROM ({ORACLES[name]})"
        ).fetchall()[0]
        assert kept > groups
    most = con.execute(f"SELECT max(matched_rows) FROM ({ORACLES['eod_as_written_tied']})")
    assert most.fetchall()[0][0] > 3
    lone = con.execute(f"SELECT max(matched_rows) FROM ({ORACLES['eod_as_written']})")
    assert lone.fetchall()[0][0] <= 2
