"""SQL for DuckDB that gives each query's result from the same tables.

Written from the semantics, with plain windows and as-of joins.
"""

from __future__ import annotations

BASE = """
base AS (
  SELECT CAST(ts AS DATE) AS trade_dt,
         CASE WHEN event_type = 'purchase' THEN 'T' ELSE 'Q' END AS rec_type,
         'S' || CAST(user_id % 20 AS VARCHAR) AS symbol,
         CASE WHEN event_id % 2 = 0 THEN 'NYSE' ELSE 'NASDAQ' END AS exchange,
         ts AS event_tm,
         CAST(event_id % 2000000000 AS INTEGER) AS event_seq_nb,
         ts + INTERVAL 5 MINUTE AS arrival_tm,
         CAST(CAST(value AS FLOAT) AS DOUBLE) AS price,
         CAST(CAST(value + 0.05 AS FLOAT) AS DOUBLE) AS ask,
         CAST(event_id % 100 AS INTEGER) AS size,
         value, event_id, user_id
  FROM events),
ev AS (
  SELECT trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb, arrival_tm,
         CASE WHEN rec_type = 'T' THEN price END AS trade_pr,
         CASE WHEN rec_type = 'Q' THEN price END AS bid_pr,
         CASE WHEN rec_type = 'Q' THEN size END AS bid_size,
         CASE WHEN rec_type = 'Q' THEN ask END AS ask_pr,
         CASE WHEN rec_type = 'Q' THEN size + 1 END AS ask_size,
         rec_type AS "partition"
  FROM base),
tr AS (
  SELECT trade_dt, rec_type, symbol AS stock_symbol, exchange AS stock_exchange,
         event_tm AS latest_trade, event_seq_nb, arrival_tm, trade_pr
  FROM ev WHERE rec_type = 'T'),
qu AS (
  SELECT trade_dt, rec_type, symbol AS stock_symbol, exchange AS stock_exchange,
         event_tm AS latest_quote, event_seq_nb, arrival_tm, bid_pr, bid_size, ask_pr, ask_size
  FROM ev WHERE rec_type = 'Q')"""

MOVING = """
ma AS (
  SELECT *, avg(trade_pr) OVER (
           PARTITION BY trade_dt, stock_symbol ORDER BY latest_trade
           RANGE BETWEEN INTERVAL {minutes} MINUTES PRECEDING AND CURRENT ROW) AS mov_avg_pr
  FROM tr)"""

SEEDS = """
ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY trade_dt, stock_symbol, stock_exchange
           ORDER BY latest_trade DESC, event_seq_nb DESC) AS nth
  FROM ma),
seeds AS (
  SELECT CAST(trade_dt + INTERVAL 1 DAY AS DATE) AS trade_dt, stock_symbol, stock_exchange,
         latest_trade, event_seq_nb, trade_pr, mov_avg_pr
  FROM ranked WHERE nth = 1)"""

TIMELINE = """
timeline AS (
  SELECT trade_dt, 'T' AS rec_type, stock_symbol, stock_exchange, latest_trade AS event_tm,
         event_seq_nb, CAST(NULL AS DOUBLE) AS bid_pr, CAST(NULL AS INTEGER) AS bid_size,
         CAST(NULL AS DOUBLE) AS ask_pr, CAST(NULL AS INTEGER) AS ask_size,
         trade_pr, round(mov_avg_pr, 6) AS mov_avg_pr
  FROM ma
  UNION ALL
  SELECT trade_dt, 'T', stock_symbol, stock_exchange, latest_trade, event_seq_nb,
         NULL, NULL, NULL, NULL, trade_pr, round(mov_avg_pr, 6)
  FROM seeds
  UNION ALL
  SELECT trade_dt, 'Q', stock_symbol, stock_exchange, latest_quote, event_seq_nb,
         bid_pr, bid_size, ask_pr, ask_size, NULL, NULL
  FROM qu)"""

FAULTS = """
faulty AS (
  SELECT *, CASE WHEN event_id % 50 < 2 THEN (event_id // 50) % 5 ELSE -1 END AS fault
  FROM base)"""


# The same events with times cut to the hour, and with weekends under their Friday.
HOURLY = BASE.replace("ts AS event_tm", "date_trunc('hour', ts) AS event_tm")
WEEKDAYS = BASE.replace(
    "CAST(ts AS DATE) AS trade_dt",
    "CAST(ts AS DATE) - greatest(CAST(isodow(ts) AS INTEGER) - 5, 0) AS trade_dt",
)

# Of trades at one instant the quote sees the one with the highest sequence number.
LAST_AT = """
lastat AS (
  SELECT * FROM ma QUALIFY row_number() OVER (
    PARTITION BY trade_dt, stock_symbol, stock_exchange, latest_trade
    ORDER BY event_seq_nb DESC) = 1)"""


def _with(*parts: str, base: str = BASE) -> str:
    return "WITH" + ",".join([base, *parts])


def _ma(minutes: int = 180) -> str:
    return MOVING.format(minutes=minutes)


def _parsed(reasons: dict[int, str], source: str = "faulty", name: str = "parsed") -> str:
    """Rows as the parsers give them: damaged lines keep only the reason."""
    cases = " ".join(f"WHEN {fault} THEN '{reason}'" for fault, reason in reasons.items())
    fields = {
        "trade_dt": "trade_dt", "rec_type": "rec_type", "symbol": "symbol",
        "exchange": "exchange", "event_tm": "event_tm", "event_seq_nb": "event_seq_nb",
        "arrival_tm": "arrival_tm",
        "trade_pr": "CASE WHEN rec_type = 'T' THEN price END",
        "bid_pr": "CASE WHEN rec_type = 'Q' THEN price END",
        "bid_size": "CASE WHEN rec_type = 'Q' THEN size END",
        "ask_pr": "CASE WHEN rec_type = 'Q' THEN ask END",
        "ask_size": "CASE WHEN rec_type = 'Q' THEN size + 1 END",
    }
    columns = ", ".join(f"CASE WHEN fault < 0 THEN {e} END AS {n}" for n, e in fields.items())
    return f"""
{name} AS (
  SELECT {columns},
         CASE WHEN fault < 0 THEN rec_type ELSE 'B' END AS "partition",
         CASE fault {cases} END AS _reason
  FROM {source})"""


CSV_REASONS = {
    0: "too_few_fields", 1: "unknown_type", 2: "bad_value", 3: "bad_value", 4: "too_few_fields",
}
JSON_REASONS = {
    0: "bad_json", 1: "unknown_type", 2: "bad_value", 3: "bad_value", 4: "missing_field",
}

FEEDS = FAULTS + "," + _parsed(
    CSV_REASONS, "(SELECT * FROM faulty WHERE exchange = 'NYSE')", "nyse"
) + "," + _parsed(
    JSON_REASONS, "(SELECT * FROM faulty WHERE exchange = 'NASDAQ')", "nasdaq"
) + """,
parsed AS (SELECT * FROM nyse UNION ALL SELECT * FROM nasdaq)"""

EVENT_COLUMNS = (
    'trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb, arrival_tm, trade_pr, '
    'bid_pr, bid_size, ask_pr, ask_size, "partition"'
)
TRADE_EVENT = (
    "trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb, arrival_tm, trade_pr"
)
QUOTE_EVENT = (
    "trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb, arrival_tm, "
    "bid_pr, bid_size, ask_pr, ask_size"
)
QUOTE_ROW = (
    "q.trade_dt, q.rec_type, q.stock_symbol, q.stock_exchange, q.latest_quote AS event_tm, "
    "q.event_seq_nb, q.bid_pr, q.bid_size, q.ask_pr, q.ask_size"
)
AVERAGED = (
    "trade_dt, rec_type, stock_symbol, stock_exchange, latest_trade, event_seq_nb, arrival_tm, "
    "trade_pr, round(mov_avg_pr, 6) AS mov_avg_pr"
)

BATCHED = """
batched AS (
  SELECT trade_dt, rec_type, symbol, exchange, event_tm,
         CAST(user_id % 2000000000 AS INTEGER) AS event_seq_nb,
         CAST(trade_dt + INTERVAL 1 DAY AS TIMESTAMP) AS arrival_tm,
         trade_pr, bid_pr, bid_size, ask_pr, ask_size
  FROM (SELECT e.*, b.user_id FROM ev e JOIN base b
        ON e.event_tm = b.event_tm AND e.event_seq_nb = b.event_seq_nb)),
corrected AS (
  SELECT *, max(event_tm) OVER (
           PARTITION BY trade_dt, rec_type, symbol, arrival_tm, event_seq_nb) AS best
  FROM batched)"""

RESENT = """
resent AS (
  SELECT trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb, arrival_tm,
         price AS trade_pr
  FROM base WHERE rec_type = 'T'
  UNION ALL
  SELECT trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb,
         arrival_tm + INTERVAL 1 HOUR, CAST(CAST(value + 1 AS FLOAT) AS DOUBLE)
  FROM base WHERE rec_type = 'T' AND event_id % 3 = 0)"""


def _asof(operator: str, base: str = BASE) -> str:
    return _with(_ma(), LAST_AT, base=base) + f"""
SELECT {QUOTE_ROW},
       CASE WHEN t.trade_dt >= q.trade_dt - 1 THEN t.trade_pr END AS last_trade_price,
       CASE WHEN t.trade_dt >= q.trade_dt - 1 THEN round(t.mov_avg_pr, 6) END
         AS last_mov_avg_price
FROM qu q ASOF LEFT JOIN lastat t
  ON q.stock_symbol = t.stock_symbol AND q.stock_exchange = t.stock_exchange
  AND q.latest_quote {operator} t.latest_trade"""


FILL = """
SELECT trade_dt, rec_type, stock_symbol, stock_exchange, event_tm, event_seq_nb, bid_pr,
       bid_size, ask_pr, ask_size, trade_pr, mov_avg_pr,
       last_value(trade_pr IGNORE NULLS) OVER w AS last_trade_price,
       last_value(mov_avg_pr IGNORE NULLS) OVER w AS last_mov_avg_price
FROM timeline
WINDOW w AS (PARTITION BY trade_dt, stock_symbol, stock_exchange
             ORDER BY event_tm, rec_type DESC, event_seq_nb
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

ENRICHED = """
SELECT {quote},
       CASE WHEN t.trade_dt >= q.trade_dt - 1 THEN t.trade_pr END AS last_trade_price,
       CASE WHEN t.trade_dt >= q.trade_dt - 1 THEN round(t.mov_avg_pr, 6) END
         AS last_mov_avg_price,
       s.trade_pr AS close_pr, q.bid_pr - s.trade_pr AS bid_move,
       q.ask_pr - s.trade_pr AS ask_move
FROM qu q
ASOF LEFT JOIN lastat t
  ON q.stock_symbol = t.stock_symbol AND q.stock_exchange = t.stock_exchange
  AND q.latest_quote >= t.latest_trade
LEFT JOIN seeds s
  ON s.trade_dt = q.trade_dt AND s.stock_symbol = q.stock_symbol
  AND s.stock_exchange = q.stock_exchange""".format(quote=QUOTE_ROW)

PARSED_ONLY = """
tr AS (
  SELECT trade_dt, rec_type, symbol AS stock_symbol, exchange AS stock_exchange,
         event_tm AS latest_trade, event_seq_nb, arrival_tm, trade_pr
  FROM parsed WHERE "partition" = 'T'),
qu AS (
  SELECT trade_dt, rec_type, symbol AS stock_symbol, exchange AS stock_exchange,
         event_tm AS latest_quote, event_seq_nb, arrival_tm, bid_pr, bid_size, ask_pr, ask_size
  FROM parsed WHERE "partition" = 'Q')"""

PRIOR_CLOSE = (
    "SELECT trade_dt, stock_symbol, stock_exchange, latest_trade, event_seq_nb, trade_pr "
    "FROM seeds"
)

TRADING_CLOSE = """,
dates AS (
  SELECT d.trade_dt, max(t.trade_dt) AS prior_dt
  FROM (SELECT DISTINCT trade_dt FROM ev) d
  JOIN (SELECT DISTINCT trade_dt FROM tr) t ON t.trade_dt < d.trade_dt
  GROUP BY d.trade_dt)
SELECT d.trade_dt, r.stock_symbol, r.stock_exchange, r.latest_trade, r.event_seq_nb, r.trade_pr
FROM ranked r JOIN dates d ON r.trade_dt = d.prior_dt WHERE r.nth = 1"""

JOINED_CLOSE = """
SELECT q.trade_dt, q.rec_type, q.stock_symbol, q.stock_exchange, q.latest_quote,
       q.event_seq_nb, q.arrival_tm, q.bid_pr, q.bid_size, q.ask_pr, q.ask_size,
       s.trade_pr AS close_pr{more}
FROM qu q LEFT JOIN seeds s
  ON s.trade_dt = q.trade_dt AND s.stock_symbol = q.stock_symbol
  AND s.stock_exchange = q.stock_exchange"""

LAST_OF_RANGE = """
SELECT {columns}, round(last_value(mov_avg_pr) OVER (
         PARTITION BY trade_dt, stock_symbol ORDER BY latest_trade
         RANGE BETWEEN INTERVAL 180 MINUTES PRECEDING AND CURRENT ROW), 6) AS last_mov_avg_pr
FROM ma"""

DAY_RANK = """
SELECT *, CAST(dense_rank() OVER (
         PARTITION BY trade_dt, stock_symbol, stock_exchange
         ORDER BY latest_trade DESC) AS INTEGER) AS time_rank
FROM tr"""


AS_WRITTEN = """
SELECT g.trade_dt, g.rec_type, g.symbol, g.arrival_tm, g.event_seq_nb, g.latest_tm,
       count(*) AS matched_rows, min(d.trade_pr) AS min_pr, max(d.trade_pr) AS max_pr
FROM (SELECT trade_dt, rec_type, symbol, arrival_tm, event_seq_nb, max(event_tm) AS latest_tm
      FROM resent GROUP BY ALL) g
JOIN resent d ON d.event_tm = g.latest_tm
GROUP BY ALL"""

# The columns of the trade views.
TRADE_VIEW = "trade_dt, stock_symbol, stock_exchange, latest_trade, event_seq_nb, trade_pr"


def _by_file() -> str:
    """Damaged lines under the exchange and date of their file."""
    case = {
        exchange: "CASE fault " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in reasons.items()) + " END"
        for exchange, reasons in (("NYSE", CSV_REASONS), ("NASDAQ", JSON_REASONS))
    }
    return f"""
SELECT exchange, trade_dt,
       CASE exchange WHEN 'NYSE' THEN {case["NYSE"]} ELSE {case["NASDAQ"]} END AS reason,
       count(*) AS row_count
FROM faulty WHERE fault >= 0 GROUP BY ALL"""


def all_oracles() -> dict[str, str]:
    eod = " FROM corrected WHERE event_tm = best AND rec_type = "
    renamed = "trade_dt, rec_type, symbol AS stock_symbol, exchange AS stock_exchange, event_tm AS "
    enriched = _with(_ma(), LAST_AT, SEEDS) + ENRICHED
    landed = [FEEDS, PARSED_ONLY, _ma(), LAST_AT, SEEDS]
    first = BASE.split(",\nev AS")[0]
    pipeline = "WITH" + ",".join([first, *landed]) + ENRICHED
    # Where an event was sent again its later price counts; the copies arrive later.
    again = first.replace(
        "CAST(CAST(value AS FLOAT) AS DOUBLE) AS price",
        "CASE WHEN event_id % 3 = 0 AND day(ts) <= 10 THEN CAST(CAST(value + 1 AS FLOAT) AS DOUBLE)"
        " ELSE CAST(CAST(value AS FLOAT) AS DOUBLE) END AS price",
    )
    two_batches = "WITH" + ",".join([again, *landed]) + ENRICHED
    averaged = _with(_ma()) + f" SELECT {AVERAGED} FROM ma"
    trades = f"SELECT {TRADE_EVENT} FROM ev WHERE rec_type = 'T'"
    quotes = f"SELECT {QUOTE_EVENT} FROM ev WHERE rec_type = 'Q'"
    return {
        "flagship_enriched_quotes": enriched,
        "ingest_csv": _with(FAULTS, _parsed(CSV_REASONS)) + " SELECT * FROM parsed",
        "ingest_json": _with(FAULTS, _parsed(JSON_REASONS)) + " SELECT * FROM parsed",
        "union_feeds": _with(FEEDS)
        + f" SELECT {EVENT_COLUMNS} FROM parsed WHERE _reason IS NULL",
        "quarantine_counts": _with(FEEDS)
        + " SELECT _reason AS reason, count(*) AS row_count FROM parsed"
        " WHERE _reason IS NOT NULL GROUP BY ALL",
        "scan_partition_trades": _with() + " " + trades,
        "scan_partition_quotes": _with() + " " + quotes,
        "scan_trade_date": _with() + " SELECT * FROM tr WHERE trade_dt = DATE '2024-01-15'",
        "symbol_filter": _with() + " SELECT * FROM tr WHERE stock_symbol = 'S7'",
        "roundtrip_partitioned": _with() + " SELECT * FROM ev",
        "roundtrip_by_date": _with() + " SELECT * FROM qu",
        "roundtrip_enriched": enriched,
        "staging_table": averaged,
        "project_trades": _with() + " " + trades,
        "project_quotes": _with() + " " + quotes,
        "latest_event_time": _with(BATCHED)
        + " SELECT trade_dt, rec_type, symbol, arrival_tm, event_seq_nb,"
        " max(event_tm) AS latest_tm FROM batched GROUP BY ALL",
        "eod_trades": _with(BATCHED)
        + f" SELECT {renamed}latest_trade, event_seq_nb, arrival_tm, trade_pr{eod}'T'",
        "eod_quotes": _with(BATCHED)
        + f" SELECT {renamed}latest_quote, event_seq_nb, arrival_tm, bid_pr, bid_size,"
        f" ask_pr, ask_size{eod}'Q'",
        "eod_latest_arrival": _with(RESENT)
        + f" SELECT {renamed}latest_trade, event_seq_nb, arrival_tm, trade_pr FROM resent"
        " QUALIFY row_number() OVER (PARTITION BY trade_dt, rec_type, symbol, exchange,"
        " event_tm, event_seq_nb ORDER BY arrival_tm DESC) = 1",
        "eod_as_written": _with(RESENT) + AS_WRITTEN,
        "sorted_trades": _with()
        + " SELECT * FROM tr ORDER BY trade_dt, stock_symbol, event_seq_nb",
        "latest_n_trades": _with()
        + " SELECT * FROM tr ORDER BY latest_trade DESC, event_seq_nb DESC LIMIT 5",
        "first_n_trades": _with()
        + " SELECT * FROM tr ORDER BY trade_dt, stock_symbol, latest_trade, event_seq_nb LIMIT 10",
        "moving_average_180m": averaged,
        "moving_average_30m": _with(_ma(30)) + f" SELECT {AVERAGED} FROM ma",
        "moving_average_split": _with(_ma(), base=HOURLY) + f" SELECT {AVERAGED} FROM ma",
        "sql_moving_average": _with(_ma())
        + " SELECT stock_symbol, stock_exchange, latest_trade, event_seq_nb, trade_pr,"
        " round(mov_avg_pr, 6) AS mov_avg_pr FROM ma",
        "sql_last_trade": _with(_ma())
        + LAST_OF_RANGE.format(
            columns="trade_dt, stock_symbol, stock_exchange, latest_trade, event_seq_nb, trade_pr"
        ),
        "last_value_range": _with(_ma()) + LAST_OF_RANGE.format(columns=AVERAGED),
        "last_value_unbounded": _with()
        + """
SELECT *, last_value(trade_pr) OVER (
         PARTITION BY trade_dt, stock_symbol, stock_exchange ORDER BY latest_trade, event_seq_nb
         RANGE BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_trade_pr
FROM tr""",
        "dense_rank_latest": _with() + DAY_RANK,
        "dense_rank_split": _with(base=HOURLY) + DAY_RANK,
        "date_functions": _with()
        + """
SELECT event_seq_nb, CAST(latest_trade AS DATE) AS trade_day,
       CAST(latest_trade AS DATE) - 1 AS prev_day, CAST(latest_trade AS DATE) + 1 AS next_day,
       strftime(CAST(latest_trade AS DATE) - 1, '%Y-%m-%d') AS prev_day_text
FROM tr""",
        "prior_close": _with(_ma(), SEEDS) + " " + PRIOR_CLOSE,
        "prior_close_ranked": _with()
        + " SELECT * FROM tr QUALIFY dense_rank() OVER (PARTITION BY trade_dt, stock_symbol,"
        " stock_exchange ORDER BY latest_trade DESC) = 1",
        "prior_close_trading_day": _with(_ma(), SEEDS) + TRADING_CLOSE,
        "prior_close_join": _with(_ma(), SEEDS) + JOINED_CLOSE.format(more=""),
        "price_movement": _with(_ma(), SEEDS)
        + JOINED_CLOSE.format(
            more=", q.bid_pr - s.trade_pr AS bid_move, q.ask_pr - s.trade_pr AS ask_move"
        ),
        "merged_timeline": _with(_ma(), SEEDS, TIMELINE) + " SELECT * FROM timeline",
        "forward_fill": _with(_ma(), SEEDS, TIMELINE) + FILL,
        "asof_last_trade": _asof(">="),
        "asof_last_trade_strict": _asof(">"),
        "asof_bucketed": _asof(">=", HOURLY),
        "asof_by_instant": _asof(">", HOURLY),
        "asof_bucketed_tables": _asof(">=").replace("t.trade_dt >= q.trade_dt - 1", "t.trade_dt = q.trade_dt"),
        "symbol_filter_stored": _with() + " SELECT * FROM tr WHERE stock_symbol = 'S7'",
        "write_once": _with() + " SELECT * FROM qu WHERE day(trade_dt) <= 10",
        "run_audit": _with(FEEDS)
        + """
SELECT trade_dt, exchange, "partition", _reason AS reason, count(*) AS row_count,
       'batch-1' AS batch_id
FROM parsed GROUP BY ALL""",
        "latest_status": _with()
        + """
SELECT exchange AS job_name, trade_dt AS trade_date, TIMESTAMP '2024-07-01 01:00:00' AS updated_tm,
       CASE WHEN n % 3 = 0 THEN 'failed' ELSE 'success' END AS status,
       exchange || CASE WHEN n % 3 = 0 THEN '-failed' ELSE '-success' END AS job_id
FROM (SELECT exchange, trade_dt, count(*) FILTER (rec_type = 'T') AS n FROM base GROUP BY ALL)""",
        "latest_status_compacted": _with()
        + """
SELECT exchange AS job_name, trade_dt AS trade_date, TIMESTAMP '2024-07-01 01:00:00' AS updated_tm,
       CASE WHEN n % 3 = 0 THEN 'failed' ELSE 'success' END AS status,
       exchange || CASE WHEN n % 3 = 0 THEN '-failed' ELSE '-success' END AS job_id
FROM (SELECT exchange, trade_dt, count(*) FILTER (rec_type = 'T') AS n FROM base GROUP BY ALL)""",
        "batch_id": _with(FAULTS)
        + """
SELECT batch_id, CASE WHEN fault < 0 THEN rec_type ELSE 'B' END AS "partition", count(*) AS row_count
FROM (SELECT *, 'batch-0' AS batch_id FROM faulty
      UNION ALL
      SELECT *, 'batch-1' FROM faulty WHERE event_id % 3 = 0 AND day(trade_dt) <= 10)
GROUP BY ALL""",
        "job_status": _with()
        + """
SELECT DISTINCT 'NYSE-success' AS job_id, TIMESTAMP '2024-07-01 01:00:00' AS updated_tm,
       'success' AS status
FROM (SELECT trade_dt, count(*) FILTER (rec_type = 'T') AS n FROM base
      WHERE exchange = 'NYSE' GROUP BY ALL)
WHERE n % 3 <> 0""",
        "quarantine_by_file": _with(FAULTS) + _by_file(),
        "files_seen": _with()
        + """
SELECT 'batch-0' AS batch_id, count(*) AS row_count,
       count(*) FILTER (event_id % 50 < 2) AS rejected FROM base
UNION ALL
SELECT 'batch-1', count(*), count(*) FILTER (event_id % 50 < 2)
FROM base WHERE event_id % 3 = 0 AND day(trade_dt) <= 10""",
        "changed_instruments": _with()
        + """
SELECT DISTINCT trade_dt, symbol AS stock_symbol, exchange AS stock_exchange, rec_type AS kind
FROM base WHERE event_id % 3 = 0 AND day(trade_dt) <= 10 AND event_id % 50 >= 2""",
        "drop_staging": _with()
        + """
SELECT unnest(['prev_temp_last_trade', 'quote_union', 'quote_update', 'quotes', 'temp_last_trade',
               'temp_trade_moving_avg', 'tmp_last_trade', 'tmp_trade_moving_avg']) AS name,
       (SELECT count(*) > 0 FROM ev) AS filled, true AS dropped""",
        "flagship_tied": _with(_ma(), LAST_AT, SEEDS, base=HOURLY) + ENRICHED,
        "forward_fill_tied": _with(_ma(), SEEDS, TIMELINE, base=HOURLY) + FILL,
        "last_value_range_tied": _with(_ma(), LAST_AT, base=HOURLY)
        + f"""
SELECT {AVERAGED}, last_value(trade_pr) OVER (
         PARTITION BY trade_dt, stock_symbol, latest_trade ORDER BY event_seq_nb
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_trade_pr
FROM ma""",
        "eod_trades_tied": _with(BATCHED, base=HOURLY)
        + f" SELECT {renamed}latest_trade, event_seq_nb, arrival_tm, trade_pr{eod}'T'",
        "eod_quotes_tied": _with(BATCHED, base=HOURLY)
        + f" SELECT {renamed}latest_quote, event_seq_nb, arrival_tm, bid_pr, bid_size,"
        f" ask_pr, ask_size{eod}'Q'",
        "eod_as_written_tied": _with(RESENT, base=HOURLY) + AS_WRITTEN,
        "prior_close_ranked_tied": _with(base=HOURLY)
        + " SELECT * FROM tr QUALIFY dense_rank() OVER (PARTITION BY trade_dt, stock_symbol,"
        " stock_exchange ORDER BY latest_trade DESC) = 1",
        "prior_close_weekdays": _with(_ma(), SEEDS, base=WEEKDAYS) + TRADING_CLOSE,
        "prior_close_calendar_weekdays": _with(_ma(), SEEDS, base=WEEKDAYS) + " " + PRIOR_CLOSE,
        "pipeline_two_batches": two_batches,
        "view_tmp_trade_moving_avg": _with() + f" SELECT {TRADE_VIEW} FROM tr",
        "view_tmp_last_trade": _with() + f" SELECT {TRADE_VIEW} FROM tr",
        "view_prev_temp_last_trade": _with(_ma(), SEEDS)
        + f" SELECT {TRADE_VIEW}, round(mov_avg_pr, 6) AS last_mov_avg_pr FROM seeds",
        "view_quotes": _with() + " SELECT * FROM qu",
        "view_quote_union": _with(_ma(), "seeds AS (SELECT * FROM ma WHERE false)", TIMELINE)
        + " SELECT * FROM timeline",
        "view_quote_update": _asof(">="),
        "pipeline_end_to_end": pipeline,
    }
