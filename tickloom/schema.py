"""Declared schemas. Every field is nullable."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "date": T.DateType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}


def _schema(text: str) -> T.StructType:
    """Nullable fields from ``name type`` pairs; needs no running session."""
    pairs = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The feed's record types and the partition of rejected lines.
TRADE_TYPE = "T"
QUOTE_TYPE = "Q"
BAD_TYPE = "B"

EVENT = _schema(
    "trade_dt date, rec_type string, symbol string, exchange string, "
    "event_tm timestamp, event_seq_nb int, arrival_tm timestamp, trade_pr float, "
    "bid_pr float, bid_size int, ask_pr float, ask_size int, partition string"
)

QUARANTINE_FIELDS = _schema("_raw string, _reason string")

PROVENANCE_FIELDS = _schema("_file string, _file_size bigint, _file_time timestamp")

LANDING = T.StructType([*EVENT.fields, *QUARANTINE_FIELDS.fields, *PROVENANCE_FIELDS.fields])

TRADE = _schema(
    "trade_dt date, rec_type string, stock_symbol string, stock_exchange string, "
    "latest_trade timestamp, event_seq_nb int, arrival_tm timestamp, trade_pr float"
)

AVERAGED_TRADE = T.StructType([*TRADE.fields, T.StructField("mov_avg_pr", T.DoubleType())])

QUOTE = _schema(
    "trade_dt date, rec_type string, stock_symbol string, stock_exchange string, "
    "latest_quote timestamp, event_seq_nb int, arrival_tm timestamp, "
    "bid_pr float, bid_size int, ask_pr float, ask_size int"
)

TIMELINE = _schema(
    "trade_dt date, rec_type string, stock_symbol string, stock_exchange string, "
    "event_tm timestamp, event_seq_nb int, bid_pr float, bid_size int, "
    "ask_pr float, ask_size int, trade_pr float, mov_avg_pr double"
)

ENRICHED = _schema(
    "trade_dt date, rec_type string, stock_symbol string, stock_exchange string, "
    "event_tm timestamp, event_seq_nb int, bid_pr float, bid_size int, "
    "ask_pr float, ask_size int, last_trade_price float, last_mov_avg_price double, "
    "close_pr float, bid_move double, ask_move double"
)

INSTRUMENT = ("stock_symbol", "stock_exchange")
INSTRUMENT_DAY = ("trade_dt", *INSTRUMENT)
SYMBOL_DAY = ("trade_dt", "stock_symbol")

AUDIT = _schema(
    "trade_dt date, exchange string, partition string, reason string, row_count bigint, "
    "batch_id string"
)

FILE_AUDIT = T.StructType([T.StructField("_file", T.StringType()), *AUDIT.fields])

FILES = T.StructType([*PROVENANCE_FIELDS.fields, *_schema("path string, feed string, batch_id string").fields])

TOTALS = _schema("row_count bigint, rejected bigint, batch_id string")

CHANGED = _schema("trade_dt date, stock_symbol string, stock_exchange string, kind string, batch_id string")

RUN_DATES = _schema("trade_dt date, step string, batch_id string, part string")

SETTINGS = _schema("trade_dt date, settings string, updated_tm timestamp")
