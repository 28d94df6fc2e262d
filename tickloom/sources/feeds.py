"""Raw exchange feeds: text lines in, one event table out.

Every input line gives one row. A line that cannot be read becomes a row of
partition ``B`` with only its text and the reason; no line is lost and none
fails the job.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import parsing as P
from tickloom.schema import BAD_TYPE, EVENT, QUARANTINE_FIELDS, QUOTE_TYPE, TRADE_TYPE

TOO_FEW_FIELDS = "too_few_fields"
UNKNOWN_TYPE = "unknown_type"
BAD_JSON = "bad_json"
MISSING_FIELD = "missing_field"
BAD_VALUE = "bad_value"

# Field positions of the comma-separated feed.
CSV_TRADE_DT = 0
CSV_FILE_TM = 1
CSV_REC_TYPE = 2
CSV_SYMBOL = 3
CSV_EVENT_TM = 4
CSV_EVENT_SEQ_NB = 5
CSV_EXCHANGE = 6
CSV_PRICE = 7
CSV_BID_SIZE = 8
CSV_ASK_PRICE = 9
CSV_ASK_SIZE = 10

# Keys and types of the JSON feed.
JSON_FIELDS = {
    "event_type": "string",
    "trade_dt": "string",
    "symbol": "string",
    "exchange": "string",
    "event_tm": "string",
    "event_seq_nb": "int",
    "file_tm": "string",
    "price": "float",
    "bid_pr": "float",
    "bid_size": "int",
    "ask_pr": "float",
    "ask_size": "int",
}
JSON_COMMON_KEYS = ("trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb", "file_tm")
JSON_TRADE_KEYS = ("price",)
JSON_QUOTE_KEYS = ("bid_pr", "bid_size", "ask_pr", "ask_size")
JSON_NEVER_NULL = ("trade_dt", "event_tm", "file_tm")


def read_lines(
    spark: SparkSession, globs: str | Sequence[str], provenance: bool = False
) -> DataFrame:
    """All lines of all files matched, in one scan; with ``provenance`` the file each stands in."""
    paths = [globs] if isinstance(globs, str) else list(globs)
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    origin = [F.col(f"_metadata.{field}").alias(name) for name, field in _ORIGIN.items()]
    return lines.select("value", *(origin if provenance else []))


# Where a line's provenance comes from.
_ORIGIN = {
    "_file": "file_path", "_file_size": "file_size", "_file_time": "file_modification_time",
}


def delivered_files(spark: SparkSession, globs: str | Sequence[str]) -> DataFrame:
    """The files matched, each once however many globs match it; their content is not read.

    ``path`` can be read; the other columns are those of the lines' provenance.
    """
    paths = [globs] if isinstance(globs, str) else list(globs)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    origin = [F.col(f"_metadata.{field}").alias(name) for name, field in _ORIGIN.items()]
    return files.select("path", *origin).distinct()


def exactly(path: str) -> str:
    """A path as a glob that matches it alone."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _kept(lines: DataFrame) -> list[str]:
    return [c for c in _ORIGIN if c in lines.columns]


def _parsed_once(df: DataFrame) -> DataFrame:
    """The same rows out of a generator.

    A filter on parsed columns would otherwise be moved below the parse by copying
    all of its expressions into the condition, so each line would be parsed again
    and again. Filters do not move through a generator.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _all_of(conditions: Sequence[Column]) -> Column:
    held = F.lit(True)
    for condition in conditions:
        held = held & condition
    return held


def _events(parsed: DataFrame) -> DataFrame:
    """Shape rows with ``_reason``, ``_line`` and one column per field into events."""
    good = F.col("_reason").isNull()
    is_trade = good & (F.col("rec_type") == TRADE_TYPE)
    is_quote = good & (F.col("rec_type") == QUOTE_TYPE)
    owner = {
        "trade_pr": is_trade,
        "bid_pr": is_quote,
        "bid_size": is_quote,
        "ask_pr": is_quote,
        "ask_size": is_quote,
    }
    columns = []
    for field in EVENT.fields:
        if field.name == "partition":
            value = F.when(good, F.col("rec_type")).otherwise(BAD_TYPE)
        else:
            value = F.when(owner.get(field.name, good), F.col(field.name))
        columns.append(value.cast(field.dataType).alias(field.name))
    raw = F.when(~good, F.col("_line")).alias("_raw")
    return parsed.select(*columns, raw, "_reason", *_kept(parsed))


def parse_csv_feed(lines: DataFrame, value: str = "value") -> DataFrame:
    """Comma-separated lines to events; fields beyond the last one used are ignored."""
    origin = _kept(lines)
    fields = lines.select(F.col(value).alias("_line"), F.split(value, ",", -1).alias("_f"), *origin)

    def at(position: int) -> Column:
        return F.get("_f", F.lit(position))

    typed = fields.select(
        "_line",
        *origin,
        F.size("_f").alias("_n"),
        at(CSV_REC_TYPE).alias("rec_type"),
        P.parse_date(at(CSV_TRADE_DT)).alias("trade_dt"),
        at(CSV_SYMBOL).alias("symbol"),
        at(CSV_EXCHANGE).alias("exchange"),
        P.parse_timestamp(at(CSV_EVENT_TM)).alias("event_tm"),
        P.parse_int(at(CSV_EVENT_SEQ_NB)).alias("event_seq_nb"),
        P.parse_timestamp(at(CSV_FILE_TM)).alias("arrival_tm"),
        P.parse_price(at(CSV_PRICE)).alias("trade_pr"),
        P.parse_price(at(CSV_PRICE)).alias("bid_pr"),
        P.parse_int(at(CSV_BID_SIZE)).alias("bid_size"),
        P.parse_price(at(CSV_ASK_PRICE)).alias("ask_pr"),
        P.parse_int(at(CSV_ASK_SIZE)).alias("ask_size"),
    )
    typed = _parsed_once(typed)
    is_quote = F.col("rec_type") == QUOTE_TYPE
    needed = F.when(is_quote, CSV_ASK_SIZE + 1).otherwise(CSV_PRICE + 1)
    common = ("trade_dt", "event_tm", "event_seq_nb", "arrival_tm")
    common_read = _all_of([F.col(c).isNotNull() for c in common])
    prices = ("bid_pr", "bid_size", "ask_pr", "ask_size")
    quote_read = _all_of([F.col(c).isNotNull() for c in prices])
    own_read = F.when(is_quote, quote_read).otherwise(F.col("trade_pr").isNotNull())
    reason = (
        F.when(F.col("_n") <= CSV_REC_TYPE, TOO_FEW_FIELDS)
        .when(~F.col("rec_type").isin(TRADE_TYPE, QUOTE_TYPE), UNKNOWN_TYPE)
        .when(F.col("_n") < needed, TOO_FEW_FIELDS)
        .when(~(common_read & own_read), BAD_VALUE)
    )
    return _events(typed.withColumn("_reason", reason))


def parse_json_feed(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON object lines to events.

    A whole-number price is read as a price. A key given as JSON null stays null
    where the event table allows it; a missing key sends the line to quarantine.
    """
    # Reading the line as the only element of an array makes text after the
    # object an error instead of being skipped.
    wrapped = F.concat(F.lit("["), F.col(value), F.lit("]"))
    options = {"allowSingleQuotes": "false"}
    fields = ", ".join(f"{name}: {kind}" for name, kind in JSON_FIELDS.items())
    items = F.from_json(wrapped, f"array<struct<{fields}>>", options)
    origin = _kept(lines)
    read = lines.select(F.col(value).alias("_line"), items.alias("_items"), *origin).select(
        "_line", *origin, F.when(F.size("_items") == 1, F.get("_items", F.lit(0))).alias("_j")
    )
    j = {name: F.col("_j").getField(name) for name in JSON_FIELDS}
    typed = read.select(
        "_line",
        *origin,
        j["event_type"].alias("rec_type"),
        P.parse_date(j["trade_dt"]).alias("trade_dt"),
        j["symbol"].alias("symbol"),
        j["exchange"].alias("exchange"),
        P.parse_timestamp(j["event_tm"]).alias("event_tm"),
        j["event_seq_nb"].alias("event_seq_nb"),
        P.parse_timestamp(j["file_tm"]).alias("arrival_tm"),
        P.finite(j["price"]).alias("trade_pr"),
        P.finite(j["bid_pr"]).alias("bid_pr"),
        j["bid_size"].alias("bid_size"),
        P.finite(j["ask_pr"]).alias("ask_pr"),
        j["ask_size"].alias("ask_size"),
    )
    column = {"file_tm": "arrival_tm", "price": "trade_pr"}
    is_trade = F.col("rec_type") == TRADE_TYPE

    def any_key(test) -> Column:
        def of(keys: Sequence[str]) -> Column:
            return ~_all_of([~test(key, F.col(column.get(key, key)).isNull()) for key in keys])

        own = F.when(is_trade, of(JSON_TRADE_KEYS)).otherwise(of(JSON_QUOTE_KEYS))
        return of(JSON_COMMON_KEYS) | own

    # Only a line with an empty field is read once more, for the texts behind it.
    empty = any_key(lambda key, null: null)
    texts = F.when(empty, F.from_json("_line", "map<string, string>", options))
    typed = _parsed_once(typed.withColumn("_texts", texts))
    given = F.map_keys("_texts")

    def missing(key: str, null: Column) -> Column:
        return null & ~F.coalesce(F.array_contains(given, key), F.lit(False))

    def unread(key: str, null: Column) -> Column:
        if key in JSON_NEVER_NULL:
            return null
        return null & F.try_element_at("_texts", F.lit(key)).isNotNull()

    reason = (
        F.when(F.col("rec_type").isNull(), BAD_JSON)
        .when(~F.col("rec_type").isin(TRADE_TYPE, QUOTE_TYPE), UNKNOWN_TYPE)
        .when(any_key(missing), MISSING_FIELD)
        .when(any_key(unread), BAD_VALUE)
    )
    return _events(typed.withColumn("_reason", reason))


def ingest(
    spark: SparkSession,
    csv_globs: str | Sequence[str] = (),
    json_globs: str | Sequence[str] = (),
    provenance: bool = False,
) -> DataFrame:
    """All feeds of all dates as one table: the event columns, ``_raw`` and ``_reason``.

    With ``provenance`` also the file of each line, its size and its time.
    """
    parts = []
    if csv_globs:
        parts.append(parse_csv_feed(read_lines(spark, csv_globs, provenance)))
    if json_globs:
        parts.append(parse_json_feed(read_lines(spark, json_globs, provenance)))
    if not parts:
        raise ValueError("no feed given")
    return union_feeds(*parts)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Feeds one below the other, duplicates kept."""
    merged = feeds[0]
    for feed in feeds[1:]:
        merged = merged.unionByName(feed)
    return merged


def accepted(events: DataFrame) -> DataFrame:
    """The trades and quotes, in the event columns."""
    return events.where(F.col("partition") != BAD_TYPE).select(*EVENT.names)


def quarantined(events: DataFrame) -> DataFrame:
    """The rejected lines with their reasons."""
    return events.where(F.col("partition") == BAD_TYPE).select(*QUARANTINE_FIELDS.names)
