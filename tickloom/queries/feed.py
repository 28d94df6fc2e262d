"""The ``events`` table read as an exchange feed.

Purchases are trades, all other events quotes. The tables hold no feed text, so
lines are rendered from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Every such number of events a line is damaged, in turn in these ways.
FAULT_EVERY = 50
FAULT_GARBAGE, FAULT_TYPE, FAULT_PRICE, FAULT_TIME, FAULT_SHORT = range(5)


# Declared, so that no file is opened to find the schema.
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)


def base(
    spark: SparkSession, sf_dir: str, hourly: bool = False, weekdays: bool = False
) -> DataFrame:
    """One row per event. No two events share a time and none of the days is without one.

    ``hourly`` cuts event times to the hour, so that many share one; ``weekdays`` puts
    the events of a weekend under its Friday, so that the calendar has gaps.
    """
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    event_id = F.col("event_id")
    day = F.to_date("ts")
    if weekdays:
        day = F.date_sub(day, F.greatest(F.weekday("ts") - 4, F.lit(0)))
    hour = F.expr("make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), 0, 0)")
    return events.select(
        day.alias("trade_dt"),
        F.when(F.col("event_type") == "purchase", "T").otherwise("Q").alias("rec_type"),
        F.concat(F.lit("S"), (F.col("user_id") % 20).cast("string")).alias("symbol"),
        F.when(event_id % 2 == 0, "NYSE").otherwise("NASDAQ").alias("exchange"),
        (hour if hourly else F.col("ts")).alias("event_tm"),
        (event_id % 2_000_000_000).cast("int").alias("event_seq_nb"),
        (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("arrival_tm"),
        F.col("value").cast("float").alias("price"),
        (F.col("value") + 0.05).cast("float").alias("ask"),
        (event_id % 100).cast("int").alias("size"),
        F.col("value"),
        event_id,
        F.col("user_id"),
    )


def events(spark: SparkSession, sf_dir: str, **form: bool) -> DataFrame:
    """The thirteen event columns, times without zone."""
    return as_events(base(spark, sf_dir, **form))


def as_events(rows: DataFrame) -> DataFrame:
    trade = F.col("rec_type") == "T"
    return rows.select(
        "trade_dt", "rec_type", "symbol", "exchange", "event_tm", "event_seq_nb", "arrival_tm",
        F.when(trade, F.col("price")).alias("trade_pr"),
        F.when(~trade, F.col("price")).alias("bid_pr"),
        F.when(~trade, F.col("size")).alias("bid_size"),
        F.when(~trade, F.col("ask")).alias("ask_pr"),
        F.when(~trade, F.col("size") + 1).alias("ask_size"),
        F.col("rec_type").alias("partition"),
    )


def batched_events(spark: SparkSession, sf_dir: str, **form: bool) -> DataFrame:
    """Events that share correction keys: one arrival per day, one sequence per user."""
    rows = base(spark, sf_dir, **form)
    day_end = F.date_add("trade_dt", 1).cast("timestamp_ntz")
    user = (F.col("user_id") % 2_000_000_000).cast("int")
    return as_events(rows.withColumns({"arrival_tm": day_end, "event_seq_nb": user}))


def resent(rows: DataFrame) -> DataFrame:
    """Later copies of each third event, with another price."""
    return rows.where(F.col("event_id") % 3 == 0).withColumns(
        {
            "arrival_tm": F.col("arrival_tm") + F.expr("INTERVAL 1 HOUR"),
            "price": (F.col("value") + 1).cast("float"),
        }
    )


def resent_events(spark: SparkSession, sf_dir: str, **form: bool) -> DataFrame:
    """Every event, and a later copy with another price of each third one."""
    rows = base(spark, sf_dir, **form)
    return as_events(rows.unionByName(resent(rows)))


def trades(spark: SparkSession, sf_dir: str, **form: bool) -> DataFrame:
    rows = base(spark, sf_dir, **form).where(F.col("rec_type") == "T")
    return rows.select(
        "trade_dt", "rec_type",
        F.col("symbol").alias("stock_symbol"),
        F.col("exchange").alias("stock_exchange"),
        F.col("event_tm").alias("latest_trade"),
        "event_seq_nb", "arrival_tm",
        F.col("price").alias("trade_pr"),
    )


def quotes(spark: SparkSession, sf_dir: str, **form: bool) -> DataFrame:
    rows = base(spark, sf_dir, **form).where(F.col("rec_type") == "Q")
    return rows.select(
        "trade_dt", "rec_type",
        F.col("symbol").alias("stock_symbol"),
        F.col("exchange").alias("stock_exchange"),
        F.col("event_tm").alias("latest_quote"),
        "event_seq_nb", "arrival_tm",
        F.col("price").alias("bid_pr"),
        F.col("size").alias("bid_size"),
        F.col("ask").alias("ask_pr"),
        (F.col("size") + 1).alias("ask_size"),
    )


def _texts() -> dict[str, Column]:
    fault = F.when(
        F.col("event_id") % FAULT_EVERY < 2, F.expr(f"event_id div {FAULT_EVERY}") % 5
    ).otherwise(-1)
    micros = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return {
        "fault": fault,
        "kind": F.when(fault == FAULT_TYPE, "X").otherwise(F.col("rec_type")),
        "price": F.when(fault == FAULT_PRICE, "n/a").otherwise(F.col("price").cast("string")),
        "event_tm": F.when(
            fault == FAULT_TIME, F.date_format("event_tm", "yyyy-MM-dd HH:mm:ss")
        ).otherwise(F.date_format("event_tm", micros)),
        "file_tm": F.date_format("arrival_tm", micros),
        "trade_dt": F.date_format("trade_dt", "yyyy-MM-dd"),
    }


def csv_lines(rows: DataFrame) -> DataFrame:
    """One comma-separated line per row, with its date and exchange."""
    t = _texts()
    head = [
        t["trade_dt"], t["file_tm"], t["kind"], F.col("symbol"), t["event_tm"],
        F.col("event_seq_nb").cast("string"), F.col("exchange"),
    ]
    quote = [F.col("size").cast("string"), F.col("ask").cast("string"),
             (F.col("size") + 1).cast("string")]
    line = (
        F.when(t["fault"] == FAULT_GARBAGE, "garbage")
        .when(t["fault"] == FAULT_SHORT, F.concat_ws(",", *head))
        .when(F.col("rec_type") == "T", F.concat_ws(",", *head, t["price"]))
        .otherwise(F.concat_ws(",", *head, t["price"], *quote))
    )
    return rows.select(line.alias("value"), "trade_dt", "exchange")


def json_lines(rows: DataFrame) -> DataFrame:
    """One JSON object per row, with its date and exchange."""
    t = _texts()

    def text(key: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{key}":"'), value, F.lit('"'))

    def number(key: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{key}":'), value.cast("string"))

    def price(key: str) -> Column:
        broken = text(key, t["price"])
        return F.when(t["fault"] == FAULT_PRICE, broken).otherwise(number(key, F.col("price")))

    # concat_ws leaves out nulls, so a short line lacks its exchange.
    exchange = F.when(t["fault"] != FAULT_SHORT, text("exchange", F.col("exchange")))
    common = [
        text("event_type", t["kind"]), text("trade_dt", t["trade_dt"]),
        text("symbol", F.col("symbol")), exchange, text("event_tm", t["event_tm"]),
        number("event_seq_nb", F.col("event_seq_nb")), text("file_tm", t["file_tm"]),
    ]
    quote = [
        price("bid_pr"), number("bid_size", F.col("size")), number("ask_pr", F.col("ask")),
        number("ask_size", F.col("size") + 1),
    ]
    body = F.when(F.col("rec_type") == "T", F.concat_ws(",", *common, price("price"))).otherwise(
        F.concat_ws(",", *common, *quote)
    )
    close = F.when(t["fault"] == FAULT_GARBAGE, "").otherwise("}")
    return rows.select(
        F.concat(F.lit("{"), body, close).alias("value"), "trade_dt", "exchange"
    )


def write_lines(lines: DataFrame, root: str) -> str:
    """Write feed files per date and exchange; gives the glob that reads them."""
    whole_files = lines.hint("rebalance", F.col("trade_dt"), F.col("exchange"))
    whole_files.write.partitionBy("trade_dt", "exchange").text(root)
    return f"{root}/*/*/*.txt"
