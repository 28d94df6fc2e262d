"""One query per operator, each over the whole ``events`` table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.timeaxis import next_date, previous_date
from tickloom.operators import asof, close, correct, enrich, moving, order
from tickloom.plans import audit
from tickloom.plans.pipeline import (
    PipelineConfig,
    load_raw,
    read_changes,
    read_quarantine,
    read_totals,
    run_pipeline,
)
from tickloom.plans.sql_surface import register_staging
from tickloom.queries import feed
from tickloom.schema import ENRICHED, EVENT
from tickloom.sources import feeds, tables

Query = Callable[[SparkSession, str], DataFrame]


def _comparable(df: DataFrame) -> DataFrame:
    """Floats as doubles, times as wall clock time, averages to six digits."""
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.FloatType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        if "mov_avg" in field.name:
            value = F.round(value, 6)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _csv_glob(spark: SparkSession, rows: DataFrame, name: str) -> str:
    return feed.write_lines(feed.csv_lines(rows), tables.scratch_path(spark, f"{name}-csv"))


def _json_glob(spark: SparkSession, rows: DataFrame, name: str) -> str:
    return feed.write_lines(feed.json_lines(rows), tables.scratch_path(spark, f"{name}-json"))


def _feed_globs(spark: SparkSession, rows: DataFrame, name: str) -> tuple[str, str]:
    nyse = rows.where(F.col("exchange") == "NYSE")
    nasdaq = rows.where(F.col("exchange") == "NASDAQ")
    return _csv_glob(spark, nyse, name), _json_glob(spark, nasdaq, name)


def ingest_csv(spark, sf_dir):
    glob = _csv_glob(spark, feed.base(spark, sf_dir), "ingest_csv")
    return feeds.parse_csv_feed(feeds.read_lines(spark, glob)).drop("_raw")


def ingest_json(spark, sf_dir):
    glob = _json_glob(spark, feed.base(spark, sf_dir), "ingest_json")
    return feeds.parse_json_feed(feeds.read_lines(spark, glob)).drop("_raw")


def union_feeds(spark, sf_dir):
    csv, json = _feed_globs(spark, feed.base(spark, sf_dir), "union_feeds")
    return feeds.accepted(feeds.ingest(spark, [csv], [json]))


def _parsed(spark, sf_dir):
    """Both feeds parsed from rendered lines without files in between."""
    rows = feed.base(spark, sf_dir)
    csv = feed.csv_lines(rows.where(F.col("exchange") == "NYSE"))
    json = feed.json_lines(rows.where(F.col("exchange") == "NASDAQ"))
    return feeds.union_feeds(feeds.parse_csv_feed(csv), feeds.parse_json_feed(json))


def quarantine_counts(spark, sf_dir):
    return audit.quarantine_counts(_parsed(spark, sf_dir))


def run_audit(spark, sf_dir):
    return audit.run_audit(_parsed(spark, sf_dir), "batch-1")


def _events_table(spark, sf_dir, name):
    root = tables.scratch_path(spark, name)
    tables.write_partitioned(feed.events(spark, sf_dir), root, ["trade_dt", "partition"])
    return root


def scan_partition_trades(spark, sf_dir):
    root = _events_table(spark, sf_dir, "scan_partition_trades")
    return correct.project_trades(tables.read_partition(spark, root, "T"))


def scan_partition_quotes(spark, sf_dir):
    root = _events_table(spark, sf_dir, "scan_partition_quotes")
    return correct.project_quotes(tables.read_partition(spark, root, "Q"))


def _by_date(spark, rows, name):
    root = tables.scratch_path(spark, name)
    tables.write_by_date(rows, root)
    return root


def scan_trade_date(spark, sf_dir):
    root = _by_date(spark, feed.trades(spark, sf_dir), "scan_trade_date")
    return tables.read_dates(spark, root, ["2024-01-15"])


def symbol_filter(spark, sf_dir):
    return close.instrument_rows(feed.trades(spark, sf_dir), "S7")


def symbol_filter_stored(spark, sf_dir):
    """From files in order of symbol: the filter reaches the row groups."""
    root = tables.scratch_path(spark, "symbol_filter_stored")
    rows = feed.trades(spark, sf_dir)
    tables.write_clustered(rows, root)
    return close.instrument_rows(spark.read.parquet(root).select(*rows.columns), "S7")


def write_once(spark, sf_dir):
    """The first ten days of a month are stored; storing all days is then refused as a whole."""
    root = tables.scratch_path(spark, "write_once")
    rows = feed.quotes(spark, sf_dir)
    tables.write_once(rows.where(F.dayofmonth("trade_dt") <= 10), root)
    try:
        tables.write_once(rows, root)
    except FileExistsError:
        return spark.read.parquet(root).select(*rows.columns)
    raise AssertionError("dates were written twice")


def roundtrip_partitioned(spark, sf_dir):
    root = _events_table(spark, sf_dir, "roundtrip_partitioned")
    return spark.read.parquet(root).select(*EVENT.names)


def roundtrip_by_date(spark, sf_dir):
    rows = feed.quotes(spark, sf_dir)
    return spark.read.parquet(_by_date(spark, rows, "roundtrip_by_date")).select(*rows.columns)


def roundtrip_enriched(spark, sf_dir):
    rows = flagship_enriched_quotes(spark, sf_dir)
    return spark.read.parquet(_by_date(spark, rows, "roundtrip_enriched")).select(*rows.columns)


def staging_table(spark, sf_dir):
    averaged = moving.moving_average(feed.trades(spark, sf_dir))
    path = tables.scratch_path(spark, "staging_table")
    return tables.save_staging(averaged, "temp_trade_moving_avg", path)


def project_trades(spark, sf_dir):
    return correct.project_trades(feed.events(spark, sf_dir).where(F.col("rec_type") == "T"))


def project_quotes(spark, sf_dir):
    return correct.project_quotes(feed.events(spark, sf_dir).where(F.col("rec_type") == "Q"))


def latest_event_time(spark, sf_dir):
    return correct.latest_event_time(feed.batched_events(spark, sf_dir))


def eod_trades(spark, sf_dir):
    return correct.load_trades(feed.batched_events(spark, sf_dir))


def eod_quotes(spark, sf_dir):
    return correct.load_quotes(feed.batched_events(spark, sf_dir))


def eod_latest_arrival(spark, sf_dir):
    return correct.load_trades(feed.resent_events(spark, sf_dir), "latest_arrival")


def eod_as_written(spark, sf_dir):
    rows = feed.resent_events(spark, sf_dir).where(F.col("rec_type") == "T")
    return correct.time_only_matches(correct.project_trades(rows), "trade_pr")


def eod_trades_tied(spark, sf_dir):
    return correct.load_trades(feed.batched_events(spark, sf_dir, hourly=True))


def eod_quotes_tied(spark, sf_dir):
    return correct.load_quotes(feed.batched_events(spark, sf_dir, hourly=True))


def eod_as_written_tied(spark, sf_dir):
    rows = feed.resent_events(spark, sf_dir, hourly=True).where(F.col("rec_type") == "T")
    return correct.time_only_matches(correct.project_trades(rows), "trade_pr")


def sorted_trades(spark, sf_dir):
    return order.sort_rows(feed.trades(spark, sf_dir))


def latest_n_trades(spark, sf_dir):
    return order.latest_n(feed.trades(spark, sf_dir), 5, ["latest_trade", "event_seq_nb"])


def first_n_trades(spark, sf_dir):
    by = ["trade_dt", "stock_symbol", "latest_trade", "event_seq_nb"]
    return order.first_n(feed.trades(spark, sf_dir), 10, by)


def moving_average_180m(spark, sf_dir):
    return moving.moving_average(feed.trades(spark, sf_dir), 180)


def moving_average_30m(spark, sf_dir):
    return moving.moving_average(feed.trades(spark, sf_dir), 30)


def moving_average_split(spark, sf_dir):
    """Under ties: many trades share an instant."""
    return moving.moving_average(feed.trades(spark, sf_dir, hourly=True), 180)


def sql_moving_average(spark, sf_dir):
    views = ["temp_trade_moving_avg"]
    register_staging(feed.trades(spark, sf_dir), feed.quotes(spark, sf_dir), views)
    return spark.sql(
        "SELECT stock_symbol, stock_exchange, latest_trade, event_seq_nb, trade_pr, mov_avg_pr "
        "FROM temp_trade_moving_avg"
    )


def sql_last_trade(spark, sf_dir):
    views = ["temp_last_trade"]
    register_staging(feed.trades(spark, sf_dir), feed.quotes(spark, sf_dir), views)
    return spark.sql(
        "SELECT trade_dt, stock_symbol, stock_exchange, latest_trade, event_seq_nb, trade_pr, "
        "last_mov_avg_pr FROM (SELECT * FROM temp_last_trade) AS last_trades"
    )


def last_value_range(spark, sf_dir):
    return moving.moving_average(
        feed.trades(spark, sf_dir), last={"last_mov_avg_pr": "mov_avg_pr"}
    )


def last_value_range_tied(spark, sf_dir):
    trades = feed.trades(spark, sf_dir, hourly=True)
    return moving.moving_average(trades, last={"last_trade_pr": "trade_pr"})


def last_value_unbounded(spark, sf_dir):
    return close.last_value_unbounded(feed.trades(spark, sf_dir))


def dense_rank_latest(spark, sf_dir):
    return close.dense_rank_latest(feed.trades(spark, sf_dir))


def dense_rank_split(spark, sf_dir):
    """Under ties: many trades share an instant."""
    return close.dense_rank_latest(feed.trades(spark, sf_dir, hourly=True))


def date_functions(spark, sf_dir):
    rows = feed.trades(spark, sf_dir)
    day = F.to_date("latest_trade")
    return rows.select(
        "event_seq_nb",
        day.alias("trade_day"),
        previous_date(day).alias("prev_day"),
        next_date(day).alias("next_day"),
        F.date_format(previous_date(day), "yyyy-MM-dd").alias("prev_day_text"),
    )


def prior_close(spark, sf_dir):
    return close.prior_day_close(feed.trades(spark, sf_dir))


def prior_close_ranked(spark, sf_dir):
    return close.latest_ranked(feed.trades(spark, sf_dir))


def prior_close_ranked_tied(spark, sf_dir):
    return close.latest_ranked(feed.trades(spark, sf_dir, hourly=True))


def prior_close_weekdays(spark, sf_dir):
    trades = feed.trades(spark, sf_dir, weekdays=True)
    return close.prior_day_close(trades, "trading", feed.quotes(spark, sf_dir, weekdays=True))


def prior_close_calendar_weekdays(spark, sf_dir):
    return close.prior_day_close(feed.trades(spark, sf_dir, weekdays=True))


def prior_close_trading_day(spark, sf_dir):
    return close.prior_day_close(
        feed.trades(spark, sf_dir), "trading", feed.quotes(spark, sf_dir)
    )


def prior_close_join(spark, sf_dir):
    return close.join_close(feed.quotes(spark, sf_dir), prior_close(spark, sf_dir))


def price_movement(spark, sf_dir):
    return close.price_movement(feed.quotes(spark, sf_dir), prior_close(spark, sf_dir))


def _sides(spark, sf_dir, **form):
    """Averaged trades, quotes and carried-in trades."""
    averaged = moving.moving_average(feed.trades(spark, sf_dir, **form))
    quotes = feed.quotes(spark, sf_dir, **form)
    return averaged, quotes, enrich.carried_trades(averaged, quotes)


def merged_timeline(spark, sf_dir):
    return asof.merged_timeline(*_sides(spark, sf_dir))


def forward_fill(spark, sf_dir):
    return asof.forward_fill(asof.merged_timeline(*_sides(spark, sf_dir)))


def forward_fill_tied(spark, sf_dir):
    return asof.forward_fill(asof.merged_timeline(*_sides(spark, sf_dir, hourly=True)))


def asof_last_trade(spark, sf_dir):
    return asof.asof_last_trade(*_sides(spark, sf_dir))


def asof_last_trade_strict(spark, sf_dir):
    return asof.asof_last_trade(*_sides(spark, sf_dir), inclusive=False)


def asof_bucketed(spark, sf_dir):
    """Under ties: quotes share an instant with trades."""
    return asof.asof_last_trade(*_sides(spark, sf_dir, hourly=True))


def asof_bucketed_tables(spark, sf_dir):
    """From tables in the same buckets, without trades carried in."""
    averaged = moving.moving_average(feed.trades(spark, sf_dir))
    sides = [
        tables.save_co_partitioned(rows, f"bucketed_{name}", f"latest_{name}", 8, tables.scratch_path(spark, f"bucketed-{name}"))
        for name, rows in (("trade", averaged), ("quote", feed.quotes(spark, sf_dir)))
    ]
    return asof.asof_stored(*sides)


def asof_by_instant(spark, sf_dir):
    """Under ties, strict: a quote does not see the trades of its own instant."""
    return asof.asof_last_trade(*_sides(spark, sf_dir, hourly=True), inclusive=False)


def flagship_enriched_quotes(spark, sf_dir):
    return enrich.enrich_quotes(feed.trades(spark, sf_dir), feed.quotes(spark, sf_dir))


def flagship_tied(spark, sf_dir):
    trades, quotes = feed.trades(spark, sf_dir, hourly=True), feed.quotes(spark, sf_dir, hourly=True)
    return enrich.enrich_quotes(trades, quotes)


def _view(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_staging(feed.trades(spark, sf_dir), feed.quotes(spark, sf_dir), [name])
        return spark.sql(f"SELECT * FROM {name}")

    query.__name__ = f"view_{name}"
    return query


def _status_log(spark, sf_dir, name):
    """A job per exchange: running on all its dates, then failed where a day's trades are few."""
    rows = feed.base(spark, sf_dir).groupBy("exchange", "trade_dt").agg(
        F.sum(F.when(F.col("rec_type") == "T", 1).otherwise(0)).alias("n")
    )
    root = tables.scratch_path(spark, name)
    days: dict[tuple[str, bool], list[dt.date]] = {}
    for r in rows.collect():  # one row per exchange and calendar day
        days.setdefault((r["exchange"], r["n"] % 3 == 0), []).append(r["trade_dt"])
    first = dt.datetime(2024, 7, 1, tzinfo=dt.timezone.utc)
    for (job, failed), dates in days.items():
        end = audit.FAILED if failed else audit.SUCCESS
        for hours, status in enumerate((audit.RUNNING, end)):
            at = first + dt.timedelta(hours=hours)
            audit.append_status(spark, root, f"{job}-{end}", job, status, dates, at)
    return spark.read.schema(audit.STATUS_FIELDS).parquet(root)


def job_status(spark, sf_dir):
    log = _status_log(spark, sf_dir, "job_status")
    return audit.job_status(log, "NYSE-success")


def latest_status_compacted(spark, sf_dir):
    """From a log that was folded after every few of its appends."""
    most, audit.MOST_FILES = audit.MOST_FILES, 2
    try:
        return audit.latest_status(_status_log(spark, sf_dir, "latest_status_compacted"))
    finally:
        audit.MOST_FILES = most


def batch_id(spark, sf_dir):
    """Every landed line carries the batch that the caller has named."""
    first, second = _delivered(spark, sf_dir, "batch_id")
    for conf in (first, second):
        load_raw(spark, conf)
    landed = spark.read.parquet(first.table("landing"))
    return landed.groupBy("batch_id", "partition").agg(F.count(F.lit(1)).alias("row_count"))


def latest_status(spark, sf_dir):
    return audit.latest_status(_status_log(spark, sf_dir, "latest_status"))


def pipeline_end_to_end(spark, sf_dir):
    csv, json = _feed_globs(spark, feed.base(spark, sf_dir), "pipeline")
    root = tables.scratch_path(spark, "pipeline-out")
    return run_pipeline(spark, PipelineConfig(root, [csv], [json], batch_id="batch-1"))


def pipeline_two_batches(spark, sf_dir):
    """All events, then later copies with other prices of each third one in the first third of a month."""
    rows = feed.base(spark, sf_dir)
    root = tables.scratch_path(spark, "two-batches-out")
    early = feed.resent(rows).where(F.dayofmonth("trade_dt") <= 10)
    for batch, part in enumerate((rows, early)):
        csv, json = _feed_globs(spark, part, f"two-batches-{batch}")
        conf = PipelineConfig(
            root, [csv], [json], batch_id=f"batch-{batch}", preset="latest_arrival"
        )
        run_pipeline(spark, conf)
    return spark.read.schema(ENRICHED).parquet(conf.table("enriched")).select(*ENRICHED.names)


def _delivered(spark, sf_dir, name):
    """All feeds as a first batch, then the first third of each month once more as a second one, with its later copies."""
    rows = feed.base(spark, sf_dir)
    root = tables.scratch_path(spark, f"{name}-out")
    csv, json = _feed_globs(spark, rows, name)
    late_csv, late_json = _feed_globs(spark, feed.resent(rows).where(F.dayofmonth("trade_dt") <= 10), f"{name}-late")
    # A file that two globs match, and that two batches deliver, is landed once.
    first = PipelineConfig(root, [csv, csv.replace("/*/*/", "/trade_dt=*/*/")], [json], "batch-0", preset="latest_arrival")
    second = PipelineConfig(root, [csv, late_csv], [json, late_json], "batch-1", preset="latest_arrival")
    return first, second


def quarantine_by_file(spark, sf_dir):
    """Rejected lines per exchange and date of the files they stand in."""
    first, _ = _delivered(spark, sf_dir, "quarantine_by_file")
    load_raw(spark, first)
    part = lambda key: F.regexp_extract("_file", f"{key}=([^/]+)", 1)
    bad = read_quarantine(spark, first)
    return bad.groupBy(
        part("exchange").alias("exchange"), part("trade_dt").cast("date").alias("trade_dt"), F.col("_reason").alias("reason")
    ).agg(F.count(F.lit(1)).alias("row_count"))


def files_seen(spark, sf_dir):
    """Lines that each of two batches has landed; the second one delivers the first one's files again."""
    batches = _delivered(spark, sf_dir, "files_seen")
    for conf in batches:
        load_raw(spark, conf)
    return read_totals(spark, batches[0])


def changed_instruments(spark, sf_dir):
    """What the later copies of a second batch change, by date, instrument and record type."""
    batches = _delivered(spark, sf_dir, "changed_instruments")
    for conf in batches:
        run_pipeline(spark, conf)
    return read_changes(spark, conf).where(F.col("batch_id") == conf.batch_id).drop("batch_id")


def drop_staging(spark, sf_dir):
    """Names that are still in the catalog after the drop, beside those that were there before it."""
    register_staging(feed.trades(spark, sf_dir), feed.quotes(spark, sf_dir))
    names = F.array(*[F.lit(n) for n in sorted(tables.STAGING_NAMES)])
    sizes = [spark.table(n).agg(F.lit(n).alias("name"), (F.count(F.lit(1)) > 0).alias("filled")) for n in tables.STAGING_NAMES]
    before = tables.staged(reduce(DataFrame.unionByName, sizes), "drop_staging")
    tables.drop_staging(spark)
    left = [n for n in tables.STAGING_NAMES if spark.catalog.tableExists(n)]
    gone = ~F.array_contains(F.array(*[F.lit(n) for n in left]).cast("array<string>"), F.col("name"))
    return before.select("name", "filled", gone.alias("dropped")).where(F.array_contains(names, F.col("name")))


VIEWS = tuple(
    _view(name)
    for name in (
        "tmp_trade_moving_avg", "tmp_last_trade", "prev_temp_last_trade", "quotes", "quote_union",
        "quote_update",
    )
)

_ALL: Sequence[Query] = (
    flagship_enriched_quotes, ingest_csv, ingest_json, union_feeds, quarantine_counts,
    scan_partition_trades, scan_partition_quotes, scan_trade_date, symbol_filter,
    roundtrip_partitioned, roundtrip_by_date, roundtrip_enriched, staging_table,
    project_trades, project_quotes, latest_event_time, eod_trades, eod_quotes,
    eod_latest_arrival, eod_as_written, sorted_trades, latest_n_trades, first_n_trades,
    moving_average_180m, moving_average_30m, moving_average_split, sql_moving_average,
    sql_last_trade, last_value_range, last_value_unbounded, dense_rank_latest,
    dense_rank_split, date_functions, prior_close, prior_close_ranked,
    prior_close_trading_day, prior_close_join, price_movement, merged_timeline, forward_fill,
    asof_last_trade, asof_last_trade_strict, asof_bucketed, asof_by_instant, run_audit, latest_status,
    pipeline_end_to_end, flagship_tied, forward_fill_tied, last_value_range_tied, eod_trades_tied,
    eod_quotes_tied, eod_as_written_tied, prior_close_ranked_tied, prior_close_weekdays,
    prior_close_calendar_weekdays, job_status, pipeline_two_batches, symbol_filter_stored, write_once,
    asof_bucketed_tables, quarantine_by_file, files_seen, changed_instruments, drop_staging,
    latest_status_compacted, batch_id, *VIEWS,
)


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(query(spark, sf_dir))

    run.__name__ = query.__name__
    return run


def all_queries() -> dict[str, Query]:
    return {query.__name__: _registered(query) for query in _ALL}
