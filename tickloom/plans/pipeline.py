"""The daily run: ingest, correct, stage, enrich."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.nullsafe import join_on
from tickloom.operators.correct import load_quotes, load_trades
from tickloom.operators.enrich import enrich_averaged
from tickloom.operators.moving import moving_average
from tickloom.plans import audit
from tickloom.plans.changes import differing, digests
from tickloom.schema import (
    AUDIT,
    AVERAGED_TRADE,
    CHANGED,
    ENRICHED,
    EVENT,
    FILE_AUDIT,
    FILES,
    LANDING,
    PROVENANCE_FIELDS,
    QUARANTINE_FIELDS,
    QUOTE,
    QUOTE_TYPE,
    RUN_DATES,
    SETTINGS,
    SYMBOL_DAY,
    TOTALS,
    TRADE,
    TRADE_TYPE,
)
from tickloom.sources.feeds import BAD_TYPE, delivered_files, exactly, ingest
from tickloom.sources.tables import data_files, delete_files, staged, write_by_date

JOB_NAME = "analytical_etl"


@dataclass(frozen=True)
class PipelineConfig:
    """Inputs, output root and the choices of a run.

    ``dates`` limits correction and enrichment to those trade dates; by default
    all dates that the batch touches are processed.
    """

    out_root: str
    csv_globs: Sequence[str] = ()
    json_globs: Sequence[str] = ()
    batch_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    dates: Sequence[dt.date] | None = None
    preset: str = "reference"
    minutes: int = 180
    inclusive: bool = True
    calendar: str = "calendar"

    def table(self, name: str) -> str:
        return f"{self.out_root.rstrip('/')}/{name}"

    def batch(self, name: str) -> str:
        return f"{self.table(name)}/batch_id={self.batch_id}"

    def settings(self) -> str:
        """What the derived tables depend on besides the events."""
        chosen = (self.preset, self.minutes, self.inclusive, self.calendar)
        return json.dumps(chosen)


def _read(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A table of this pipeline; the declared schema also holds for an empty one."""
    return spark.read.schema(schema).parquet(root).select(*schema.names)


def _found(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A table, or no rows where it was never written."""
    try:
        return _read(spark, root, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def wanted_dates(
    spark: SparkSession, conf: PipelineConfig, part: str, steps: dict[str, Sequence[dt.date]]
) -> list[DataFrame]:
    """The dates of each step as a small table, one row per calendar day.

    A join with it prunes the partitions of a dated table at run time, however many
    dates there are; a list of literals would grow with them.
    """
    rows = spark.createDataFrame([(day, step) for step, days in steps.items() for day in days], "trade_dt date, step string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{conf.batch('run_dates')}/part={part}")
    known = spark.read.schema(RUN_DATES).parquet(conf.table("run_dates"))
    own = known.where((F.col("batch_id") == conf.batch_id) & (F.col("part") == part))
    return [own.where(F.col("step") == step).select("trade_dt") for step in steps]


def on_dates(rows: DataFrame, dates: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(dates), "trade_dt", "left_semi")


def deliveries(spark: SparkSession, conf: PipelineConfig) -> DataFrame:
    """The batch's files with their feed; ``landed`` says that another batch has landed them.

    A file is known by its path, size and time.
    """
    feeds = [
        delivered_files(spark, globs).withColumn("feed", F.lit(feed))
        for feed, globs in (("csv", conf.csv_globs), ("json", conf.json_globs)) if globs
    ]
    if not feeds:
        raise ValueError("no feed given")
    files = feeds[0] if len(feeds) == 1 else feeds[0].unionByName(feeds[1])
    others = _found(spark, conf.table("files"), FILES).where(F.col("batch_id") != conf.batch_id)
    known = others.select(*PROVENANCE_FIELDS.names, F.lit(True).alias("landed")).distinct()
    return files.join(known, PROVENANCE_FIELDS.names, "left").withColumn("landed", F.coalesce("landed", F.lit(False)))


def load_raw(spark: SparkSession, conf: PipelineConfig) -> list[dt.date]:
    """Parse the feeds once into the batch's landing folder, by trade date and record type.

    The ``B`` part is the quarantine. Running the same batch again replaces its
    folder, and with it its rows of every date. Files that another batch has landed are
    left out; the dates of their rows are returned. Totals are counted while the rows
    are written; the counts per file and date are read from the columns they need.
    """
    files = deliveries(spark, conf).collect()  # the paths that a scan's plan holds as well
    paths = {feed: [exactly(f.path) for f in files if f.feed == feed and not f.landed] for feed in ("csv", "json")}
    if any(paths.values()):
        feeds = ingest(spark, paths["csv"], paths["json"], provenance=True)
    else:
        feeds = spark.createDataFrame([], LANDING)
    by = ["trade_dt", "partition"]
    totals = {"row_count": 0, "rejected": 0}
    seen = Observation()
    if any(paths.values()):
        bad = F.count_if(F.col("partition") == BAD_TYPE)
        feeds = feeds.observe(seen, F.count(F.lit(1)).alias("row_count"), bad.alias("rejected"))
    whole = feeds.hint("rebalance", *[F.col(c) for c in by])
    whole.write.mode("overwrite").partitionBy(*by).parquet(conf.batch("landing"))
    if any(paths.values()):
        totals = seen.get
    one = spark.createDataFrame([(totals["row_count"], totals["rejected"])], "row_count bigint, rejected bigint")
    one.coalesce(1).write.mode("overwrite").parquet(conf.batch("totals"))
    parsed = _read(spark, conf.batch("landing"), LANDING)
    per_file = parsed.groupBy("_file", "trade_dt", "exchange", "partition", F.col("_reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    per_file.write.mode("overwrite").parquet(conf.batch("file_audit"))
    per_file = _read(spark, conf.batch("file_audit"), FILE_AUDIT).drop("batch_id")
    counts = per_file.groupBy("trade_dt", "exchange", "partition", "reason").agg(F.sum("row_count").alias("row_count"))
    counts.write.mode("overwrite").parquet(conf.batch("audit"))
    # Last, so that a batch that failed before has landed nothing for others to leave out.
    again = [f for f in files if f.landed]
    names = [n for n in FILES.names if n != "batch_id"]
    new = [tuple(f[n] for n in names) for f in files if not f.landed]
    schema = T.StructType([FILES[n] for n in names])
    spark.createDataFrame(new, schema).coalesce(1).write.mode("overwrite").parquet(conf.batch("files"))
    if not again:
        return []
    known = spark.createDataFrame([(f["_file"],) for f in again], "_file string").distinct()
    return _days(_read(spark, conf.table("file_audit"), FILE_AUDIT).join(known, "_file", "left_semi"))


def read_audit(spark: SparkSession, conf: PipelineConfig) -> DataFrame:
    return _read(spark, conf.table("audit"), AUDIT)


def read_totals(spark: SparkSession, conf: PipelineConfig) -> DataFrame:
    """Lines and rejected lines of every batch, as counted while they were written."""
    return _read(spark, conf.table("totals"), TOTALS)


def read_quarantine(spark: SparkSession, conf: PipelineConfig) -> DataFrame:
    """The batch's rejected lines with their reasons and files."""
    rows = _read(spark, conf.batch("landing"), LANDING).where(F.col("partition") == BAD_TYPE)
    return rows.select(*QUARANTINE_FIELDS.names, *PROVENANCE_FIELDS.names)


def _days(counts: DataFrame) -> list[dt.date]:
    """Distinct trade dates of audit rows: at most one value per calendar day."""
    rows = counts.where(F.col("trade_dt").isNotNull()).select("trade_dt").distinct().collect()
    return sorted(row.trade_dt for row in rows)


def batch_dates(spark: SparkSession, conf: PipelineConfig) -> list[dt.date]:
    """Trade dates of the batch as it was landed last; none if it never was."""
    counts = _found(spark, conf.table("audit"), AUDIT)
    return _days(counts.where(F.col("batch_id") == conf.batch_id))


def landed_dates(spark: SparkSession, conf: PipelineConfig) -> dict[str, list[dt.date]]:
    """By record type the dates for which any batch has accepted rows; correction keeps some of each."""
    counts = _found(spark, conf.table("audit"), AUDIT).where(F.col("trade_dt").isNotNull())
    found: dict[str, list[dt.date]] = {TRADE_TYPE: [], QUOTE_TYPE: []}
    rows = counts.where(F.col("partition").isin(*found)).select("partition", "trade_dt").distinct()
    for row in rows.orderBy("trade_dt").collect():  # two rows per calendar day at most
        found[row["partition"]].append(row["trade_dt"])
    return found


def landed_events(spark: SparkSession, conf: PipelineConfig, rec_type: str, dates: DataFrame) -> DataFrame:
    """Events of all batches. A row that several batches deliver counts as in the one with most of it."""
    schema = T.StructType([*EVENT.fields, T.StructField("batch_id", T.StringType())])
    landed = _read(spark, conf.table("landing"), schema)
    rows = on_dates(landed.where(F.col("partition") == rec_type), dates)
    copies = rows.groupBy(*EVENT.names, "batch_id").agg(F.count(F.lit(1)).alias("_copies"))
    most = copies.groupBy(*EVENT.names).agg(F.max("_copies").alias("_copies"))
    each = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return most.select(*EVENT.names, each.alias("_copy")).drop("_copy")


def replace_dates(
    rows: DataFrame, root: str, dates: Sequence[dt.date], filled: Sequence[dt.date]
) -> None:
    """Replace ``dates`` of a table; those that are not ``filled`` end up with no rows."""
    write_by_date(rows, root)
    empty = rows.drop("trade_dt").limit(0)
    for day in sorted({*dates} - {*filled}):
        empty.coalesce(1).write.mode("overwrite").parquet(f"{root}/trade_dt={day}")


def load_eod(
    spark: SparkSession,
    conf: PipelineConfig,
    rec_type: str,
    dates: Sequence[dt.date],
    wanted: DataFrame,
    filled: Sequence[dt.date],
) -> None:
    """Corrected rows of the type replace those of ``dates``; the instruments that differ are recorded.

    ``wanted`` has the dates as a table, ``filled`` those that have rows of the type.
    """
    name, schema, load = {
        TRADE_TYPE: ("trade", TRADE, load_trades), QUOTE_TYPE: ("quote", QUOTE, load_quotes),
    }[rec_type]
    before = digests(on_dates(_found(spark, conf.table(name), schema), wanted))
    before = staged(before, f"{name}-before")
    rows = load(landed_events(spark, conf, rec_type, wanted), conf.preset)
    replace_dates(rows, conf.table(name), dates, filled)
    after = digests(on_dates(_read(spark, conf.table(name), schema), wanted))
    differing(before, after).write.mode("overwrite").parquet(f"{conf.batch('changes')}/kind={rec_type}")


def read_changes(spark: SparkSession, conf: PipelineConfig) -> DataFrame:
    """Per batch the dates and instruments whose corrected rows its last run has changed, by record type."""
    return _read(spark, conf.table("changes"), CHANGED)


def _own_changes(spark: SparkSession, conf: PipelineConfig) -> DataFrame:
    return read_changes(spark, conf).where(F.col("batch_id") == conf.batch_id)


def _of_symbols(rows: DataFrame, symbols: DataFrame, how: str) -> DataFrame:
    """Rows of the dates and symbols given (``left_semi``) or of all others (``left_anti``)."""
    return join_on(rows, symbols, SYMBOL_DAY, how)


def settled_dates(spark: SparkSession, conf: PipelineConfig) -> set[dt.date]:
    """Dates that were last enriched with the settings of this run, to the end."""
    log = _found(spark, conf.table("settings"), SETTINGS)
    newest = audit.latest_status(log, ("trade_dt",), values=("settings",))
    return {r.trade_dt for r in newest.where(F.col("settings") == conf.settings()).collect()}


def stage_averages(
    spark: SparkSession,
    conf: PipelineConfig,
    dates: Sequence[dt.date],
    wanted: DataFrame,
    fresh: DataFrame,
    filled: Sequence[dt.date],
) -> None:
    """Moving averages of the run's dates, written because later steps and runs read them.

    Only symbols whose trades have changed are averaged again; the others of a date
    are copied, unless it is a ``fresh`` one.
    """
    trades = on_dates(_read(spark, conf.table("trade"), TRADE), wanted)
    changed = _own_changes(spark, conf).where(F.col("kind") == TRADE_TYPE).select(*SYMBOL_DAY)
    todo = staged(changed.unionByName(on_dates(trades, fresh).select(*SYMBOL_DAY)).distinct(), "average-todo")
    stored = on_dates(_found(spark, conf.table("trade_moving_avg"), AVERAGED_TRADE), wanted)
    again = moving_average(_of_symbols(trades, todo, "left_semi"), conf.minutes)
    # The files that are copied go when all new ones are there: a dynamic overwrite commits them together.
    rows = again.unionByName(_of_symbols(stored, todo, "left_anti"))
    replace_dates(rows, conf.table("trade_moving_avg"), dates, filled)


def prior_date(day: dt.date, traded: Sequence[dt.date], calendar: str) -> dt.date | None:
    """The date whose close quotes of ``day`` see."""
    if calendar == "calendar":
        return day - dt.timedelta(days=1)
    return max((t for t in traded if t < day), default=None)


def affected_dates(
    dates: Sequence[dt.date], traded: Sequence[dt.date], quoted: Sequence[dt.date], calendar: str
) -> list[dt.date]:
    """``dates`` and the later quote dates whose prior close may have changed with them."""
    found = {*dates}
    for day in quoted:
        prior = prior_date(day, traded, calendar)
        # A changed date that no longer trades has moved the prior date to an earlier one.
        if any(d < day and (prior is None or d >= prior) for d in dates):
            found.add(day)
    return sorted(found)


def record_settings(spark: SparkSession, conf: PipelineConfig, dates: Sequence[dt.date], settings: str) -> None:
    """Log what ``dates`` are enriched with; an empty text while that is under way."""
    now = dt.datetime.now(dt.timezone.utc)
    rows = spark.createDataFrame([(d, settings, now) for d in dates], SETTINGS)
    root = conf.table("settings")
    rows.coalesce(1).write.mode("append").parquet(root)
    old = data_files(spark, root)
    if len(old) > audit.MOST_FILES:  # as the status log is folded
        log = spark.read.schema(SETTINGS).parquet(*old)
        newest = audit.latest_status(log, ("trade_dt",), values=("settings",)).select(*SETTINGS.names)
        newest.coalesce(1).write.mode("append").parquet(root)
        delete_files(spark, old)


def analyze(
    spark: SparkSession,
    conf: PipelineConfig,
    dates: Sequence[dt.date],
    landed: dict[str, list[dt.date]],
    settled: set[dt.date] = frozenset(),
    traded_before: Sequence[dt.date] = (),
) -> list[dt.date]:
    """Enriched quotes of the run's dates and of the dates that see their close; returns these dates.

    Symbols whose quotes, trades or prior close have changed are enriched again. The
    others are copied, unless the date has another prior date now or is not ``settled``.
    """
    traded, quoted = landed[TRADE_TYPE], landed[QUOTE_TYPE]
    wanted = affected_dates(dates, traded, quoted, conf.calendar)
    prior = {day: prior_date(day, traded, conf.calendar) for day in wanted}
    moved = [d for d in wanted if d not in settled or prior_date(d, traded_before, conf.calendar) != prior[d]]
    averages, unsettled, targets, seen, fresh = wanted_dates(spark, conf, "analysis", {
        "average": dates, "average-fresh": [d for d in dates if d not in settled],
        "enrich": wanted, "enrich-seen": sorted({*wanted, *prior.values()} - {None}), "enrich-fresh": moved,
    })
    stage_averages(spark, conf, dates, averages, unsettled, traded)
    quotes = on_dates(_read(spark, conf.table("quote"), QUOTE), targets)
    averaged = on_dates(_read(spark, conf.table("trade_moving_avg"), AVERAGED_TRADE), seen)
    changes = _own_changes(spark, conf)
    # One row per calendar day.
    days = spark.createDataFrame([(d, p) for d, p in prior.items() if p is not None], "trade_dt date, prior_dt date")
    later = days.select(F.col("prior_dt").alias("trade_dt"), F.col("trade_dt").alias("later_dt"))
    closes = changes.where(F.col("kind") == TRADE_TYPE).join(F.broadcast(later), "trade_dt")
    closes = closes.select(F.col("later_dt").alias("trade_dt"), "stock_symbol")
    todo = changes.select(*SYMBOL_DAY).unionByName(closes).unionByName(on_dates(quotes, fresh).select(*SYMBOL_DAY))
    todo = staged(todo.distinct(), "enrich-todo")
    before = todo.join(F.broadcast(days), "trade_dt").select(F.col("prior_dt").alias("trade_dt"), "stock_symbol")
    needed = _of_symbols(averaged, todo.unionByName(before).distinct(), "left_semi")
    again = enrich_averaged(needed, _of_symbols(quotes, todo, "left_semi"), conf.inclusive, conf.calendar, days)
    stored = on_dates(_found(spark, conf.table("enriched"), ENRICHED), targets)
    rows = again.unionByName(_of_symbols(stored, todo, "left_anti"))
    replace_dates(rows, conf.table("enriched"), wanted, quoted)
    record_settings(spark, conf, wanted, conf.settings())
    return wanted


def run_pipeline(spark: SparkSession, conf: PipelineConfig) -> DataFrame:
    """Run all steps in order and return the enriched quotes of the dates it has replaced.

    The dates that the batch touches, now or when it was landed before, are corrected
    from the events of all batches and replaced, and the dates after them that see
    their close are enriched again. Each step reads the tables of the one before, so a
    lost executor costs only the tasks of the running step. A step that fails ends
    the run: its status is logged as failed and the error is raised.
    """
    log = conf.table("job_status")
    dates = sorted(conf.dates or [])
    started = False
    try:
        before = batch_dates(spark, conf)
        traded = landed_dates(spark, conf)[TRADE_TYPE]
        again = load_raw(spark, conf)
        dates = dates or sorted({*before, *again, *batch_dates(spark, conf)})
        audit.append_status(spark, log, conf.batch_id, JOB_NAME, audit.RUNNING, dates)
        started = True
        settled = settled_dates(spark, conf)
        landed = landed_dates(spark, conf)
        # Until they are enriched again these dates are of no use to a later run.
        record_settings(spark, conf, affected_dates(dates, landed[TRADE_TYPE], landed[QUOTE_TYPE], conf.calendar), "")
        (wanted,) = wanted_dates(spark, conf, "correction", {"correct": dates})
        load_eod(spark, conf, TRADE_TYPE, dates, wanted, landed[TRADE_TYPE])
        load_eod(spark, conf, QUOTE_TYPE, dates, wanted, landed[QUOTE_TYPE])
        enriched = analyze(spark, conf, dates, landed, settled, traded)
    except Exception:
        # Without any date known the failure is filed under the day of the run.
        known = dates if started or dates else [dt.datetime.now(dt.timezone.utc).date()]
        audit.append_status(spark, log, conf.batch_id, JOB_NAME, audit.FAILED, known)
        raise
    audit.append_status(spark, log, conf.batch_id, JOB_NAME, audit.SUCCESS, dates)
    (result,) = wanted_dates(spark, conf, "result", {"result": enriched})
    return on_dates(_read(spark, conf.table("enriched"), ENRICHED), result).select(*ENRICHED.names)
