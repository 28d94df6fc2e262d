"""Run records: what a batch accepted and rejected, and the status of each job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schema import AUDIT
from tickloom.sources.tables import data_files, delete_files

STATUS_FIELDS = "job_id string, job_name string, status string, trade_date date, updated_tm timestamp"

# The states a job can be in.
RUNNING = "running"
SUCCESS = "success"
FAILED = "failed"

#: Files of a status log; beyond that many it is folded.
MOST_FILES = 64


def run_audit(events: DataFrame, batch_id: str) -> DataFrame:
    """Row counts of one batch per date, exchange, partition and rejection reason."""
    return (
        events.groupBy("trade_dt", "exchange", "partition", F.col("_reason").alias("reason"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("batch_id", F.lit(batch_id))
        .select(*AUDIT.names)
    )


def quarantine_counts(events: DataFrame) -> DataFrame:
    """Rejected lines per reason."""
    return (
        events.where(F.col("_reason").isNotNull())
        .groupBy(F.col("_reason").alias("reason"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def append_status(
    spark: SparkSession,
    root: str,
    job_id: str,
    job_name: str,
    status: str,
    trade_dates: Sequence[dt.date],
    at: dt.datetime | None = None,
) -> None:
    """Add one status row per trade date to the log, now or with the time given.

    Earlier rows stay until the log has more than ``MOST_FILES`` files; it is then folded.
    """
    at = at or dt.datetime.now(dt.timezone.utc)
    rows = [(job_id, job_name, status, day, at) for day in trade_dates]
    if not rows:
        return
    spark.createDataFrame(rows, STATUS_FIELDS).coalesce(1).write.mode("append").parquet(root)
    if len(data_files(spark, root)) > MOST_FILES:
        compact_status(spark, root)


def compact_status(spark: SparkSession, root: str) -> None:
    """Fold a status log into one file with the newest row of each job, run and trade date.

    The new file is there before the old ones go. If that is cut short some rows are in
    the log twice, which changes no status. One writer at a time, as for appending.
    """
    old = data_files(spark, root)
    if not old:
        return
    log = spark.read.schema(STATUS_FIELDS).parquet(*old)
    newest = latest_status(log, ("job_id", "job_name", "trade_date"), values=("status",))
    names = [field.split()[0] for field in STATUS_FIELDS.split(", ")]
    newest.select(*names).coalesce(1).write.mode("append").parquet(root)
    delete_files(spark, old)


def latest_status(
    log: DataFrame,
    job: Sequence[str] = ("job_name", "trade_date"),
    updated: str = "updated_tm",
    values: Sequence[str] = ("status", "job_id"),
) -> DataFrame:
    """The newest log row of each job."""
    newest = F.max(F.struct(updated, *values)).alias("_newest")
    return log.groupBy(*job).agg(newest).select(*job, "_newest.*")


def job_status(log: DataFrame, job_id: str) -> DataFrame:
    """The newest status of one job id."""
    return latest_status(log.where(F.col("job_id") == job_id), ("job_id",), values=("status",))
