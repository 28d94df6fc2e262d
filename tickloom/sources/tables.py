"""Partitioned Parquet tables, staging tables and views.

Paths are any Hadoop file-system URI; credentials belong to the Spark
configuration. Writes replace only the partitions they contain, so a date can be
loaded again without touching the others.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.timeaxis import MINUTE, epoch_micros, slice_start
from tickloom.schema import INSTRUMENT_DAY

# Names the staging step owns.
STAGING_NAMES = (
    "tmp_trade_moving_avg",
    "temp_trade_moving_avg",
    "tmp_last_trade",
    "temp_last_trade",
    "prev_temp_last_trade",
    "quotes",
    "quote_union",
    "quote_update",
)


def write_partitioned(df: DataFrame, root: str, by: Sequence[str]) -> None:
    """Replace the partitions present in ``df``; an empty frame changes nothing.

    Rows are rebalanced on the partition columns first: each date comes out in a
    few full-sized files, and a date with most of the rows is split over tasks.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(root)
    )


def write_by_date(df: DataFrame, root: str, date: str = "trade_dt") -> None:
    write_partitioned(df, root, [date])


def partition_values(spark: SparkSession, root: str, by: str) -> set[str]:
    """Values of the first partition column that have a folder below ``root``, as their folders spell them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return set()
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    return {n.removeprefix(f"{by}=") for n in names if n.startswith(f"{by}=")}


def data_files(spark: SparkSession, root: str) -> list[str]:
    """Paths of the files directly below ``root`` that Spark would read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = [s.getPath() for s in files.listStatus(path) if s.isFile()]
    return sorted(p.toString() for p in found if p.getName()[0] not in "_.")


def delete_files(spark: SparkSession, paths: Sequence[str]) -> None:
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def write_once(df: DataFrame, root: str, date: str = "trade_dt") -> None:
    """Add new dates to a table; with a date that is already there nothing is written.

    The dates of ``df``, one per calendar day, are compared with the folders before the
    write, which raises ``FileExistsError`` and names them.
    """
    wanted = {str(r[0]) for r in df.select(F.col(date).cast("string")).distinct().collect()}
    there = sorted(wanted & partition_values(df.sparkSession, root, date))
    if there:
        raise FileExistsError(f"{root} already holds {date} {', '.join(there)}")
    df.hint("rebalance", F.col(date)).write.mode("append").partitionBy(date).parquet(root)


# The order of rows within a written date.
CLUSTER_ORDER = ("stock_symbol", "latest_trade", "latest_quote", "event_seq_nb")


def write_clustered(
    df: DataFrame, root: str, date: str = "trade_dt", order: Sequence[str] = CLUSTER_ORDER
) -> None:
    """Replace the dates in ``df``, each in order of symbol, time and sequence over its files.

    Rows are dealt out by ranges of date and order, so a file holds a stretch of the
    symbols and the statistics of its row groups rule out the others. A range may end
    within a symbol: one with most of the rows is spread over several files.
    """
    by = [date, *[c for c in order if c in df.columns]]
    (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date)
        .parquet(root)
    )


def save_co_partitioned(
    df: DataFrame, name: str, time: str, buckets: int, path: str | None = None
) -> DataFrame:
    """Write a catalog table by ``day`` in buckets of date, instrument and ``minute``, and read it back.

    ``day`` repeats the trade date, for pruning; ``minute`` is the start of the row's
    minute in microseconds. Two tables with the same number of buckets join on date,
    instrument and minute without a shuffle, and an instrument with most of the rows
    is spread over the buckets by its minutes. Each bucket of a day is one file.
    """
    keys = [*INSTRUMENT_DAY, "minute"]
    rows = df.withColumns(
        {"minute": slice_start(epoch_micros(df, time), MINUTE), "day": F.col(INSTRUMENT_DAY[0])}
    )
    df.sparkSession.catalog.dropTempView(name)
    writer = rows.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.partitionBy("day").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def read_partition(spark: SparkSession, root: str, partition: str) -> DataFrame:
    """One record type of the event table; the other types' files are not listed."""
    return spark.read.parquet(root).where(F.col("partition") == partition)


def read_dates(
    spark: SparkSession, root: str, dates: Sequence[dt.date | str], date: str = "trade_dt"
) -> DataFrame:
    """The given dates of a date-partitioned table."""
    wanted = [F.lit(str(d)).cast("date") for d in dates]
    return spark.read.parquet(root).where(F.col(date).isin(*wanted))


def save_staging(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a catalog table, replacing an older table or view, and read it back."""
    df.sparkSession.catalog.dropTempView(name)  # a view would hide the table
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Make frames available to SQL under the given names."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def drop_staging(spark: SparkSession, names: Sequence[str] = STAGING_NAMES) -> None:
    """Drop staging views and tables that exist."""
    for name in names:
        spark.catalog.dropTempView(name)
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of the session.

    That is ``spark.checkpoint.dir``, or else what ``setCheckpointDir`` was given.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new scratch folder that is deleted after the block, with all tables in it.

    For tables that only the block reads: what it returns must be written elsewhere.
    """
    root = scratch_path(spark, name)
    try:
        yield root
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a frame to a new scratch folder, or below ``folder``, and read it back.

    For a frame several branches read: it is computed once, and the loss of an
    executor does not compute it again.
    """
    path = scratch_path(df.sparkSession, name) if folder is None else f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
