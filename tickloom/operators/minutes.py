"""The minute index: what an instrument's last values are at any time of a minute.

A row of the index stands for a group, a minute and a page. It holds the instants of
that minute in order, each with the last values up to it, and beside them what the
minutes before have left. Only instants with values are in it; a minute that is merely
asked about has a row without them, so every asker finds one.

A page has ``WIDTH`` instants at most, whatever the minute holds: a busy minute has
several, each with the span of time it answers for, and an asker meets the one whose span
has its time. All data take the same way. A task thus never holds more of a group than
the instants of a minute, and an asker meets the index in one inner join on group and
minute, whose partitions Spark can split on the askers' side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.timeaxis import MINUTE, epoch_micros, slice_start

#: Instants of a page.
WIDTH = 64
#: The time of rows without one: before all others.
NEVER = -(1 << 62)


def timed(rows: DataFrame, time: str) -> DataFrame:
    """``rows`` with ``_us`` and the minute it falls in as ``_slice``; neither is ever null."""
    rows = rows.withColumn("_us", F.coalesce(epoch_micros(rows, time), F.lit(NEVER)))
    # Declared as never null, so that no join adds a filter and plans that share an exchange stay alike.
    return rows.withColumn("_slice", F.coalesce(slice_start(F.col("_us"), MINUTE), F.lit(NEVER)))


def group_key(by: Sequence[str]) -> Column:
    """The group as one value: structs are equal where nulls inside are, and are never null.

    Joining on them needs no null-safe comparison, so it can use the partitioning of
    an aggregate or a window on the same column.
    """
    return F.struct(*by)


def pages(entries: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Per group, minute and page: ``_list`` of (``us``, ``v``) in order, the span ``_from``, ``_to`` and ``_end``.

    ``entries`` has one row per group and instant; ``value`` may use ``so_far(keys)``.
    The first page of a minute answers for all times before its second one, the last
    page for all times after its first instant. ``_end`` is the last value of a page.
    """
    minute = [*keys, "_slice"]
    in_order = Window.partitionBy(*minute).orderBy("_us")
    numbered = entries.select(
        *minute,
        F.floor((F.row_number().over(in_order) - 1) / WIDTH).alias("_page"),
        F.struct(F.col("_us").alias("us"), value.alias("v"), F.lead("_us").over(in_order).alias("next")).alias("_e"),
    )
    listed = numbered.groupBy(*minute, "_page").agg(
        F.sort_array(F.collect_list(F.struct("_e.us", "_e.v"))).alias("_list"), F.max("_e").alias("_last")
    )
    return listed.select(
        *minute, "_list", F.expr("IF(_page > 0, _list[0].us, NULL) AS _from"),
        F.col("_last.next").alias("_to"), F.col("_last.v").alias("_end"),
    )


def so_far(keys: Sequence[str]) -> WindowSpec:
    """The instants of a minute up to the current one."""
    in_order = Window.partitionBy(*keys, "_slice").orderBy("_us")
    return in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def look_up(
    askers: DataFrame, index: DataFrame, keys: Sequence[str], out: str = "_found", how: str = "inner"
) -> DataFrame:
    """Each asker with the columns of its page, and as ``out`` the values at ``_seen`` (microseconds) or before it.

    ``_slice`` is the minute asked about; ``out`` is null where it has no instant that early.
    """
    minute = [*keys, "_slice"]
    other = index.withColumnsRenamed({k: f"_r{k}" for k in minute})
    same = " AND ".join(f"{k} = _r{k}" for k in minute)
    joined = askers.join(
        other, F.expr(f"{same} AND (_from IS NULL OR _seen >= _from) AND (_to IS NULL OR _seen < _to)"), how
    )
    return joined.withColumn(out, F.expr("try_element_at(filter(_list, e -> e.us <= _seen), -1).v"))


def value_index(
    values: DataFrame, marks: DataFrame, keys: Sequence[str], columns: Sequence[str], spread: Sequence[str] = ()
) -> DataFrame:
    """The index of the last non-null value of each column of ``values``.

    Both frames are ``timed`` and have the key columns; the rows of ``marks`` only say
    which minutes are asked about. The values of an instant are those of the highest
    ``event_seq_nb``. Columns in ``spread`` hold at most one distinct value per group,
    which all its rows get. A value left by the minutes before is in ``_carry_<column>``.
    """
    keys = list(keys)
    minute = [*keys, "_slice"]
    some = " OR ".join(f"{c} IS NOT NULL" for c in (*columns, *spread))
    valued = values.where(some)
    at = [F.expr(f"max(IF({c} IS NOT NULL, struct(event_seq_nb, {c}), NULL)).{c} AS {c}") for c in columns]
    instants = valued.groupBy(*minute, "_us").agg(*at, *[F.max(c).alias(c) for c in spread])
    own = so_far(keys)
    value = F.struct(
        *[F.last(c, ignorenulls=True).over(own).alias(c) for c in columns], *[F.max(c).over(own).alias(c) for c in spread]
    )
    found = pages(instants, keys, value)
    asked = marks.select(*minute).distinct()
    ends = found.where("_to IS NULL").select(*minute, "_end").unionByName(asked, allowMissingColumns=True)
    ends = ends.repartition(*keys).groupBy(*minute).agg(F.max("_end").alias("_end"))
    in_order = Window.partitionBy(*keys).orderBy("_slice")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = ends.select(
        *minute,
        *[F.last(f"_end.{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in columns],
        *[F.max(f"_end.{c}").over(whole).alias(c) for c in spread],
    )
    return carried.join(found.drop("_end"), minute, "left")
