"""Integer time axis and date arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MINUTE = 60_000_000
DAY = 24 * 60 * MINUTE


def epoch_micros(df: DataFrame, time: str) -> Column:
    """Microseconds since 1970 of a timestamp column, exact for both kinds.

    A zoned timestamp counts instants. A timestamp without zone counts wall
    clock time and never passes through the session time zone.
    """
    t = F.col(time)
    if not isinstance(df.schema[time].dataType, T.TimestampNTZType):
        return F.unix_micros(t)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = F.hour(t) * 3600 + F.minute(t) * 60
    micros = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    return days * DAY + seconds.cast("bigint") * 1_000_000 + micros


def slice_start(micros: Column, width: int) -> Column:
    """Start of the fixed-width slice a time falls in."""
    return micros - F.pmod(micros, F.lit(width))


def previous_date(day: Column) -> Column:
    return F.date_sub(day, 1)


def next_date(day: Column) -> Column:
    return F.date_add(day, 1)
