"""Wall-clock time from text or timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WALL_CLOCK = "yyyy-MM-dd HH:mm:ss"

_ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?"
    r"(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?$"
)


def wall_clock(value: Column) -> Column:
    """ISO-8601 text to ``yyyy-MM-dd HH:mm:ss``, NULL where it is no date.

    The clock reading is kept as written: an offset or ``Z`` is dropped, never
    applied, so the result does not depend on the session time zone.
    """
    short = F.regexp_extract(value, r"^.{10}[T ]([\d:]+)", 1)
    padded = F.concat(short, F.substring(F.lit("00:00:00"), F.length(short) + 1, F.lit(8)))
    has_seconds = F.substring(value, 17, 1) == ":"
    time = F.when(has_seconds, F.substring(value, 12, 8)).otherwise(padded)
    stamp = F.concat(F.substring(value, 1, 10), F.lit(" "), time)
    return F.when(value.rlike(_ISO), stamp.try_cast("timestamp_ntz").cast("string"))


def clock_text(value: Column, kind: T.DataType) -> Column:
    """A date column of any type in the export form, bad values to NULL."""
    if isinstance(kind, T.TimestampType):
        return F.date_format(value, WALL_CLOCK)
    return wall_clock(value.cast("string"))
