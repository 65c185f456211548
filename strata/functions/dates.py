"""Date and time expressions (F-09, S-10, S-12, S-13, S-16, S-19)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

# Fixed values of the reference: configured format name -> (lenient parse
# pattern, print pattern).  strptime accepts non-padded fields, so the parse
# patterns use single letters, which accept one or two digits.
DATETIME_FORMATS = {
    "YYYY-MM-DD": ("yyyy-M-d", "yyyy-MM-dd"),
    "YYYY-MM-DD HH:mm:ss": ("yyyy-M-d H:m:s", "yyyy-MM-dd HH:mm:ss"),
    "MM/DD/YYYY": ("M/d/yyyy", "MM/dd/yyyy"),
    "DD-MM-YYYY": ("d-M-yyyy", "dd-MM-yyyy"),
}
DEFAULT_FORMAT = "YYYY-MM-DD"


def reformat_datetime(c: Column, fmt_name: str, dtype=None) -> Column:
    """Parse with the configured format, print back in it; bad text -> NULL (F-09).

    An unknown format name falls back to ``YYYY-MM-DD``.  A date/timestamp
    typed column skips the parse.
    """
    parse, out = DATETIME_FORMATS.get(fmt_name, DATETIME_FORMATS[DEFAULT_FORMAT])
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return F.date_format(c, out)
    return F.date_format(F.try_to_timestamp(c.cast("string"), F.lit(parse)), out)


def format_dmy(c: Column) -> Column:
    """``CONVERT(VARCHAR, d, 103)`` -> ``dd/MM/yyyy`` (S-10)."""
    return F.date_format(c, "dd/MM/yyyy")


def shift_hours(ts: Column, hours: Column) -> Column:
    """``DATEADD(HOUR, n, ts)``; fractional hours are dropped, as T-SQL does (S-12)."""
    return F.timestamp_add("HOUR", hours.cast("int"), ts)


def shift_minutes(ts: Column, hours: Column) -> Column:
    """Shift by fractional hours kept as minutes (UTC+5:30 -> 330 minutes);
    an option beside the reference's whole-hour ``DATEADD`` (survey quirk 22)."""
    return F.timestamp_add("MINUTE", F.round(hours * 60).cast("int"), ts)


def wall_minutes(ts: Column) -> Column:
    """Whole minutes of wall-clock time since 1970-01-01 00:00.

    Built from date parts, which are zone-free on ``timestamp_ntz``
    (``timestamp_diff`` resolves a local time through the session zone, so a
    time inside a daylight-saving gap would move by an hour).
    """
    t = ts.cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 1440 + F.hour(t) * 60 + F.minute(t)


def minute_boundaries(start: Column, end: Column) -> Column:
    """``DATEDIFF(MINUTE, a, b)``: number of minute boundaries crossed (S-13).

    Spark's ``timestampdiff`` counts whole elapsed minutes (0 for 10:00:59 ->
    10:01:00).  T-SQL counts boundaries: floor(b / 1 min) - floor(a / 1 min)
    on the wall clock.  (``date_trunc`` would go through the session zone and
    move by an hour across a daylight-saving change.)
    """
    return wall_minutes(end) - wall_minutes(start)


def minus_interval(c: Column, interval: str = "5 minutes") -> Column:
    """``ts - INTERVAL '5 minutes'`` (S-19)."""
    return c - F.expr(f"INTERVAL {interval}")
