"""Text to typed values.

The session runs in ANSI mode by default, where a plain cast of bad text throws. Everything here
returns null for text that does not parse, so one bad record never fails a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the form report dates have in the source files.
REPORT_TS_PATTERN = "MM/dd/yyyy hh:mm:ss a"

# The same, unpadded or without a time, as a reader takes it under any parser policy of the session.
_READ_PATTERNS = ("M/d/yyyy h:mm:ss a XXX", "M/d/yyyy XXX")


def parse_report_ts(text: Column) -> Column:
    """Report date text, with or without a time, to ``timestamp_ntz``; null when it is not a date.

    The text is read as UTC whatever the session zone is, so no daylight-saving gap moves a value.
    """
    zoned = F.concat(F.trim(text), F.lit(" +00:00"))
    instant = F.coalesce(*(F.try_to_timestamp(zoned, F.lit(p)) for p in _READ_PATTERNS))
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)


def parse_money(text: Column) -> Column:
    """``$12,345`` to 12345.0."""
    return F.regexp_replace(text, "[$,]", "").try_cast("double")


def parse_double(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def parse_int(text: Column) -> Column:
    """``' 01 '`` and ``1.0`` to 1; null for a fraction that isn't zero."""
    number = F.trim(text).try_cast("decimal(20,6)")
    return F.when(number == F.floor(number), number).try_cast("int")


def area_key(text: Column) -> Column:
    """Zero-padded text matches a numeric precinct."""
    return parse_int(text)


def strip_leading_zeros(text: Column) -> Column:
    """Text form of the area key, for joins on a key that stays text. ``'00'`` becomes empty."""
    return F.ltrim(F.trim(text), F.lit("0"))
