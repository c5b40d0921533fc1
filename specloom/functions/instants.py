"""Instants from ISO 8601 text in any zone and spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"^\d{4}-\d{2}-\d{2}"
_ZONED = r"(?i)(z|[+-]\d{2}(:?\d{2})?)$"


def instant(text: Column) -> Column:
    """Timestamp of ISO text. Surrounding blanks are ignored, a bare date is midnight UTC, a time without a zone is UTC.

    Null, empty and unreadable text give null; never raises under ANSI mode.
    """
    s = F.upper(F.trim(text))
    bare = F.length(s) == 10
    zoned = ~bare & s.rlike(_ZONED)
    full = F.when(zoned, s).when(bare, F.concat(s, F.lit("T00:00:00Z"))).otherwise(F.concat(s, F.lit("Z")))
    return F.when(s.rlike(_DATE), full.try_cast("timestamp"))


def instant_micros(text: Column) -> Column:
    """``instant`` as microseconds since 1970, a long."""
    return F.unix_micros(instant(text))


def _in_utc(ts: Column, pattern: str) -> Column:
    """A timestamp's UTC wall clock as text, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), pattern)


def utc_month(ts: Column) -> Column:
    """``YYYY-MM`` of a timestamp in UTC."""
    return _in_utc(ts, "yyyy-MM")


def utc_seconds_text(micros: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of microseconds since 1970."""
    return _in_utc(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss'Z'")
