"""Instants and UTC days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratafold import fixed_values as fv


def parse_instant(text: Column) -> Column:
    """ISO date or date-time text as an instant; text without an offset is UTC.

    Plain string functions rather than patterns: this runs several times a row.
    """
    clean = F.btrim(text, F.lit(fv.WHITE_SPACE))
    dated = (F.substring(clean, 5, 1) == "-") & (F.substring(clean, 8, 1) == "-")
    clock = F.substr(clean, F.lit(11))
    has_offset = F.contains(clock, F.lit("+")) | F.contains(clock, F.lit("-")) | F.upper(clock).endswith("Z")
    in_utc = F.when(clock == "", F.concat(clean, F.lit("T00:00:00Z"))).otherwise(F.concat(clean, F.lit("Z")))
    return F.when(dated, F.when(has_offset, F.upper(clean)).otherwise(in_utc)).try_cast("timestamp")


def utc_date(instant: Column) -> Column:
    """The UTC day of an instant, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def day_literal(day: dt.date) -> Column:
    return F.lit(day).cast("date")


def utc_day(instant: dt.datetime) -> dt.date:
    """The UTC day of a run's instant; a naive value is taken as UTC."""
    return instant.date() if instant.tzinfo is None else instant.astimezone(dt.timezone.utc).date()


def instant_literal(instant: dt.datetime) -> Column:
    """One instant for a whole run; a naive value is taken as UTC."""
    if instant.tzinfo is None:
        instant = instant.replace(tzinfo=dt.timezone.utc)
    return F.lit(instant.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")
