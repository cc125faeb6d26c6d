"""Dates from epochs, calendar parts and labels.

Epoch arithmetic is done on plain seconds, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmarts.functions import lookups as L

DAY_SECONDS = 86_400


def epoch_to_date(seconds: Column) -> Column:
    """UTC date of an epoch-second number."""
    return F.date_from_unix_date(F.floor(seconds / DAY_SECONDS).cast("int"))


def date_to_epoch(day: Column) -> Column:
    """Epoch second of a date's first instant, UTC."""
    return F.unix_date(day).cast("bigint") * DAY_SECONDS


def timestamp_to_epoch(ts: Column) -> Column:
    """Epoch second of a zone-less timestamp read as UTC."""
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return date_to_epoch(F.to_date(ts)) + clock


def local_to_epoch(ts: Column, zone: str = L.LOCAL_ZONE) -> Column:
    """Epoch second of a zone-less wall-clock time in ``zone``."""
    return timestamp_to_epoch(F.convert_timezone(F.lit(zone), F.lit("UTC"), ts))


def day_of(value: Column) -> Column:
    """DATE_TRUNC(.., DAY): the identity on a date."""
    return F.to_date(value)


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.trunc(day, "week")


def week_end(day: Column) -> Column:
    """Sunday of the week."""
    return F.date_add(week_start(day), 6)


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def week_range(day: Column) -> Column:
    return F.concat(iso_date(week_start(day)), F.lit(" / "), iso_date(week_end(day)))


def year_month_label(year: Column, month: Column) -> Column:
    """``2024/3``: the month is not padded."""
    return F.concat(year.cast("string"), F.lit("/"), month.cast("string"))
