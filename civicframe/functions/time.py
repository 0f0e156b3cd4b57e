"""Dates and local times. Zone-less timestamps are UTC; nothing depends on the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Europe/Berlin"
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def local(utc: Column, zone: str = ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))


def day_name(ts: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAYS]), F.weekday(ts) + 1)


def hour(ts: Column) -> Column:
    return F.hour(ts)


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def has_time(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss") != "00:00:00"


def coerced(text: Column) -> Column:
    """A date or timestamp from text; null where it can't be read."""
    return F.try_to_timestamp(text)


#: Date, optional time, fraction and offset, as ISO 8601 has them.
ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"


def is_iso(text: Column) -> Column:
    return text.rlike(ISO) & F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd").isNotNull()


def duration(seconds: Column) -> Column:
    """struct<h, m, s>"""
    s = seconds.cast("long")
    return F.struct(F.floor(s / 3600).alias("h"), F.floor(s % 3600 / 60).alias("m"), (s % 60).alias("s"))
