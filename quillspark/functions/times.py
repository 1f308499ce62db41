"""Dates and times. Instants are UTC; local ones are shifted by Spark's zone rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/Toronto"


def local(ts: Column, zone: str = ZONE) -> Column:
    """Wall-clock time in the zone of a UTC instant."""
    return F.from_utc_timestamp(ts, zone)


def local_date(ts: Column, zone: str = ZONE) -> Column:
    return F.to_date(local(ts, zone))


def abbreviation(ts: Column, zone: str = ZONE, standard: str = "EST", summer: str = "EDT", offset: int = -5) -> Column:
    """Zone name by whether the local time is the standard offset from UTC."""
    hours = (F.unix_timestamp(local(ts, zone)) - F.unix_timestamp(ts)) / 3600
    return F.when(hours == offset, standard).otherwise(summer)


def clock(ts: Column, zone: str = ZONE) -> Column:
    """HH:mm and the zone's abbreviation."""
    return F.concat_ws(" ", F.date_format(local(ts, zone), "HH:mm"), abbreviation(ts, zone))


def ranges(start: Column, end: Column, days: int = 90) -> Column:
    """[start, end] as an array of closed ranges of up to `days` days, each a day behind the one before."""
    firsts = F.sequence(start, end, F.make_interval(days=F.lit(days)))
    return F.transform(firsts, lambda x: F.struct(x.alias("first"), F.least(F.date_add(x, days - 1), end).alias("last")))


def days_back(today: Column, n: int) -> Column:
    """today and the n days before, newest first."""
    return F.sequence(today, F.date_sub(today, n), F.expr("interval -1 day"))


def window_start(today: Column, years: int = 3) -> Column:
    """The day `years` calendar years earlier (29 February becomes the 28th)."""
    return F.add_months(today, -12 * years)


def months_about(day: Column, months: int) -> Column:
    """Months of 30 days."""
    return F.date_add(day, 30 * months)


def ics_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")
