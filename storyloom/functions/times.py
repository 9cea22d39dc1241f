"""Epoch seconds; display in Taipei time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAIPEI = "Asia/Taipei"


def seconds(c: Column) -> Column:
    """Whole seconds: milliseconds are brought down, what is no number is 0."""
    n = F.try_cast(c, "bigint") if hasattr(F, "try_cast") else c.try_cast("bigint")
    n = F.coalesce(n, c.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.when(n > 1_000_000_000_000, F.floor(n / 1000)).otherwise(n).cast("bigint")


def clamp_future(c: Column, now: int, grace: int = 86_400) -> Column:
    return F.when(c > now + grace, F.lit(now).cast("bigint")).otherwise(c)


def days_ago(now: int, days: int) -> int:
    return now - days * 86_400


def taipei(c: Column) -> Column:
    """yyyy-MM-dd HH:mm:ss+0800; null as "None"."""
    shown = F.date_format(F.from_utc_timestamp(F.timestamp_seconds(c), TAIPEI), "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(F.concat(shown, F.lit("+0800")), F.lit("None"))


def utc(c: Column, form: str = "yyyy-MM-dd HH:mm:ss 'UTC'") -> Column:
    return F.date_format(F.timestamp_seconds(c), form)


def moment(c: Column) -> Column:
    """Epoch seconds of a text: a number counts as such (milliseconds brought down), a date with a zone as it says, one
    without as UTC. Null where it is neither."""
    number = c.try_cast("double")
    whole = F.when(number > 1_000_000_000_000, F.floor(number / 1000)).otherwise(F.floor(number)).cast("bigint")
    return F.coalesce(whole, F.unix_seconds(F.try_to_timestamp(F.trim(c))))


def wall_clock(c: Column) -> Column:
    """Epoch seconds of a timestamp without a zone, taken as Taipei's wall clock."""
    return F.unix_seconds(F.to_utc_timestamp(c.cast("timestamp"), TAIPEI))
