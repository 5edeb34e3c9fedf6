"""Time expressions. ``now`` and ``today`` are always arguments, never the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

DAYS_PER_WEEK = 7


def time_slice(moment: Column, width_seconds: int) -> Column:
    """Index of the fixed-width slice of time that holds ``moment``.

    Counted from the difference to a fixed moment, so that times without a zone
    do not pass through the session's zone and its clock changes.
    """
    since = moment - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (
        F.extract(F.lit("DAY"), since).cast("bigint") * 86400
        + F.extract(F.lit("HOUR"), since) * 3600
        + F.extract(F.lit("MINUTE"), since) * 60
        + F.extract(F.lit("SECOND"), since)
    )
    return F.floor(F.floor(seconds).cast("bigint") / F.lit(width_seconds))


def minutes_between(earlier: Column, later: Column) -> Column:
    """Number of minute boundaries crossed, so 10:00:59 to 10:01:00 is one minute."""
    return time_slice(later, 60) - time_slice(earlier, 60)


def seconds_of_day(moment: Column) -> Column:
    """Time of day in seconds, fraction included."""
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.extract(F.lit("SECOND"), moment)


def on_day(day: Column, clock: Column) -> Column:
    """The time of day of ``clock`` on ``day``, to the second."""
    midnight = day.cast("timestamp_ntz")
    return midnight + F.make_dt_interval(F.lit(0), F.hour(clock), F.minute(clock), F.second(clock).cast("decimal(18,6)"))


def weekday_index(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(day) - 1


def weekday_index_of(day: dt.date) -> int:
    return day.isoweekday() % DAYS_PER_WEEK


def days_until_weekday(weekday: Column, today: dt.date) -> Column:
    """Days from ``today`` to the next such weekday; 0 if it is today."""
    return F.pmod(weekday - F.lit(weekday_index_of(today)), F.lit(DAYS_PER_WEEK))


def timestamp_lit(moment: dt.datetime) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def date_lit(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("date")
