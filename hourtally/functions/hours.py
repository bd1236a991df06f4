"""Event times and hour labels, in the zone of the session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_FORMAT = "yyyy-MM-dd HH:00:00"

# Event times a timestamp can hold, about 292,000 years either way.
LATEST_MS = 9_223_372_036_854_000
EARLIEST_MS = -LATEST_MS


def in_range(ms: Column) -> Column:
    return ms.between(EARLIEST_MS, LATEST_MS)


def event_time(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(ms)


def epoch_ms(time: Column) -> Column:
    """Timestamp (with or without zone) to epoch milliseconds."""
    return F.unix_millis(time.cast("timestamp"))


def hour_bucket(time: Column) -> Column:
    """Timestamp to its hour label, row by row."""
    return F.date_format(time, HOUR_FORMAT)


def hour_number(time: Column) -> Column:
    """Timestamp to a number that stands for its hour label.

    There is exactly one number per label, in every zone: the hour repeated when
    clocks go back has one label and one number. Grouping on this integer and
    labelling the few result rows is cheaper than formatting every record.
    """
    return F.unix_date(time.cast("date")).cast("bigint") * 24 + F.hour(time)


def hour_label(number: Column) -> Column:
    """The label of an hour number: ``hour_label(hour_number(t)) = hour_bucket(t)`` for the
    years 1 to 9999. Other years are written with a sign, and at least four digits.
    """
    day = F.date_from_unix_date(F.floor(number / 24).cast("int"))
    month, date, hour = (
        F.lpad(n.cast("string"), 2, "0") for n in (F.month(day), F.dayofmonth(day), F.pmod(number, F.lit(24)))
    )
    year = F.year(day)
    sign = F.when(year < 1, "-").when(year > 9999, "+").otherwise("")
    digits = F.abs(year).cast("string")
    shown = F.concat(sign, F.lpad(digits, F.greatest(F.length(digits), F.lit(4)), F.lit("0")))
    return F.concat(shown, F.lit("-"), month, F.lit("-"), date, F.lit(" "), hour, F.lit(":00:00"))
