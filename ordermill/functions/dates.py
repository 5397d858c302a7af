"""Date parts of a purchase timestamp that arrives as text.

Every part is derived from a DATE. A date has no zone, so the session time zone
and its daylight-saving gaps cannot move a part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_WIDTH = 9  # fixed value: month and weekday names are blank-padded to this width


def purchase_timestamp(text: Column) -> Column:
    """Text to a timestamp without zone; NULL stays NULL, bad text fails the job.

    The failure is spelled out, so it does not depend on the session's ANSI mode. A year, or a
    year and a month, is bad text: a date has eight characters at least.
    """
    parsed = F.when(F.length(F.trim(text)) >= 8, text.try_cast("timestamp_ntz"))
    bad = F.raise_error(F.concat(F.lit("not a timestamp: "), text))
    return F.coalesce(parsed, F.when(text.isNotNull(), bad))


def purchase_date(text: Column) -> Column:
    return purchase_timestamp(text).cast("date")


def month_name(date: Column) -> Column:
    """``October  ``: the full English name, padded."""
    return F.rpad(F.date_format(date, "MMMM"), NAME_WIDTH, " ")


def weekday_name(date: Column) -> Column:
    """``Sunday   ``: the full English name, padded."""
    return F.rpad(F.date_format(date, "EEEE"), NAME_WIDTH, " ")


def weekday_number(date: Column) -> Column:
    """Sunday is 0, Saturday is 6."""
    return F.dayofweek(date) - F.lit(1)


def is_weekend(date: Column) -> Column:
    """False, not NULL, for a missing date."""
    return F.coalesce(weekday_number(date).isin(0, 6), F.lit(False))
