"""Timestamps and date keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marlstone.functions.cleaning import as_column


# The shortest text that can parse: weekday, month, one-digit day, time, offset, year.
SHORTEST = len("Sat Jun 2 08:59:04 -0700 2012")


def parse_offset_ts(col: str | Column) -> Column:
    """Parse text such as 'Tue Jun 12 08:59:04 -0700 2012'; bad or blank text gives NULL.

    The weekday is skipped, as Spark's formatter cannot parse it, so it is not checked
    against the date, and text after the year makes the value NULL. No session-wide
    parser switch is needed. Short text never reaches the parser, where each failure
    costs an exception: blank dates are common.
    """
    text = as_column(col)
    parsed = F.try_to_timestamp(F.substring(text, 5, 64), F.lit("MMM d HH:mm:ss Z yyyy"))
    return F.when(F.length(text) >= SHORTEST, parsed)


def date_key(col: str | Column) -> Column:
    """yyyyMMdd text in the session time zone (UTC under `session.SETTINGS`)."""
    return F.date_format(as_column(col), "yyyyMMdd")
