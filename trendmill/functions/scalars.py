"""Column expressions shared by the transforms. All of them stay inside the JVM.

Timestamps are UTC wall-clock ``timestamp_ntz`` values, so no result depends on the session zone.
"""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = dt.datetime(1970, 1, 1)
# Seconds of years 1 and 9999, the range a timestamp can show.
_MIN_SECONDS, _MAX_SECONDS = -62135596800, 253402300799


def ntz(value):
    """``timestamp_ntz`` from a datetime, an ISO string or a column."""
    value = value if isinstance(value, Column) else F.lit(str(value))
    return value.cast("timestamp_ntz")


def utc_now():
    """Current UTC time as ``timestamp_ntz``, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.current_timestamp()), ntz(_EPOCH))


def as_column(value):
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(source, native_id):
    """md5 of source and native id; a NULL id gives a NULL key."""
    return F.md5(F.concat(F.lit(source), as_column(native_id).cast("string")))


def epoch_to_timestamp(seconds):
    """Epoch seconds to UTC time; values no timestamp can hold become NULL."""
    seconds = as_column(seconds)
    return F.when(
        seconds.between(_MIN_SECONDS, _MAX_SECONDS),
        F.timestamp_add("SECOND", seconds, ntz(_EPOCH)),
    )


def iso_to_timestamp(text):
    """ISO-8601 text to UTC time; text without a zone is UTC, unreadable text becomes NULL."""
    text = as_column(text)
    instant = F.try_to_timestamp(text)
    # Tied to the start and to the first T or blank, so a long text is searched once and not from each of its blanks.
    zoned = F.trim(text).rlike(r"^[^T ]*[T ](?s:.*)(?:Z|[A-Za-z]{3}|[+-][0-9]{1,2}(?::?[0-9]{2}){0,2})$")
    return F.when(
        zoned, F.timestamp_add("MICROSECOND", F.unix_micros(instant), ntz(_EPOCH))
    ).otherwise(text.try_cast("timestamp_ntz"))


def json_strings(text):
    """JSON array text to array<string>; anything else becomes the empty array."""
    parsed = F.from_json(as_column(text), "array<string>")
    return F.coalesce(parsed, F.array().cast("array<string>"))


def first_element(array, default=None):
    """First element or the default; never fails on an empty array."""
    first = F.get(as_column(array), F.lit(0))
    return first if default is None else F.coalesce(first, F.lit(default))


def strip_html(text):
    return F.regexp_replace(as_column(text), "<[^>]+>", " ")


def collapse_whitespace(text):
    return F.trim(F.regexp_replace(as_column(text), r"(?U)\s+", " "))


def after_last(text, marker):
    """Text after the last marker, or all of it when the marker is missing."""
    return F.substring_index(as_column(text), marker, -1)


def age_hours(newest, as_of):
    micros = F.timestamp_diff("MICROSECOND", as_column(newest), ntz(as_of))
    return micros / F.lit(3.6e9)


def in_dates(column, first, last):
    """Closed date range, written as a half-open range on the bare column so the scan can skip."""
    column = as_column(column)
    lower = F.lit(str(first)).cast("date")
    upper = F.date_add(F.lit(str(last)).cast("date"), 1)
    return (column >= lower.cast("timestamp_ntz")) & (column < upper.cast("timestamp_ntz"))


def since_days(column, as_of, days):
    """``date >= as_of - days`` for a date column."""
    return as_column(column) >= F.date_sub(F.lit(str(as_of)).cast("date"), days)


def unfold(df, struct, *keep):
    """The fields of a struct as columns next to the kept ones, with the struct made once per row.

    A plain ``select("struct.*")`` lets a later filter be pushed below it, where Spark makes the
    struct a second time; parsing a record twice is what a feed load can least afford.
    """
    return df.select(*keep, F.inline(F.array(struct)))
