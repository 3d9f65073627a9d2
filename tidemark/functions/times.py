"""Dates and timestamps. Everything is UTC and zone-free (``timestamp_ntz``)."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# The plain text form of a timestamp (the API form has T between date and
# time, and Z at the end), and the mark of a group with nothing loaded.
PLAIN_FORM = "yyyy-MM-dd HH:mm:ss"
EPOCH = "1970-01-01 00:00:00"


def to_time(text: Column) -> Column:
    """Text to timestamp; a trailing ``Z`` is dropped, malformed text becomes NULL."""
    return text.try_cast("timestamp_ntz")


def to_day(text: Column) -> Column:
    """Text to date; malformed text becomes NULL."""
    return text.try_cast("date")


def is_malformed_time(text: Column) -> Column:
    """True where there is text but no timestamp in it."""
    return text.isNotNull() & to_time(text).isNull()


def reformat_to_api(text: Column, pattern: str = PLAIN_FORM) -> Column:
    """A timestamp string in ``pattern`` rewritten in API form."""
    return time_text(F.to_timestamp_ntz(text, F.lit(pattern)), api=True)


def time_text(ts: Column, api: bool = False) -> Column:
    """A timestamp as text, in plain or API form; the session's zone plays no part."""
    text = ts.cast("timestamp_ntz").cast("string")
    between, end = ("T", "Z") if api else (" ", "")
    return F.concat(F.substring(text, 1, 10), F.lit(between), F.substring(text, 12, 8), F.lit(end))


def unix_day(seconds: Column) -> Column:
    """UTC date of a unix time, whatever the session's zone."""
    days = F.floor(seconds.cast("bigint") / F.lit(86400)).cast("int")
    return F.date_add(F.lit(date(1970, 1, 1)), days)


def unix_day_text(seconds: Column) -> Column:
    return unix_day(seconds).cast("string")


def run_day(at: datetime | None = None) -> Column:
    """The run's date as text: of ``at`` if given, so that a rerun can repeat it."""
    return F.lit(_clock(at).strftime("%Y-%m-%d"))


def run_time(at: datetime | None = None) -> Column:
    """The run's time as text in API form."""
    return F.lit(_clock(at).strftime("%Y-%m-%dT%H:%M:%SZ"))


def _clock(at: datetime | None) -> datetime:
    return at if at is not None else datetime.now(timezone.utc)


def day_span(first: Column, last: Column) -> Column:
    """Array of all days from ``first`` to ``last``, both included."""
    return F.sequence(_ordered_start(first, last), last.cast("date"))


def day_span_times(first: Column, last: Column) -> Column:
    """The days' midnights, the last one replaced by its last second.

    A one-day span gives that day's first and last second.
    """
    days = day_span(first, last)
    end = (last.cast("date").cast("timestamp_ntz") + F.expr("interval '23:59:59' hour to second"))
    starts = F.transform(days, lambda d: d.cast("timestamp_ntz"))
    kept = F.when(F.size(days) == 1, starts).otherwise(
        F.slice(starts, F.lit(1), F.greatest(F.size(days) - 1, F.lit(1)))
    )
    return F.concat(kept, F.array(end))


def _ordered_start(first: Column, last: Column) -> Column:
    ok = first.cast("date") <= last.cast("date")
    wrong = F.raise_error(F.lit("the span's first day lies after its last day"))
    return F.when(ok, first.cast("date")).when(first.isNull() | last.isNull(), F.lit(None)).otherwise(
        wrong.cast("date")
    )
