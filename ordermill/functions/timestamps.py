"""Timestamp and partition-date rules. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 text to an instant: ``Z``, an offset, or none (= UTC); else NULL."""
    return F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")))


def payload_date(raw: Column) -> Column:
    """The UTC date the payload itself states, NULL where it states none.

    An explicit ``_event_date`` wins over ``timestamp``, then ``event_timestamp``.
    """
    fields = F.from_json(
        raw, "_event_date string, timestamp string, event_timestamp string"
    )
    return F.coalesce(
        F.to_date(parse_timestamp(fields["_event_date"])),
        F.to_date(parse_timestamp(fields["timestamp"])),
        F.to_date(parse_timestamp(fields["event_timestamp"])),
    )


def event_date(raw: Column, ingested_at: Column) -> Column:
    """Partition date of a message; its ingest date when the payload has none."""
    return F.coalesce(payload_date(raw), F.to_date(ingested_at))


def utc_iso(ts: Column) -> Column:
    """RFC 3339 text of an instant, to the second, as order events carry it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def ntz(ts: Column) -> Column:
    """Plain UTC wall-clock value, for results that leave Spark."""
    return ts.cast("timestamp_ntz")


def days_before(now: Column, days: int) -> Column:
    return now - F.make_dt_interval(days=F.lit(days))
