"""Timestamps from and to the forms the records use. Times are UTC."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
BATCH_FORMAT = "yyyyMMdd_HHmmss"
TIME_FILTERS = {
    "all": None, "hour": "1 hour", "day": "1 day", "week": "7 days",
    "month": "1 month", "year": "1 year",
}


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def parse_iso(text: Column) -> Column:
    """ISO text with ``Z``, an offset or neither; NULL where it is no timestamp."""
    return F.try_to_timestamp(text)


def format_iso(moment: Column) -> Column:
    return F.date_format(moment, ISO_FORMAT)


def batch_id(moment: Column) -> Column:
    return F.concat(F.lit("batch_"), F.date_format(moment, BATCH_FORMAT))


def run_stamp(moment: datetime | str | None = None) -> Column:
    """A run's time as a constant, so that every row of the run carries the same."""
    moment = datetime.now(timezone.utc) if moment is None else moment
    if isinstance(moment, datetime):
        moment = moment.astimezone(timezone.utc).isoformat() if moment.tzinfo else moment.isoformat()
    return F.lit(moment).cast("timestamp")


def within(created: Column, time_filter: str, as_of: Column) -> Column:
    """True for times not older than the window that ends at ``as_of``."""
    if time_filter not in TIME_FILTERS:
        raise ValueError(f"time_filter must be one of {sorted(TIME_FILTERS)}")
    span = TIME_FILTERS[time_filter]
    return F.lit(True) if span is None else created >= as_of - F.expr(f"interval {span}")
