"""Timestamps of mixed forms, windows and spans. The present is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_mixed(text: Column) -> Column:
    """ISO time with Z, with an offset, or without either (then UTC, the session's zone); null if it is none of these."""
    return F.try_to_timestamp(text.cast("string"))


def in_window(posted: Column, as_of: Column, days: int) -> Column:
    """Not older than so many days; what has no known time stays."""
    return posted.isNull() | (posted >= as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def span_days(first: Column, last: Column) -> Column:
    return (F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) / 86_400e6
