"""Epoch seconds and elapsed time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: minutes between two recycles of the collecting workers.
RECYCLE_MINUTES = 20


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def elapsed_more_than(start: Column, now: Column, minutes: int = RECYCLE_MINUTES) -> Column:
    """True where strictly more than the given minutes lie between two instants."""
    return now > start + F.expr(f"INTERVAL {int(minutes)} MINUTES")
