"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_exact(frame: DataFrame, column: str, value: str, drop_null: bool = False) -> DataFrame:
    """Drop rows whose column is exactly this value; nulls stay unless ``drop_null``."""
    kept = frame.where(~F.col(f"`{column}`").eqNullSafe(value))
    return kept.dropna(subset=[column]) if drop_null else kept


def drop_null_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frame.dropna(subset=list(keys))


def with_reject_reason(frame: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the first condition that holds, or null.

    A condition that is itself null counts as not holding.
    """
    reason = F.coalesce(*[F.when(test, F.lit(name)) for name, test in reasons.items()])
    return frame.withColumn("reject_reason", reason)


def computed_once(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows, with these columns computed before any later filter looks at them.

    The optimizer moves a filter below the projection it follows by repeating the
    projection's expressions in the filter. For parsed pages that means parsing each page
    again for every condition. Passing the columns through a generator keeps a filter on them above;
    filters on the other columns still go down to the scan.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    rest = [F.col(f"`{c}`") for c in frame.columns if c not in columns]
    once = frame.select(*rest, F.inline(F.array(row)))
    return once.select(*[F.col(f"`{c}`") for c in frame.columns])
