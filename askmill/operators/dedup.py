"""Distinct rows, and first or last row per key.

The keyed forms are aggregates, not windows: every task first reduces its own rows to one
per key, so a key that holds a third of the input sends one row per task to the shuffle.
The output stays partitioned by the key, and a join on the same key needs no new shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(frame: DataFrame) -> DataFrame:
    return frame.distinct()


def distinct_values(frame: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of a column, or distinct tuples of several."""
    return frame.select(*columns).distinct()


def keep_first(frame: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, nulls first.

    Rows that tie are ordered by their other columns, so the survivor never depends on
    how the input is partitioned. Null keys count as equal to each other.
    """
    rest = [c for c in frame.columns if c not in keys]
    ranked = [*order, *[c for c in rest if c not in order]]
    ranked = [c for c in ranked if c not in keys]
    if not ranked:
        return frame.select(*keys).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in ranked])
    first = frame.groupBy(*keys).agg(F.min(row).alias("_first"))
    picked = [
        F.col(f"`{c}`") if c in keys else F.col(f"_first.`{c}`").alias(c) for c in frame.columns
    ]
    return first.select(*picked)


def keep_first_of_files(frame: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key of a frame read from Parquet files, its payload fetched only for the rows kept.

    The first row is found on the keys, the columns of ``order`` (nulls first) and the row's address, a hash of the
    file's path and the place in it, which settles ties: equal for every run over the same files. Only these narrow columns
    are sorted. The kept rows are then fetched by their addresses; the payload is neither compared nor sorted, so it may
    hold columns without an order, such as maps.
    Null keys count as equal to each other. ``frame`` is a scan, with no columns computed.
    """
    file, place = F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")
    scan = frame.select("*", file.alias("_file"), place.alias("_place"))
    names = [*order, "_file", "_place"]
    first = scan.groupBy(*[f"`{k}`" for k in keys]).agg(F.min(F.struct(*[f"`{c}`" for c in names])).alias("_first"))
    kept = first.select(F.col("_first._file").alias("_file"), F.col("_first._place").alias("_place"))
    # The kept addresses are hashed and the payload streams past them.
    found = scan.join(kept.hint("shuffle_hash"), ["_file", "_place"], "left_semi")
    return found.select(*[f"`{c}`" for c in frame.columns])


def last_value(
    frame: DataFrame, keys: Sequence[str], value: Column, order: Column, name: str = "value"
) -> DataFrame:
    """Value of the last row per key, as a map that is overwritten in order would hold."""
    return frame.groupBy(*keys).agg(F.max_by(value, order).alias(name))
