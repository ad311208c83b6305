"""Positions in an ordered frame, batches, bucket assignment, and shuffling of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampType

from askmill.session import work_path
from askmill.sinks import export_parquet

# monotonically_increasing_id() puts the partition above bit 33 and the row below it.
_ROW_BITS = 33


def with_position(frame: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Number the rows 0, 1, 2, … in the given order.

    The order must be total: name columns that are unique together. Rows are range-sorted
    and written once to the shared folder, each partition's rows are counted, and a row's
    position is its place in the partition plus the rows of the partitions before it. No
    step puts more than one partition's rows in a task; the table of offsets, the one side
    that is broadcast and windowed whole, has one row per partition.
    """
    ranked = frame.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order]).withColumn(
        "_place", F.monotonically_increasing_id()
    )
    sorted_rows = export_parquet(ranked, work_path(frame.sparkSession, "positions"))
    part = F.shiftrightunsigned("_place", _ROW_BITS).alias("_part")
    sizes = sorted_rows.groupBy(part).agg(F.count("*").alias("_size"))
    before = F.coalesce(
        F.sum("_size").over(
            W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    offsets = sizes.select("_part", before.alias("_before"))
    row_in_part = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        sorted_rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + row_in_part)
        .drop("_part", "_place", "_before")
    )


def batches(
    frame: DataFrame, order: Sequence[str], size: int, name: str = "batch_id"
) -> DataFrame:
    """Give each row the number of its fixed-size batch; the last batch may be short."""
    placed = with_position(frame, order, "_position")
    return placed.withColumn(name, F.floor(F.col("_position") / size)).drop("_position")


def skip_first(frame: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """All rows but the first few in the given total order.

    The last row to skip is found by selection on the order columns alone (``row_at``); the rest is a plain
    filter on all rows, which are neither sorted nor moved.
    """
    if rows <= 0:
        return frame
    last = row_at(frame, order, rows - 1)
    if last is None:
        return frame.where(F.lit(False))
    after = F.lit(False)
    for name in reversed(list(order)):
        column, value = F.col(f"`{name}`"), F.lit(last[name]).cast(frame.schema[name].dataType)
        later = column.isNotNull() if last[name] is None else F.coalesce(column > value, F.lit(False))
        after = later | (column.eqNullSafe(value) & after)
    return frame.where(after)


#: Rank error of the sketch behind ``row_at``, and how far on either side of the place the bracket begins.
SKETCH_ACCURACY, SIDE = 10_000, 2e-4


def row_at(frame: DataFrame, order: Sequence[str], place: int) -> Row | None:
    """The order columns of the row at a place, 0 the first, nulls first; None past the end.

    A quantile sketch of the first column brackets the value at that place, the rows below the bracket are counted,
    and only the rows inside are numbered. The count proves the bracket; one that misses is widened. A
    column of a type without such a sketch (text) has all its rows numbered.
    """
    keys = frame.select(*[F.col(f"`{c}`") for c in order])
    first, below = F.col(f"`{order[0]}`"), 0
    inside = F.lit(True)
    if isinstance(frame.schema[order[0]].dataType, (NumericType, DateType, TimestampType)):
        total, known = keys.agg(F.count("*"), F.count(first)).first()
        nulls = total - known
        if place >= total:
            return None
        inside = first.isNull()
        side = SIDE
        while place >= nulls:
            share = (place - nulls) / known
            ends = F.array(F.lit(max(0.0, share - side)), F.lit(min(1.0, share + side)))
            low, high = map(F.lit, keys.agg(F.percentile_approx(first, ends, SKETCH_ACCURACY)).first()[0])
            before, until = keys.agg(F.count_if(first < low), F.count_if(first <= high)).first()
            if before <= place - nulls < until:
                inside, below = (first >= low) & (first <= high), nulls + before
                break
            side *= 4
    numbered = with_position(keys.where(inside), order, "_at")
    return numbered.where(F.col("_at") == place - below).drop("_at").head()


def assign_buckets(frame: DataFrame, buckets: DataFrame, order: Sequence[str]) -> DataFrame:
    """Deal rows over the buckets in turn: row ``i`` gets bucket ``i`` modulo their number.

    ``buckets`` has the columns ``position`` (0, 1, 2, …) and whatever describes a bucket.
    """
    count = buckets.count()
    placed = with_position(frame, order, "_position")
    placed = placed.withColumn("_bucket", F.pmod("_position", F.lit(count))).drop("_position")
    side = buckets.withColumnRenamed("position", "_bucket")
    return placed.join(side, "_bucket").withColumnRenamed("_bucket", "bucket")


def hash_bucket(frame: DataFrame, keys: Sequence[str], count: int, name: str = "bucket") -> DataFrame:
    """Give each row a bucket by its key, for when its place in an order does not matter."""
    return frame.withColumn(name, F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int"))


def shuffled(frame: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """All rows in a random order that the seed and the keys alone decide."""
    return frame.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys)
