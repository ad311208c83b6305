"""The first row of each key by a stated order, the same for any split of a stream into batches.

``dropDuplicates`` keeps whichever row of a key arrives first. Here the state of a key is the least place in the
order seen so far; a row is given on only if its place is less, so what is given on for a key shrinks with
every batch, and the least row given on is the least of the whole stream. State is one row to a key, held by a
streaming aggregate, which reduces each task's rows before the shuffle and calls no Python.

Aggregates forget nothing. With a time to live, state is the order's columns, kept by a processor that is called once
for each key of a batch, and is forgotten that long after it last changed; rows of a forgotten key are given on again, which
``survivors`` evens out. That form needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from askmill.operators.dedup import keep_first

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Least(StatefulProcessor):
    """Gives on the least row of a key in each batch, if it lies before all of earlier batches."""

    def __init__(self, order: Sequence[str], place: StructType, ttl_ms: int | None):
        self.order, self.place, self.ttl_ms = list(order), place, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.least = handle.getValueState("least", self.place, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for frame in rows:
            first = frame.sort_values(self.order, kind="stable").head(1)
            best = first if best is None else pd.concat([best, first]).sort_values(self.order, kind="stable").head(1)
        if best is None:
            return
        place = tuple(best[self.order].astype(object).iloc[0])
        if not self.least.exists() or place < tuple(self.least.get()):
            self.least.update(place)
            yield best

    def close(self) -> None:
        pass


def first_seen_stream(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], ttl_ms: int | None = None
) -> DataFrame:
    """The stream's rows that lie before all earlier ones of their key.

    ``order`` names columns without nulls that order the rows of a key totally; rows with a null among them, or
    in a key, are left out: they have no place. The writer's output mode is update.
    """
    whole = stream.dropna(subset=[*keys, *order])
    if ttl_ms is None:
        return _least_by_aggregate(whole, keys, order)
    place = StructType([stream.schema[name] for name in order])
    return whole.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Least(order, place, ttl_ms),
        outputStructType=stream.schema,
        outputMode="Update",
        timeMode="ProcessingTime",
    )


def _least_by_aggregate(whole: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The least row of each key, given on by the batch it came in.

    In a stream ``current_timestamp`` is the time of the batch, also when the batch runs again. Of rows alike in the order
    the earlier batch's stays.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in whole.columns])
    timed = whole.select(*[F.col(f"`{c}`").alias(f"_key_{n}") for n, c in enumerate(keys)], row.alias("_row"), F.current_timestamp().alias("_batch"))
    place = F.struct(*[F.col(f"_row.`{c}`") for c in order], "_batch")
    first = F.min_by(F.struct("_row", "_batch"), place).alias("_first")
    least = timed.groupBy(*[f"_key_{n}" for n in range(len(keys))]).agg(first)
    return least.where(F.col("_first._batch") == F.current_timestamp()).select("_first._row.*")


def survivors(given_on: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key out of all that the stream gave on."""
    return keep_first(given_on, list(keys), list(order))
