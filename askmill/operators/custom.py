"""Caller-supplied Python on Arrow batches, for what built-in expressions cannot say."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmill.operators.filters import computed_once


def apply_value(
    frame: DataFrame, column: str, function: Callable, result_type: str, name: str | None = None
) -> DataFrame:
    """Replace or add a column by a function of one value, run over Arrow batches.

    The function runs once a value, also where the column is filtered on later.
    """

    def whole_batch(values: pd.Series) -> pd.Series:
        return values.map(function, na_action="ignore")

    apply = F.pandas_udf(whole_batch, result_type)
    return computed_once(frame.withColumn(name or column, apply(F.col(f"`{column}`"))), [name or column])


def map_batches(
    frame: DataFrame,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    partitions: int | None = None,
) -> DataFrame:
    """Rows out of a function of a batch of rows, such as a custom page extractor.

    ``partitions`` spreads the input evenly first, for functions that are slow per row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    spread = frame.repartition(partitions) if partitions else frame
    return spread.mapInPandas(run, schema)
