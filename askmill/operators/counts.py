"""Counts used as run metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def row_count(frame: DataFrame, name: str = "rows") -> DataFrame:
    return frame.agg(F.count("*").alias(name))


def distinct_tuple_count(frame: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    """Number of distinct tuples, those with nulls included."""
    return frame.agg(F.count_distinct(F.struct(*columns)).alias(name))


def distinct_count_by(
    frame: DataFrame, group: Sequence[str], column: str, name: str = "n"
) -> DataFrame:
    """Distinct values of a column per group.

    Pairs are made distinct first and counted second, so a hot group is spread by value.
    """
    pairs = frame.select(*group, column).distinct()
    return pairs.groupBy(*group).agg(F.count(column).alias(name))


def count_by(frame: DataFrame, *group: str, name: str = "n") -> DataFrame:
    return frame.groupBy(*group).agg(F.count("*").alias(name))


def observed(frame: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and the rows that will pass where it is written: no scan of its own."""
    seen = Observation()
    return frame.observe(seen, F.count("*").alias("rows")), seen


def observed_metrics(spark: SparkSession, stages: dict[str, Observation]) -> DataFrame:
    """As ``stage_metrics``, from the counts of frames that were ``observed`` and written since."""
    return spark.createDataFrame([(stage, seen.get["rows"]) for stage, seen in stages.items()], "stage string, rows long")


def stage_metrics(stages: dict[str, DataFrame]) -> DataFrame:
    """One row per stage: its name and its row count."""
    counted = [
        row_count(frame).select(F.lit(stage).alias("stage"), "rows")
        for stage, frame in stages.items()
    ]
    return reduce(DataFrame.unionByName, counted)
