"""Where queries and their SQL are collected, and how tables are read."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from askmill.session import work_path
from askmill.sources import read_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SITE = "https://qa.example.com"


def query(sql: str | None = None):
    """Register a function under its own name, with the equivalent SQL if there is one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_database(spark: SparkSession) -> str:
    """A database of its own under the shared folder; its name."""
    name = f"askmill_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_path(spark, 'database')}'")
    return name


def spread(frame: DataFrame) -> DataFrame:
    """Deal a scan of few partitions over the cores; leave a larger one in place.

    The given tables come in one row group, which one core alone would parse.
    """
    wanted = 2 * frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= wanted else frame.repartition(wanted)


def pages_table(spark: SparkSession, folder: str, name: str = "pages") -> DataFrame:
    """A table of long texts, dealt over the cores where it is stored in few row groups."""
    return spread(read_pages(spark, f"{folder}/{name}.parquet"))
