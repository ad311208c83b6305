"""Parquet files, catalog tables, frames queried by name, and landed pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Read Parquet; ``columns`` narrows what is read from disk."""
    paths = [path] if isinstance(path, str) else path
    frame = spark.read.parquet(*paths)
    return frame.select(*[F.col(f"`{c}`") for c in columns]) if columns else frame


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def query_frame(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL in which ``{name}`` stands for a DataFrame passed under that name."""
    return spark.sql(sql, **frames)


def read_pages(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Landed HTML pages: at least ``url`` and ``html``, with ``status`` where recorded.

    A plain scan: pages are not moved before they are parsed. See ``land_pages`` for pages that are
    joined by their ids.
    """
    return read_parquet(spark, path, columns)
