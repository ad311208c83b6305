"""Catalog tables: create from a query, append by name, list, drop, export."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from askmill.sinks.files import counted_write, drop_empty_files, write_parquet


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table_as(frame: DataFrame, name: str, refresh: bool = False) -> bool:
    """Create a Parquet table from a frame unless it exists; True if it was created.

    An existing table is left alone, so a later run would export stale rows; ``refresh``
    drops it first.
    """
    spark = frame.sparkSession
    if refresh:
        drop_table(spark, name)
    if spark.catalog.tableExists(name):
        return False
    frame.write.format("parquet").saveAsTable(name)
    return True


def append_to_table(frame: DataFrame, name: str) -> int:
    """Append rows by column name, creating the table on first use; the rows added.

    One job: the rows are counted as they are written, and an empty frame's one file is removed again.
    """
    spark, begun = frame.sparkSession, time.time()
    if not spark.catalog.tableExists(name):
        return counted_write(frame, lambda f: f.write.format("parquet").saveAsTable(name))
    columns = spark.table(name).columns
    if sorted(columns) != sorted(frame.columns):
        raise ValueError(f"{name} has the columns {columns}, the rows have {frame.columns}")
    ordered = frame.select(*[f"`{c}`" for c in columns])
    rows = counted_write(ordered, lambda f: f.write.insertInto(name))
    if not rows:
        about = {row[0]: row[1] for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        drop_empty_files(spark, about["Location"], begun, lambda file: spark.read.parquet(file).isEmpty())
    return rows


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables of a database."""
    return spark.sql(f"SHOW TABLES IN {database}").selectExpr("tableName AS table_name")


def table_to_parquet(spark: SparkSession, name: str, path: str) -> None:
    """Write a table's rows to a Parquet folder."""
    write_parquet(spark.table(name), path)
