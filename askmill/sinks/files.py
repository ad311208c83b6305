"""CSV and Parquet writers."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from askmill.session import file_system


def _csv_writer(frame: DataFrame, mode: str, rows_per_file: int | None):
    return (
        frame.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file or 0)
    )


def write_csv(
    frame: DataFrame, path: str, quote_all: bool = False, rows_per_file: int | None = None
) -> None:
    """Replace a CSV dataset: a header in every part file, blanks kept, no index column.

    A quoted line break makes a file unsplittable on reading: ``rows_per_file`` keeps files small
    enough for one task each. Without it the frame's partitions decide.
    """
    _csv_writer(frame, "overwrite", rows_per_file).option("quoteAll", quote_all).csv(path)


def counted_write(frame: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write a frame and return its rows, counted by the write itself."""
    seen = Observation()
    write(frame.observe(seen, F.count("*").alias("rows")))
    return seen.get["rows"]


def drop_empty_files(spark: SparkSession, folder: str, since: float, is_empty: Callable[[str], bool]) -> None:
    """Remove the files without rows that were written to a folder since a time (seconds).

    Each is looked into first, so that what another writer adds meanwhile stays.
    """
    system, place = file_system(spark, folder)
    for status in system.listStatus(place):
        path = status.getPath()
        recent = status.getModificationTime() >= (since - 1) * 1000
        if recent and status.isFile() and path.getName()[0] not in "._" and is_empty(path.toString()):
            system.delete(path, False)


def append_csv(frame: DataFrame, path: str, rows_per_file: int | None = None) -> int:
    """Add part files to a CSV dataset and return the rows added; a file has a unique name and its own header.

    One job: the rows are counted as they are written, and an empty frame's one file is removed again.
    """
    spark, begun = frame.sparkSession, time.time()
    rows = counted_write(frame, lambda f: _csv_writer(f, "append", rows_per_file).csv(path))
    if not rows:
        drop_empty_files(spark, path, begun, lambda name: spark.read.option("header", True).csv(name).isEmpty())
    return rows


def write_parquet(
    frame: DataFrame, path: str, mode: str = "overwrite", rows_per_group: int | None = None
) -> None:
    """Write Parquet; ``rows_per_group`` bounds the row groups.

    Leave the bound off at scale: row groups of a hundred rows defeat column encoding and
    multiply the footers that every later scan has to read.
    """
    writer = frame.write.mode(mode)
    if rows_per_group is not None:
        writer = writer.option("parquet.block.row.count.limit", str(rows_per_group))
    writer.parquet(path)


def export_parquet(frame: DataFrame, path: str) -> DataFrame:
    """Write the frame and return it read back, which also cuts its lineage."""
    write_parquet(frame, path)
    return frame.sparkSession.read.parquet(path)


def publish(frame: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Write the final dataset and return its manifest: column, type, and row count.

    ``files`` spreads the rows evenly over that many files.
    """
    spread = frame.repartition(files) if files else frame
    written = export_parquet(spread, path)
    columns = F.array(
        *[
            F.struct(
                F.lit(position).cast("bigint").alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
            )
            for position, field in enumerate(written.schema.fields)
        ]
    )
    return (
        written.agg(F.count("*").alias("row_count"))
        .select(F.explode(columns).alias("column"), "row_count")
        .select("column.*", "row_count")
    )


def column_list(frame: DataFrame) -> DataFrame:
    """The columns of a frame in order: ``position``, ``column_name``, ``column_type``, ``rows`` and ``nulls``."""
    names = frame.columns
    counts = frame.agg(F.count("*").alias("rows"), *[F.count(f"`{c}`").alias(f"_{n}") for n, c in enumerate(names)])
    columns = F.array(
        *[
            F.struct(
                F.lit(n).cast("bigint").alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.col("rows"),
                (F.col("rows") - F.col(f"_{n}")).alias("nulls"),
            )
            for n, field in enumerate(frame.schema.fields)
        ]
    )
    return counts.select(F.inline(columns))


def preview(frame: DataFrame, rows: int = 20) -> list[str]:
    """Show the first rows and return the column names."""
    frame.show(rows, truncate=80)
    return frame.columns
