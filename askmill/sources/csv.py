"""CSV readers that bind columns by name and set bad rows aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from askmill.sources.headed import EXTRA, FILE_COLUMN, FILE_REASONS, REASON_COLUMN, REJECT_COLUMN, read_headed


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    columns: Sequence[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read CSV whose header has the schema's order; ``columns`` prunes the parse.

    A header that differs from the schema is an error, not a silent swap. Quoted line
    breaks need ``multi_line``, which reads each file in one task; switch it off for data
    known to have none, and files are split.
    """
    frame = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    return frame.select(*[F.col(f"`{c}`") for c in columns]) if columns else frame


def read_csv_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    required: Sequence[str] | None = None,
    glob: str = "*.csv",
    layout: Sequence[str] | None = None,
) -> DataFrame:
    """Read every matching file of a folder, binding columns by each file's own header.

    Rows that do not fit stay, with nulls for the values that failed, their text in
    ``_rejected_line`` and the reason beside it; see ``split_rejects``. Files that are empty, unreadable or
    lack a ``required`` column are a row each; see ``unread_files``. Columns a file lacks are
    null, columns the schema lacks are dropped. ``layout`` names the columns in place of the headers.
    """
    return read_headed(spark, path, schema, list(required or schema.fieldNames()[:1]), glob, layout)


def split_rejects(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fitted the schema, and the text of those that did not with the reason and the file."""
    good = frame.where(F.col(REASON_COLUMN).isNull()).drop(*EXTRA)
    bad = frame.where(F.col(REASON_COLUMN).isNotNull() & ~F.col(REASON_COLUMN).isin(*FILE_REASONS))
    return good, bad.select(*EXTRA)


def unread_files(frame: DataFrame) -> DataFrame:
    """The files that could not be read, or not to their end: ``file``, ``reason`` and ``line``."""
    whole = frame.where(F.col(REASON_COLUMN).isin(*FILE_REASONS))
    return whole.select(
        F.col(FILE_COLUMN).alias("file"), F.col(REASON_COLUMN).alias("reason"), F.col(REJECT_COLUMN).alias("line")
    )
