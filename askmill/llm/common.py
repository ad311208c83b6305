"""Reading tables, keeping working tables, and text batches for the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.session import work_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: its lineage ends there."""
    spark = frame.sparkSession
    path = work_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Lets a finished query's shuffle files go at once, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved_and_cleaned(frame: DataFrame, label: str) -> DataFrame:
    """As ``saved``, for a large shuffle that nothing reads again: its files are removed with the write."""
    spark = frame.sparkSession
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        return saved(frame, label)
    finally:
        spark.conf.set(_CLEANUP, before)


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that no other name can clash; null text is empty."""
    return docs.select(
        docs[key].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text")
    )


#: Stands for a null id where rows pass through pandas, which would turn the others into floats.
NO_ID = -(1 << 63)


def marked_ids(texts: DataFrame) -> DataFrame:
    return texts.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))


def unmarked_ids(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def free_name(frame: DataFrame, name: str) -> str:
    """The name, or one made longer until the frame has no such column (upper and lower case are one)."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def folded(text: Column) -> Column:
    """Lower case that agrees with ``ascii_lower`` on every word of ASCII letters, and is faster.

    The Kelvin sign is the one other character whose lower case is a single ASCII letter, so another
    letter stands in for it.
    """
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0138")))


def plain_words(text: Column) -> Column:
    """Runs outside the ASCII marks: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased text."""
    return F.array_remove(F.split(text, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def by_characters(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of the list with at most ``most`` characters each, or one longer text."""
    start, held = 0, 0
    for place, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, place
            start, held = place, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)
