"""JSON objects read as key/value rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from askmill.schemas import BUCKET_MAP


def map_entries(frame: DataFrame, text: Column, schema: MapType = BUCKET_MAP) -> DataFrame:
    """One row per entry of a JSON object column: the frame's columns, ``key``, ``value``."""
    return frame.select("*", F.explode(F.from_json(text, schema)))


def read_map_file(
    spark: SparkSession, path: str, schema: MapType = BUCKET_MAP, per_line: bool = False
) -> DataFrame:
    """Entries of JSON object files: one object to a file, or one to a line."""
    text = spark.read.text(path, wholetext=not per_line).withColumnRenamed("value", "_object")
    return map_entries(text, F.col("_object"), schema).drop("_object")
