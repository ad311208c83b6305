"""Landed API responses: offset pages of one member's answers, unpacked to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from askmill.operators.joins import join_spread
from askmill.schemas import API_PAGE

# Fixed value: answers to a page.
PAGE_SIZE = 20


def read_api_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """JSON payloads with the member and the offset they were requested for."""
    schema = StructType(
        [StructField("member", StringType()), StructField("offset", LongType()), *API_PAGE.fields]
    )
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def _is_last(max_count: int | None) -> Column:
    size = F.coalesce(F.size("data"), F.lit(0))
    last = (size <= 0) | (F.col("offset") >= F.col("paging.totals"))
    return last if max_count is None else last | (F.col("offset") > max_count)


def kept_pages(pages: DataFrame, max_count: int | None = None) -> DataFrame:
    """The pages that paging would have read before it stopped.

    A member's paging stops at the first page that is empty, at or past the total, or past
    ``max_count`` where the caller sets one; the bound is strict and on the page's offset, so up to one page more
    than ``max_count`` rows may come through. A page without paging details that is
    reached before the stop voids the member.
    """
    no_paging = F.col("paging").isNull()
    stops = (
        pages.groupBy("member")
        .agg(
            F.min(F.when(no_paging, F.col("offset"))).alias("void_at"),
            F.min(F.when(~no_paging & _is_last(max_count), F.col("offset"))).alias("stop_at"),
        )
        .where("void_at IS NOT NULL OR stop_at IS NOT NULL")
    )
    # One member may hold all pages: they are spread whatever their number, and only the stops are repeated.
    joined = join_spread(pages, stops, ["member"])
    voided = F.col("void_at").isNotNull() & (
        F.col("stop_at").isNull() | (F.col("void_at") < F.col("stop_at"))
    )
    before_stop = F.col("stop_at").isNull() | (F.col("offset") < F.col("stop_at"))
    return joined.where(~voided & before_stop).drop("void_at", "stop_at")


def api_rows(pages: DataFrame, max_count: int | None = None) -> DataFrame:
    """One row per answer: ``member``, ``offset`` and the payload's fields."""
    return kept_pages(pages, max_count).select(
        "member", "offset", F.explode("data").alias("item")
    ).select("member", "offset", "item.*")
