"""Landed pages in a table bucketed by their ids, joined where they lie.

A page is many thousand times the size of its id, so a join should move the ids. Pages are dealt once, on
landing, over the buckets of a table by their id columns; wanted ids are dealt over the same buckets
and meet the pages there, and no exchange carries a page. Since one question may hold a good part of all pages,
the pages of an id are spread over ``pieces`` by a hash of the page itself, and wanted ids are repeated for them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = "_page_piece"


@dataclass(frozen=True)
class LandedPages:
    """The table's pages, the columns they are bucketed by, and how many buckets and pieces there are."""

    frame: DataFrame
    keys: tuple[str, ...]
    buckets: int
    pieces: int

    def meet(self, wanted: DataFrame) -> DataFrame:
        """Inner join of rows that hold the id columns with their pages.

        The rows, which should be narrow, are hashed within a bucket; the pages stream past them.
        """
        repeated = wanted.withColumn(PIECE, F.explode(F.sequence(F.lit(0), F.lit(self.pieces - 1))))
        on = [*self.keys, PIECE]
        dealt = repeated.repartition(self.buckets, *on).hint("shuffle_hash")
        return dealt.join(self.frame, on).drop(PIECE)


def land_pages(
    pages: DataFrame, table: str, keys: Sequence[str], buckets: int, pieces: int = 8, by: str = "html"
) -> None:
    """Append pages to a table bucketed by ``keys``, creating it on first use.

    ``by`` is the column whose hash spreads the pages of one id. Every landing adds a file to each bucket.
    """
    piece = F.pmod(F.xxhash64(by), F.lit(pieces)).cast("int")
    on = [*keys, PIECE]
    dealt = pages.withColumn(PIECE, piece).repartition(buckets, *on)
    writer = dealt.write.mode("append").format("parquet").bucketBy(buckets, on[0], *on[1:]).sortBy(on[0], *on[1:])
    writer.option("askmill.pieces", str(pieces)).saveAsTable(table)


def landed_pages(spark: SparkSession, table: str) -> LandedPages:
    """The pages of a table written by ``land_pages``."""
    about = {row[0]: row[1] for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    on = re.findall(r"`([^`]+)`", about["Bucket Columns"])
    pieces = int(re.search(r"askmill\.pieces=(\d+)", about["Storage Properties"])[1])
    return LandedPages(spark.table(table), tuple(on[:-1]), int(about["Num Buckets"]), pieces)
