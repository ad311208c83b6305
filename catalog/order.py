"""Ordered frames: batches, skipping, dealing, shuffling, and the base topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.operators import batches as B
from askmill.sources import BASE_TOPICS, base_topics
from catalog.registry import query, table

_TOPICS = ", ".join(f"({i}, '{topic}')" for i, topic in enumerate(BASE_TOPICS))


@query(
    """
SELECT p_partkey, p_name, (row_number() OVER (ORDER BY p_name, p_partkey) - 1) // 300 AS batch_id
FROM part
"""
)
def batches(spark: SparkSession, folder: str) -> DataFrame:
    """Parts in batches of 300 by name."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return B.batches(parts, ["p_name", "p_partkey"], 300)


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey OFFSET 4")
def skip_first(spark: SparkSession, folder: str) -> DataFrame:
    """All parts but the first four."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return B.skip_first(parts, ["p_partkey"], 4)


@query(
    """
WITH buckets AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS bucket, n_name FROM nation),
     placed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents)
SELECT doc_id, bucket, n_name FROM placed JOIN buckets
  ON position % (SELECT count(*) FROM nation) = bucket
"""
)
def bucket_assign(spark: SparkSession, folder: str) -> DataFrame:
    """Documents dealt over the nations in turn."""
    nations = B.with_position(table(spark, folder, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])
    documents = table(spark, folder, "documents").select("doc_id")
    return B.assign_buckets(documents, nations.drop("n_nationkey"), ["doc_id"])


@query("SELECT p_partkey, p_name FROM part")
def hash_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    """Parts in a seeded random order."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return B.shuffled(parts, ["p_partkey"], seed=7)


@query(
    f"""
WITH topics(position, topic) AS (VALUES {_TOPICS}),
     placed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents)
SELECT topics.topic, count(*) AS documents FROM placed JOIN topics
  ON placed.position % {len(BASE_TOPICS)} = topics.position
GROUP BY topics.topic
"""
)
def topics_dealt(spark: SparkSession, folder: str) -> DataFrame:
    """Documents dealt over the base topics, counted by topic."""
    documents = table(spark, folder, "documents").select("doc_id")
    dealt = B.assign_buckets(documents, base_topics(spark), ["doc_id"])
    return dealt.groupBy("topic").agg(F.count("*").alias("documents"))
