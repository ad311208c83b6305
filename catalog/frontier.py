"""Pending work: discovered ids minus held ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.operators.joins import join_splitting_hot_keys, key_difference, without_keys
from askmill.plans.frontier import pending_answers
from catalog.registry import query, table

_LINKS = """
WITH links AS (
  SELECT CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN NULL ELSE l_orderkey END AS "qId",
         CAST(l_linenumber AS BIGINT) AS aid,
         l_returnflag AS question_title, l_linestatus AS topic_url
  FROM lineitem
), firsts AS (
  SELECT * FROM links
  QUALIFY row_number() OVER (PARTITION BY "qId", aid ORDER BY question_title, topic_url) = 1
), snapshot AS (
  SELECT o_orderkey AS question_id, CAST(length(o_orderpriority) - 4 AS BIGINT) AS answer_id
  FROM orders
), held AS (
  SELECT o_orderkey AS question_id, CAST(length(o_orderstatus) AS BIGINT) AS answer_id FROM orders
  UNION ALL SELECT NULL, NULL
)
"""


def _links(spark: SparkSession, folder: str) -> DataFrame:
    blank = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
    return table(spark, folder, "lineitem").select(
        F.when(~blank, F.col("l_orderkey")).alias("qId"),
        F.col("l_linenumber").cast("bigint").alias("aid"),
        F.col("l_returnflag").alias("question_title"),
        F.col("l_linestatus").alias("topic_url"),
    )


def _snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("question_id"),
        (F.length("o_orderpriority") - 4).cast("bigint").alias("answer_id"),
    )


def _held(spark: SparkSession, folder: str) -> DataFrame:
    """Held answers with a null key among them, which must remove nothing."""
    held = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("question_id"),
        F.length("o_orderstatus").cast("bigint").alias("answer_id"),
    )
    return held.union(spark.createDataFrame([(None, None)], held.schema))


@query(
    _LINKS
    + """
SELECT "qId", aid, question_title, topic_url, concat("qId", aid) AS "qaId" FROM firsts
WHERE "qId" IS NOT NULL AND aid IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM snapshot WHERE question_id = "qId" AND answer_id = aid)
"""
)
def pending_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Links not held in the snapshot."""
    return pending_answers(_links(spark, folder), _snapshot(spark, folder))


@query(
    _LINKS
    + """
SELECT "qId", aid, question_title, topic_url, concat("qId", aid) AS "qaId" FROM firsts
WHERE "qId" IS NOT NULL AND aid IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM snapshot WHERE question_id = "qId" AND answer_id = aid)
  AND NOT EXISTS (SELECT 1 FROM held WHERE question_id = "qId" AND answer_id = aid)
"""
)
def pending_two_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Links held neither in the snapshot nor in the answers table."""
    return pending_answers(_links(spark, folder), _snapshot(spark, folder), _held(spark, folder))


@query(
    """
SELECT doc_id, lang FROM documents
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)
"""
)
def pending_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a label."""
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    return without_keys(documents, table(spark, folder, "labels"), {"doc_id": "doc_id"})


@query(
    """
SELECT event_id, user_id FROM events
WHERE NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id = events.user_id AND p.event_type = 'purchase'
                  AND p.value > 100)
"""
)
def unseen_single_key(spark: SparkSession, folder: str) -> DataFrame:
    """Events of users who never made a large purchase."""
    events = table(spark, folder, "events")
    seen = events.where("event_type = 'purchase' AND value > 100")
    return without_keys(events.select("event_id", "user_id"), seen, {"user_id": "user_id"})


@query(
    """
SELECT DISTINCT o_custkey FROM orders
EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
"""
)
def key_difference_set(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of one table without those of another, as sets."""
    held = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    orders = table(spark, folder, "orders")
    return key_difference(orders, held.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"])


@query(
    """
SELECT event_id, event_type, user_id, n AS users FROM events
LEFT JOIN (SELECT event_type AS kind, count(DISTINCT user_id) AS n FROM events
           WHERE event_type <> 'error' GROUP BY event_type) ON kind = event_type
"""
)
def hot_key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """A left join on five keys, each holding a large share of the rows, dealt over tasks."""
    events = table(spark, folder, "events").select("event_id", "event_type", "user_id")
    users = (
        events.where("event_type <> 'error'")
        .select(F.col("event_type").alias("kind"), "user_id")
        .distinct()
        .groupBy("kind")
        .agg(F.count("*").alias("users"))
    )
    joined = join_splitting_hot_keys(events, users, "event_type", "kind", "left", pieces=16)
    return joined.drop("kind")
