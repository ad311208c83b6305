"""Conversations as comment threads under documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.operators.joins import join_on_different_keys, join_on_shared_key
from askmill.plans.comments import relate_comments
from catalog.registry import query, table

_THREADS = """
WITH roots AS (
  SELECT conv_id AS answer_id, conv_id * 1000 AS id, text AS content, role AS "author.name"
  FROM conversations WHERE turn = 0
), replies AS (
  SELECT conv_id AS answer_id, conv_id * 1000 + turn AS id, conv_id * 1000 AS reply_root_comment_id,
         conv_id * 1000 + turn - 1 AS reply_comment_id, text AS content, role AS "author.name"
  FROM conversations WHERE turn > 0
), related AS (
  SELECT d.doc_id AS answer_id, d.source AS question_title, d.text AS answer_content,
         roots.id AS id_root_comment, roots.content AS content_root_comment,
         roots."author.name" AS "author.name_root_comment",
         replies.id AS id_comment_tree, replies.reply_root_comment_id, replies.reply_comment_id,
         replies."author.name" AS "author.name_comment_tree",
         replies.content AS content_comment_tree
  FROM roots JOIN replies ON roots.id = replies.reply_root_comment_id
  JOIN documents d ON d.doc_id = roots.answer_id
)
"""


def _inputs(spark: SparkSession, folder: str):
    turns = table(spark, folder, "conversations")
    root = F.col("conv_id") * 1000
    roots = turns.where("turn = 0").select(
        F.col("conv_id").alias("answer_id"),
        root.alias("id"),
        F.col("text").alias("content"),
        F.lit(1).cast("bigint").alias("child_comment_count"),
        F.col("role").alias("author.name"),
    )
    replies = turns.where("turn > 0").select(
        F.col("conv_id").alias("answer_id"),
        (root + F.col("turn")).alias("id"),
        root.alias("reply_root_comment_id"),
        (root + F.col("turn") - 1).alias("reply_comment_id"),
        F.col("text").alias("content"),
        F.col("role").alias("author.name"),
    )
    answers = table(spark, folder, "documents").select(
        F.col("doc_id").alias("answer_id"),
        F.col("source").alias("question_title"),
        F.col("text").alias("content"),
    )
    return roots, replies, answers


@query(_THREADS + "SELECT * FROM related")
def relate_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Replies with their root comments and the answers commented on."""
    return relate_comments(*_inputs(spark, folder))


@query(_THREADS + "SELECT * FROM related")
def relate_replies_split(spark: SparkSession, folder: str) -> DataFrame:
    """As above, hot root comments dealt over several tasks."""
    return relate_comments(*_inputs(spark, folder), split_hot_roots=True)


@query(_THREADS + "SELECT * FROM related WHERE id_root_comment = 2000")
def relate_one_root(spark: SparkSession, folder: str) -> DataFrame:
    """The replies of one root comment."""
    return relate_comments(*_inputs(spark, folder), root_id=2000)


@query(
    """
SELECT n_nationkey AS key_nation, n_name AS name_nation, n_regionkey,
       r_regionkey AS key_region, r_name AS name_region, cust.c_custkey, cust.c_name
FROM nation JOIN region ON n_regionkey = r_regionkey
JOIN customer cust ON cust.c_nationkey = n_nationkey
"""
)
def suffixed_joins(spark: SparkSession, folder: str) -> DataFrame:
    """Joins on differently named keys, names found on both sides suffixed."""
    nations = table(spark, folder, "nation").selectExpr(
        "n_nationkey AS key", "n_name AS name", "n_regionkey"
    )
    regions = table(spark, folder, "region").selectExpr("r_regionkey AS key", "r_name AS name")
    placed = join_on_different_keys(
        nations, regions, "n_regionkey", "key", ("_nation", "_region")
    )
    customers = table(spark, folder, "customer").selectExpr(
        "c_nationkey AS key_nation", "c_custkey", "c_name"
    )
    return join_on_shared_key(placed, customers, "key_nation")


@query(
    """
WITH a AS (SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS k,
                  o_orderpriority AS left_value FROM orders),
     b AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS k,
                  count(*) AS right_value FROM orders GROUP BY 1)
SELECT a.k, left_value, right_value FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k
"""
)
def null_safe_join(spark: SparkSession, folder: str) -> DataFrame:
    """A join in which a null key meets a null key."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("k")
    orders = table(spark, folder, "orders")
    left = orders.select(status, F.col("o_orderpriority").alias("left_value")).distinct()
    right = orders.groupBy(status).agg(F.count("*").alias("right_value"))
    return join_on_shared_key(left, right, "k", null_safe=True)
