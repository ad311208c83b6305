"""Instruction tables out of conversations and of API pages made from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.functions.text import strip_text
from askmill.operators.dedup import keep_first
from askmill.plans.instructions import (
    MEMBER_COLUMNS,
    member_answer_misses,
    member_answers,
    member_answers_to_instructions,
    to_instructions,
)
from askmill.sources import read_api_pages
from askmill.session import work_path
from catalog.registry import SITE, query, table

SOURCE = "forum"


def conversation_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Each user turn as the question of the assistant turn that follows it.

    The turns are paired by an equi-join on (conversation, turn), which spreads even one
    huge conversation. Short answers stand in for blank ones, and answers holding a
    percent sign for missing ones.
    """
    turns = table(spark, folder, "conversations")
    asked = turns.where("role = 'user'").select(
        F.col("conv_id").alias("question_id"),
        (F.col("turn") + 1).alias("answer_id"),
        F.col("text").alias("question_title"),
    )
    answered = turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("question_id"),
        F.col("turn").alias("answer_id"),
        F.when(F.length("text") < 120, F.lit(" "))
        .when(F.col("text").contains("%"), F.lit(None))
        .otherwise(F.col("text"))
        .alias("content"),
        F.when(F.col("turn") > 3, F.lit(None)).otherwise(F.col("role")).alias("author_id"),
        F.length("text").cast("string").alias("upvotes"),
        F.lit("").alias("answer_creation_time"),
    )
    paired = asked.join(answered, ["question_id", "answer_id"])
    return keep_first(paired, ["question_id", "answer_id"])


_PAIRS = """
WITH asked AS (
  SELECT conv_id AS question_id, turn + 1 AS answer_id, text AS question_title
  FROM conversations WHERE role = 'user'
), answered AS (
  SELECT conv_id AS question_id, turn AS answer_id,
         CASE WHEN length(text) < 120 THEN ' '
              WHEN contains(text, '%') THEN NULL ELSE text END AS content,
         CASE WHEN turn > 3 THEN NULL ELSE role END AS author_id,
         CAST(length(text) AS VARCHAR) AS upvotes,
         '' AS answer_creation_time
  FROM conversations WHERE role = 'assistant'
), pairs AS (
  SELECT question_id, answer_id, author_id, question_title, content, upvotes,
         answer_creation_time
  FROM asked JOIN answered USING (question_id, answer_id)
  QUALIFY row_number() OVER (
    PARTITION BY question_id, answer_id
    ORDER BY question_title NULLS FIRST, content NULLS FIRST, author_id NULLS FIRST,
             upvotes NULLS FIRST, answer_creation_time NULLS FIRST) = 1
)
"""

_COMPACT = """CAST(json_object('question_id', question_id, 'answer_id', answer_id,
         'author_id', author_id, 'upvotes', upvotes,
         'answer_creation_time', answer_creation_time) AS VARCHAR)"""


@query(
    _PAIRS
    + f"""
SELECT question_title AS "INSTRUCTION", content AS "RESPONSE", 'forum' AS "SOURCE",
       {_COMPACT} AS "METADATA"
FROM pairs WHERE content IS DISTINCT FROM ' '
"""
)
def instruction_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Questions and answers as instruction rows; blank answers dropped, nulls kept."""
    return to_instructions(conversation_answers(spark, folder), SOURCE)


@query(
    _PAIRS
    + f"""
SELECT question_title AS "INSTRUCTION", content AS "RESPONSE", 'forum' AS "SOURCE",
       {_COMPACT} AS "METADATA"
FROM pairs WHERE content <> ' '
"""
)
def instruction_pairs_complete(spark: SparkSession, folder: str) -> DataFrame:
    """As above with null answers dropped too."""
    return to_instructions(conversation_answers(spark, folder), SOURCE, drop_null=True)


@query(
    _PAIRS
    + """
SELECT question_title AS "INSTRUCTION", content AS "RESPONSE", 'forum' AS "SOURCE",
       '{"question_id": ' || question_id || ', "answer_id": ' || answer_id
       || ', "author_id": ' || coalesce('"' || author_id || '"', 'null')
       || ', "upvotes": "' || upvotes
       || '", "answer_creation_time": "' || answer_creation_time || '"}' AS "METADATA"
FROM pairs WHERE content IS DISTINCT FROM ' '
"""
)
def instruction_pairs_spaced(spark: SparkSession, folder: str) -> DataFrame:
    """As the first with a blank after each comma and colon of the metadata."""
    return to_instructions(conversation_answers(spark, folder), SOURCE, spaced=True)


def order_api_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as landed API payloads: member = ship priority, 20 orders to a page.

    A page gathers 20 consecutive order keys, so no group grows with the data. Each page
    is one JSON text with its member and its offset, written out and read back.
    """
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    item = F.struct(
        F.struct(
            F.col("c_name").alias("name"),
            F.col("c_custkey").cast("string").alias("id"),
            F.col("c_mktsegment").alias("url_token"),
        ).alias("author"),
        F.length("o_orderpriority").cast("bigint").alias("voteup_count"),
        F.col("o_orderkey").alias("created_time"),
        (F.col("o_orderkey") + 1).alias("updated_time"),
        F.concat(F.lit(SITE + "/answers/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("title")).alias(
            "question"
        ),
    )
    paged = joined.select((F.floor(F.col("o_orderkey") / 20) * 20).alias("offset"), item.alias("item"))
    total = orders.agg(F.count("*").alias("totals"))
    pages = (
        paged.groupBy("offset")
        .agg(F.collect_list("item").alias("data"))
        .select(
            F.lit("m1").alias("member"),
            "offset",
            F.struct(F.lit(int(total.first()[0])).cast("bigint").alias("totals")).alias("paging"),
            "data",
        )
    )
    path = work_path(spark, "api-pages")
    pages.write.json(path)
    return read_api_pages(spark, path)


_MEMBER = """
SELECT c.c_name AS "作者名称", CAST(c.c_custkey AS VARCHAR) AS "作者ID",
       c.c_mktsegment AS "作者token",
       CAST(length(o.o_orderpriority) AS BIGINT) AS "回答点赞数",
       o.o_orderkey AS "回答时间", o.o_orderkey + 1 AS "更新时间",
       CAST(o.o_orderkey AS VARCHAR) AS "回答ID", o.o_custkey AS "问题ID",
       o.o_orderpriority AS "问题内容"
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
WHERE (o.o_orderkey // 20) * 20 < (SELECT count(*) FROM orders)
"""


@query(_MEMBER)
def member_answer_table(spark: SparkSession, folder: str) -> DataFrame:
    """API pages unpacked to the nine columns of a member's answers."""
    return member_answers(order_api_pages(spark, folder))


@query(_MEMBER + " AND (o.o_orderkey // 20) * 20 <= 1000")
def member_answers_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Paging with its bound on the page offset, which lets one more page through."""
    return member_answers(order_api_pages(spark, folder), max_count=1000)


@query(
    """
SELECT o.o_orderpriority AS "INSTRUCTION",
       o.o_orderstatus || ' ' || o.o_orderpriority AS "RESPONSE",
       'forum' AS "SOURCE",
       CAST(json_object('回答点赞数', CAST(length(o.o_orderpriority) AS BIGINT),
                        '回答时间', o.o_orderkey) AS VARCHAR) AS "METADATA"
FROM orders o
"""
)
def user_answer_instructions(spark: SparkSession, folder: str) -> DataFrame:
    """API pages and separately fetched answer texts as instruction rows."""
    contents = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("question_id"),
        F.col("o_orderkey").alias("answer_id"),
        strip_text(F.concat_ws(" ", "o_orderstatus", "o_orderpriority")).alias("content"),
    )
    pages = order_api_pages(spark, folder)
    return member_answers_to_instructions(pages, contents, SOURCE)


@query("""SELECT o_custkey AS "问题ID", CAST(o_orderkey AS VARCHAR) AS "回答ID" FROM orders WHERE o_orderstatus = 'P'""")
def user_answer_misses(spark: SparkSession, folder: str) -> DataFrame:
    """A member's answers whose text was not fetched, where those that were came twice."""
    fetched = table(spark, folder, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_custkey").alias("question_id"),
        F.col("o_orderkey").alias("answer_id"),
        F.explode(F.array(F.col("o_orderstatus"), F.col("o_orderpriority"))).alias("content"),
    )
    return member_answer_misses(order_api_pages(spark, folder), fetched)


@query(
    """
SELECT o_orderpriority AS "INSTRUCTION", 'second ' || o_orderkey AS "RESPONSE", 'forum' AS "SOURCE",
       CAST(json_object('回答点赞数', CAST(length(o_orderpriority) AS BIGINT),
                        '回答时间', o_orderkey) AS VARCHAR) AS "METADATA"
FROM orders
"""
)
def user_answer_last_text(spark: SparkSession, folder: str) -> DataFrame:
    """Answers whose texts were fetched twice: the later fetch counts."""
    fetch = F.explode(F.array(F.struct(F.lit(2).alias("n"), F.lit("second ").alias("t")), F.struct(F.lit(1).alias("n"), F.lit("word ").alias("t"))))
    fetched = table(spark, folder, "orders").select("o_custkey", "o_orderkey", fetch.alias("fetch")).select(
        F.col("o_custkey").alias("question_id"),
        F.col("o_orderkey").alias("answer_id"),
        F.concat("fetch.t", F.col("o_orderkey").cast("string")).alias("content"),
        F.col("fetch.n").alias("fetched"),
    )
    return member_answers_to_instructions(order_api_pages(spark, folder), fetched, SOURCE, written="fetched")


@query(
    """
SELECT c_name AS "author.name", CAST(c_custkey AS VARCHAR) AS "author.id",
       o_orderkey AS "item.answer", o_custkey AS "item.question.id",
       o_orderpriority AS "item.question.title"
FROM orders JOIN customer ON o_custkey = c_custkey
"""
)
def flatten_records(spark: SparkSession, folder: str) -> DataFrame:
    """Nested records flattened to dotted column names."""
    from askmill.sources import flatten_structs

    joined = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    nested = joined.select(
        F.struct(
            F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("id")
        ).alias("author"),
        F.struct(
            F.col("o_orderkey").alias("answer"),
            F.struct(
                F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("title")
            ).alias("question"),
        ).alias("item"),
    )
    return flatten_structs(nested)


__all__ = ["MEMBER_COLUMNS", "conversation_answers", "order_api_pages"]
