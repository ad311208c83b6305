"""URL predicates and id extraction over page URLs and over URLs built from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.functions import urls as U
from catalog.registry import SITE, query, table


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", "url")


@query("SELECT page_id, url FROM pages WHERE contains(url, 'https://') AND contains(url, '/en/')")
def url_contains(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).where(U.contains_all(F.col("url"), "https://", "/en/"))


@query("SELECT page_id, url FROM pages WHERE contains(url, '/en/') AND NOT contains(url, 'utm')")
def url_contains_not(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).where(U.contains_without(F.col("url"), "/en/", "utm"))


@query(r"SELECT page_id, url FROM pages WHERE regexp_matches(url, '/(en|fr)/\d+(/|\.html)')")
def url_regex(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).where(F.col("url").rlike(r"/(en|fr)/\d+(/|\.html)"))


@query("SELECT page_id, url FROM pages WHERE contains(url, CAST(page_id AS VARCHAR))")
def url_id_contains(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).where(U.contains_id(F.col("url"), F.col("page_id")))


@query(
    """
SELECT page_id, url, regexp_matches(substr(url, 11), '(?i)BLOG|utm|\\.html') AS blocked
FROM pages
"""
)
def url_blocklist(spark: SparkSession, folder: str) -> DataFrame:
    blocked = U.is_blocked(F.col("url"), ["BLOG", "utm", r"\.html"])
    return _pages(spark, folder).withColumn("blocked", blocked)


@query(
    r"""
WITH tails AS (
  SELECT page_id, url, string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1] AS tail FROM pages
)
SELECT page_id, url,
       CASE WHEN regexp_matches(tail, '^\d+$') THEN CAST(tail AS BIGINT) END AS last_id,
       string_split(url, '/')[-2] AS before_last
FROM tails
"""
)
def url_ids(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return _pages(spark, folder).select(
        "page_id",
        "url",
        U.last_part_id(url).alias("last_id"),
        U.path_part(url, -2).alias("before_last"),
    )


def _answer_urls(spark: SparkSession, folder: str) -> DataFrame:
    built = U.answer_url(SITE, F.col("o_custkey"), F.col("o_orderkey"))
    ending = (
        F.when(F.col("o_orderstatus") == "F", "#!")
        .when(F.col("o_orderstatus") == "P", "?write")
        .otherwise("")
    )
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.concat(built, ending).alias("url")
    )


@query(
    """
SELECT o_orderkey, o_custkey AS question_id,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS answer_id,
       CAST(o_custkey AS VARCHAR) AS question_text,
       true AS has_path
FROM orders
"""
)
def answer_url_ids(spark: SparkSession, folder: str) -> DataFrame:
    """URLs built from ids and taken apart again; a query string spoils the answer id."""
    url = F.col("url")
    return _answer_urls(spark, folder).select(
        "o_orderkey",
        U.link_question_id(url).alias("question_id"),
        U.link_answer_id(url).alias("answer_id"),
        U.question_id_text(url).alias("question_text"),
        U.has_answer_path(url).alias("has_path"),
    )


@query(
    """
SELECT c_custkey,
       'https://qa.example.com/people/' || c_name AS member,
       'https://qa.example.com/members/' || c_custkey || '/answers' AS answers,
       'https://qa.example.com/topics#' || c_mktsegment AS topic,
       'https://qa.example.com/topics#' || c_mktsegment || '/top-answers' AS top_answers
FROM customer
"""
)
def url_build(spark: SparkSession, folder: str) -> DataFrame:
    topic = U.topic_list_url(SITE, F.col("c_mktsegment"))
    return table(spark, folder, "customer").select(
        "c_custkey",
        U.member_url(SITE, F.col("c_name")).alias("member"),
        U.member_answers_url(SITE, F.col("c_custkey")).alias("answers"),
        topic.alias("topic"),
        U.top_answers_url(topic).alias("top_answers"),
    )
