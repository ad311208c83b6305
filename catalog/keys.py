"""Distinct rows, keyed deduplication, counts and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.operators import counts as C
from askmill.operators import joins as J
from askmill.operators.dedup import distinct_rows, distinct_values, keep_first, keep_first_of_files, last_value
from askmill.operators.filters import drop_null_keys
from askmill.plans.answers import consolidate
from askmill.session import work_path
from catalog.registry import query, table

_LINE_COLUMNS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_rows(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"))


@query("SELECT DISTINCT * FROM lineitem")
def distinct_full_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return distinct_rows(lines.union(lines))


@query("SELECT DISTINCT url FROM pages ORDER BY url")
def sorted_distinct_urls(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_values(table(spark, folder, "pages"), "url").orderBy("url")


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate, l_partkey, l_suppkey) = 1
"""
)
def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    """The earliest row per pair, ties broken by the other columns."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    return keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) = 1
"""
)
def dedup_keep_first_late(spark: SparkSession, folder: str) -> DataFrame:
    """The first line of each order, found on narrow columns; its payload is fetched by address."""
    return keep_first_of_files(table(spark, folder, "lineitem"), ["l_orderkey"], ["l_shipdate", "l_linenumber"])


@query(
    f"""
SELECT {_LINE_COLUMNS} FROM (SELECT DISTINCT * FROM lineitem)
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
           l_linestatus, l_shipdate) = 1
"""
)
def consolidate_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated rows dropped, then one row per key under a total order."""
    lines = table(spark, folder, "lineitem")
    return consolidate(lines.union(lines), ["l_orderkey", "l_linenumber"])


@query("SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS unique_answers FROM lineitem")
def distinct_pair_count(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return C.distinct_tuple_count(lines, ["l_orderkey", "l_linenumber"], "unique_answers")


@query(
    """
SELECT count(DISTINCT (CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_orderkey END, l_linenumber))
       AS unique_answers
FROM lineitem
"""
)
def distinct_pair_count_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Tuples with a null in them count."""
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("a"), "l_linenumber"
    )
    return C.distinct_tuple_count(lines, ["a", "l_linenumber"], "unique_answers")


@query("SELECT count(*) AS rows FROM lineitem")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return C.row_count(table(spark, folder, "lineitem"))


@query(
    """
SELECT 'documents' AS stage, count(*) AS rows FROM documents
UNION ALL SELECT 'labelled', count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'pending', count(*) FROM documents
  WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)
"""
)
def stage_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Rows at each stage of a run."""
    documents = table(spark, folder, "documents").select("doc_id")
    labels = table(spark, folder, "labels").select("doc_id")
    return C.stage_metrics(
        {
            "documents": documents,
            "labelled": documents.join(labels.distinct(), "doc_id", "left_semi"),
            "pending": J.without_keys(documents, labels, {"doc_id": "doc_id"}),
        }
    )


@query(
    """
SELECT 'lines' AS stage, count(*) AS rows FROM lineitem
UNION ALL SELECT 'returned', count(*) FROM lineitem WHERE l_returnflag = 'R'
"""
)
def stage_metrics_observed(spark: SparkSession, folder: str) -> DataFrame:
    """Rows at each stage, counted by the writes of the stages."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    seen = {}
    for stage, frame in (("lines", lines), ("returned", lines.where("l_returnflag = 'R'"))):
        frame, seen[stage] = C.observed(frame)
        frame.write.parquet(work_path(spark, stage))
    return C.observed_metrics(spark, seen)


@query(
    """
SELECT o_custkey, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY o_custkey
"""
)
def distinct_count_per_group(spark: SparkSession, folder: str) -> DataFrame:
    return C.distinct_count_by(
        table(spark, folder, "orders"), ["o_custkey"], "o_orderpriority", "priorities"
    )


@query("SELECT o_custkey AS question_id, count(*) AS answers FROM orders GROUP BY o_custkey")
def question_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Answers per question."""
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("question_id"))
    return C.count_by(orders, "question_id", name="answers")


@query(
    """
SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS last_value
FROM events GROUP BY user_id, event_type
"""
)
def last_writer(spark: SparkSession, folder: str) -> DataFrame:
    """The value a map overwritten in time order would end with."""
    events = table(spark, folder, "events")
    return last_value(
        events,
        ["user_id", "event_type"],
        F.col("value"),
        F.struct("ts", "event_id"),
        "last_value",
    )


_LAST = """
WITH latest AS (
  SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS last_value
  FROM events WHERE event_type <> 'error' GROUP BY user_id, event_type
)
"""


def _last_without_errors(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").where("event_type <> 'error'")
    return last_value(
        events,
        ["user_id", "event_type"],
        F.col("value"),
        F.struct("ts", "event_id"),
        "last_value",
    )


@query(
    _LAST
    + """
SELECT event_id, user_id, event_type, last_value
FROM events LEFT JOIN latest USING (user_id, event_type)
"""
)
def lookup_by_pair(spark: SparkSession, folder: str) -> DataFrame:
    """A value looked up by two ids; a pair without one gives null."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return J.lookup(events, _last_without_errors(spark, folder), ["user_id", "event_type"])


@query("SELECT DISTINCT user_id, event_type FROM events WHERE event_type = 'error'")
def lookup_missing_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs that a lookup would miss."""
    events = table(spark, folder, "events")
    return J.lookup_misses(events, _last_without_errors(spark, folder), ["user_id", "event_type"])


@query(
    """
SELECT q, doc_id, lang FROM (
  SELECT CASE WHEN n_chars < 200 THEN NULL ELSE n_chars END AS q, doc_id, lang FROM documents)
QUALIFY row_number() OVER (PARTITION BY q ORDER BY doc_id, lang) = 1 AND q IS NOT NULL
"""
)
def null_key_drop(spark: SparkSession, folder: str) -> DataFrame:
    """One row per key first, then the row of the null key dropped."""
    keyed = table(spark, folder, "documents").select(
        F.when(F.col("n_chars") >= 200, F.col("n_chars")).alias("q"), "doc_id", "lang"
    )
    return drop_null_keys(keep_first(keyed, ["q"], ["doc_id"]), ["q"])
