"""Scalar functions and caller-supplied Python."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.functions.clock import elapsed_more_than, from_epoch
from askmill.functions.jsontext import json_value
from askmill.functions.text import composed_key, random_hex_id, strip_text
from askmill.operators.custom import apply_value, map_batches
from askmill.operators.joins import join_aggregate, union_by_name
from askmill.sources import map_entries
from catalog.registry import query, table


@query(
    """
WITH first AS (SELECT user_id, min(ts) AS started FROM events GROUP BY user_id)
SELECT event_id, user_id FROM events JOIN first USING (user_id)
WHERE ts > started + INTERVAL 20 MINUTE
"""
)
def elapsed_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Events more than twenty minutes after their user's first event."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    first = events.groupBy("user_id").agg(F.min("ts").alias("started"))
    late = join_aggregate(events, first, ["user_id"]).where(elapsed_more_than(F.col("started"), F.col("ts")))
    return late.select("event_id", "user_id")


@query(
    """
SELECT o_orderkey,
       epoch_ms(o_orderkey * 1000) > epoch_ms(o_custkey * 1000) + INTERVAL 20 MINUTE AS due
FROM orders
"""
)
def epoch_elapsed(spark: SparkSession, folder: str) -> DataFrame:
    """Epoch seconds turned into instants and compared."""
    due = elapsed_more_than(from_epoch(F.col("o_custkey")), from_epoch(F.col("o_orderkey")))
    return table(spark, folder, "orders").select("o_orderkey", due.alias("due"))


@query(
    """
SELECT event_id, props ->> '$.k' AS k, props ->> '$.absent' AS absent FROM events
"""
)
def props_json(spark: SparkSession, folder: str) -> DataFrame:
    """JSON values by key; an absent key gives null."""
    return table(spark, folder, "events").select(
        "event_id",
        json_value(F.col("props"), "k").alias("k"),
        json_value(F.col("props"), "absent").alias("absent"),
    )


@query(
    """
SELECT key, count(*) AS entries, CAST(sum(value) AS BIGINT) AS total
FROM (SELECT unnest(json_keys(props)) AS key, CAST(props ->> '$.k' AS INT) AS value FROM events)
GROUP BY key
"""
)
def map_rows(spark: SparkSession, folder: str) -> DataFrame:
    """JSON objects as key/value rows, totalled by key."""
    entries = map_entries(table(spark, folder, "events").select("props"), F.col("props"))
    return entries.groupBy("key").agg(
        F.count("*").alias("entries"), F.sum("value").alias("total")
    )


@query(
    """
SELECT l_orderkey, l_linenumber, concat(l_orderkey, l_linenumber) AS pair_key,
       concat(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_orderkey END, l_linenumber) AS null_key
FROM lineitem
"""
)
def composed_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Two ids written as one text, a null as nothing."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        composed_key(order, line).alias("pair_key"),
        composed_key(F.when(F.col("l_returnflag") != "N", order), line).alias("null_key"),
    )


@query(
    r"""
SELECT doc_id,
       regexp_replace(chr(12288) || text || chr(160) || chr(10),
                      '^[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]+|[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]+\z',
                      '', 'g') AS stripped
FROM documents
"""
)
def strip_unicode(spark: SparkSession, folder: str) -> DataFrame:
    """Wide and no-break spaces and line breaks stripped from both ends."""
    padded = F.concat(F.lit("　"), F.col("text"), F.lit(" \n"))
    return table(spark, folder, "documents").select("doc_id", strip_text(padded).alias("stripped"))


@query("SELECT c_custkey, 32 AS id_length, true AS is_hex FROM customer")
def random_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Random identifiers, checked for their form."""
    named = table(spark, folder, "customer").select("c_custkey", random_hex_id().alias("id"))
    return named.select(
        "c_custkey",
        F.length("id").alias("id_length"),
        F.col("id").rlike(r"^[0-9a-f]{32}\z").alias("is_hex"),
    )


@query(
    """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
"""
)
def union_missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables united by column name; the column one lacks is null."""
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_acctbal AS balance", "s_suppkey AS key", "s_name AS name"
    )
    return union_by_name(customers, suppliers)


@query("SELECT doc_id, CAST(length(text) - length(replace(text, 'e', '')) AS BIGINT) AS e_count FROM documents")
def apply_value_function(spark: SparkSession, folder: str) -> DataFrame:
    """A caller's Python function of one value."""
    texts = table(spark, folder, "documents").select("doc_id", "text")
    counted = apply_value(texts, "text", lambda text: text.count("e"), "bigint", "e_count")
    return counted.select("doc_id", "e_count")


@query(
    """
SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
"""
)
def map_batches_function(spark: SparkSession, folder: str) -> DataFrame:
    """A caller's Python function of a batch of rows that returns more rows."""

    def lines(batch: pd.DataFrame) -> pd.DataFrame:
        split = batch.assign(line=batch["text"].str.split("\n"))
        return split.explode("line")[["doc_id", "line"]]

    texts = table(spark, folder, "documents").select("doc_id", "text")
    return map_batches(texts, lines, "doc_id long, line string")
