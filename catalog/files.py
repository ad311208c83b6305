"""Round trips through files and tables under the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill import sinks, sources
from askmill.sources.headed import REASON_COLUMN, REJECT_COLUMN
from askmill.plans.answers import consolidate_to_table
from askmill.schemas import LINKS
from askmill.session import work_path
from catalog.registry import new_database, query, table


@query("SELECT * FROM documents")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts through CSV and back, line breaks and quotes included."""
    documents = table(spark, folder, "documents")
    path = work_path(spark, "csv")
    sinks.write_csv(documents, path)
    return sources.read_csv(spark, path, documents.schema)


@query("SELECT doc_id, CASE WHEN n_chars < 300 THEN ' ' WHEN n_chars > 3000 THEN NULL ELSE ' ' || lang || ' ' END AS blank FROM documents")
def csv_blanks(spark: SparkSession, folder: str) -> DataFrame:
    """Blanks survive, an empty field is null, and only the columns asked for are parsed."""
    blank = (
        F.when(F.col("n_chars") < 300, F.lit(" "))
        .when(F.col("n_chars") <= 3000, F.concat(F.lit(" "), F.col("lang"), F.lit(" ")))
        .alias("blank")
    )
    documents = table(spark, folder, "documents").select("doc_id", blank, "text")
    path = work_path(spark, "csv")
    sinks.write_csv(documents, path, quote_all=False)
    return sources.read_csv(spark, path, documents.schema, ["doc_id", "blank"])


def _landed_links(spark: SparkSession, folder: str) -> str:
    """Link files with different column orders, an index column, bad ids and empty files."""
    orders = table(spark, folder, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("zz"), F.col("o_orderkey").cast("string")))
        .otherwise(F.col("o_orderkey").cast("string"))
        .alias("qId"),
        F.col("o_custkey").cast("string").alias("aid"),
        F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('", a')).alias("question_title"),
        F.col("o_orderstatus").alias("topic_url"),
    )
    path = work_path(spark, "links")
    index = F.monotonically_increasing_id().alias("Unnamed")
    layouts = {
        "O": ["qId", "aid", "question_title", "topic_url"],
        "F": ["topic_url", "aid", "qId", "question_title"],
        "P": [index, "qId", "aid", "question_title", "topic_url"],
    }
    for status, columns in layouts.items():
        sinks.append_csv(orders.where(F.col("topic_url") == status).select(*columns), path)
    return path


@query(
    """
SELECT o_orderkey AS "qId", o_custkey AS aid,
       'say "' || o_orderpriority || '", a' AS question_title, o_orderstatus AS topic_url
FROM orders WHERE o_orderpriority <> '1-URGENT'
"""
)
def csv_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Link files read by their own headers; rows that do not fit set aside."""
    frame = sources.read_csv_files(spark, _landed_links(spark, folder), LINKS, ["qId", "aid"])
    return sources.split_rejects(frame)[0]


@query(
    """
SELECT o_orderkey, true AS has_text FROM orders WHERE o_orderpriority = '1-URGENT'
"""
)
def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that did not fit, found by their text."""
    frame = sources.read_csv_files(spark, _landed_links(spark, folder), LINKS, ["qId", "aid"])
    line = F.col(REJECT_COLUMN)
    return sources.split_rejects(frame)[1].select(
        F.regexp_extract(line, r"zz(\d+)", 1).cast("bigint").alias("o_orderkey"),
        line.contains("URGENT").alias("has_text"),
    )


def mixed_links(spark: SparkSession, folder: str) -> str:
    """Link files of three layouts with untyped, short and long rows, and a file without the keys."""
    path = work_path(spark, "mixed")
    priority, key = F.col("o_orderpriority"), F.col("o_orderkey").cast("string")
    orders = table(spark, folder, "orders").select(
        key.alias("k"),
        F.when(priority == "1-URGENT", F.concat(F.lit("zz"), key)).otherwise(key).alias("q"),
        F.col("o_custkey").cast("string").alias("a"),
        F.concat(F.lit('"say ""'), priority, F.lit('"", a"')).alias("t"),
        F.col("o_orderstatus").alias("s"),
        priority.alias("p"),
    )
    layouts = {
        "O": ("qId,aid,question_title,topic_url", ["q", "a", "t", "s"]),
        "F": ("topic_url,aid,qId,question_title", ["s", "a", "q", "t"]),
        "P": (",qId,aid,question_title,topic_url", ["k", "q", "a", "t", "s"]),
    }

    def land(lines: DataFrame) -> None:
        # Whole lines as one column, under a separator that does not occur: nothing is quoted anew.
        writer = lines.write.mode("append").option("header", True).option("sep", "\u0001").option("quote", "")
        writer.csv(path)

    for status, (header, fields) in layouts.items():
        row = F.array(*fields)
        row = (
            F.when(F.col("p") == "2-HIGH", F.slice(row, 1, len(fields) - 1))
            .when(F.col("p") == "3-MEDIUM", F.array_append(row, F.lit("x")))
            .otherwise(row)
        )
        land(orders.where(F.col("s") == status).select(F.concat_ws(",", row).alias(header)))
    nations = table(spark, folder, "nation").select(F.concat_ws(",", "n_name", "n_regionkey").alias("n_name,n_regionkey"))
    land(nations.coalesce(1))
    return path


MIXED_LINES = """
WITH t AS (
    SELECT o_orderkey, o_custkey, o_orderstatus AS s, o_orderpriority AS p, o_orderkey::VARCHAR AS k,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'zz' ELSE '' END || o_orderkey AS q, o_custkey::VARCHAR AS a,
        'say "' || o_orderpriority || '", a' AS title, '"say ""' || o_orderpriority || '"", a"' AS t
    FROM orders
), f AS (
    SELECT *, CASE s WHEN 'O' THEN [q, a, t, s] WHEN 'F' THEN [s, a, q, t] ELSE [k, q, a, t, s] END AS fields FROM t
), l AS (
    SELECT *, array_to_string(CASE p WHEN '2-HIGH' THEN fields[1:len(fields) - 1] WHEN '3-MEDIUM' THEN list_append(fields, 'x')
        ELSE fields END, ',') AS line FROM f
)
"""


@query(
    MIXED_LINES
    + """
SELECT 'good' AS reason, NULL AS line, o_orderkey AS "qId", o_custkey AS aid, title AS question_title, s AS topic_url
FROM l WHERE p NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
UNION ALL SELECT 'type', line, NULL, o_custkey, title, s FROM l WHERE p = '1-URGENT'
UNION ALL SELECT 'fields', line, NULL, NULL, NULL, NULL FROM l WHERE p IN ('2-HIGH', '3-MEDIUM')
UNION ALL SELECT 'no key column', 'n_name,n_regionkey', NULL, NULL, NULL, NULL
"""
)
def csv_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Files bound by their own headers; all that does not fit, rows and files, with the reason."""
    frame = sources.read_headed(spark, mixed_links(spark, folder), LINKS, ["qId", "aid"])
    reason = F.coalesce(REASON_COLUMN, F.lit("good")).alias("reason")
    return frame.select(reason, F.col(REJECT_COLUMN).alias("line"), *LINKS.fieldNames())


@query("SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def csv_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends to one CSV dataset; an empty third writes nothing."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey AS c_custkey", "s_name AS c_name")
    path = work_path(spark, "csv")
    for frame in (customers, suppliers, suppliers.where("c_custkey < 0")):
        sinks.append_csv(frame, path)
    return sources.read_csv(spark, path, customers.schema)


@query("SELECT * FROM customer")
def parquet_row_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet with row groups of a hundred rows."""
    path = work_path(spark, "parquet")
    sinks.write_parquet(table(spark, folder, "customer"), path, rows_per_group=100)
    return sources.read_parquet(spark, path)


@query("SELECT c_custkey, c_name FROM customer")
def parquet_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Two columns of a Parquet table."""
    return sources.read_parquet(spark, f"{folder}/customer.parquet", ["c_custkey", "c_name"])


@query(
    """
SELECT o_custkey, o_orderkey FROM orders
UNION ALL SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'
"""
)
def table_append(spark: SparkSession, folder: str) -> DataFrame:
    """A table created from a query and appended to by name, columns in another order."""
    orders = table(spark, folder, "orders")
    name = f"{new_database(spark)}.raw_answers"
    sinks.append_to_table(orders.select("o_custkey", "o_orderkey"), name)
    sinks.append_to_table(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), name)
    return sources.read_table(spark, name)


@query(
    """
SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate FROM lineitem
"""
)
def table_create_once(spark: SparkSession, folder: str) -> DataFrame:
    """A second create of the same table changes nothing."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    name = f"{new_database(spark)}.answers"
    sinks.create_table_as(lines.distinct(), name)
    sinks.create_table_as(lines.where("l_linenumber = 1"), name)
    return sources.read_table(spark, name)


@query(
    """
SELECT 'answers' AS table_name, count(*) AS rows FROM (SELECT DISTINCT o_custkey FROM orders)
UNION ALL SELECT 'raw_answers', count(*) FROM orders
"""
)
def list_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The tables of a database with their sizes."""
    orders = table(spark, folder, "orders").select("o_custkey")
    database = new_database(spark)
    sinks.create_table_as(orders, f"{database}.raw_answers")
    sinks.create_table_as(orders.distinct(), f"{database}.answers")
    sinks.create_table_as(orders, f"{database}.scratch")
    sinks.drop_table(spark, f"{database}.scratch")
    sizes = None
    for name in ("raw_answers", "answers"):
        size = spark.table(f"{database}.{name}").agg(F.count("*").alias("rows"))
        size = size.select(F.lit(name).alias("table_name"), "rows")
        sizes = size if sizes is None else sizes.unionByName(size)
    return sinks.list_tables(spark, database).join(sizes, "table_name", "left")


@query(
    """
SELECT l_orderkey AS question_id, l_linenumber AS answer_id, l_returnflag, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_returnflag, l_shipdate) = 1
"""
)
def table_consolidate(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct rows kept as a table, its unique answers exported to Parquet."""
    raw = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS question_id", "l_linenumber AS answer_id", "l_returnflag", "l_shipdate"
    )
    return consolidate_to_table(raw, f"{new_database(spark)}.answers", work_path(spark, "unique"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000")
def sql_over_frame(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over a DataFrame named in the text."""
    return sources.query_frame(
        spark,
        "SELECT o_orderkey, o_custkey FROM {orders} WHERE o_totalprice > 100000",
        orders=table(spark, folder, "orders"),
    )


@query(
    """
SELECT column_name, column_type, position, (SELECT count(*) FROM customer) AS row_count
FROM (VALUES (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'),
             (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string'))
     columns(position, column_name, column_type)
"""
)
def publish_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The published dataset's columns, types and row count."""
    return sinks.publish(table(spark, folder, "customer"), work_path(spark, "published"), files=4)


@query(
    """
SELECT column_name, column_type, position, (SELECT count(*) FROM documents) AS rows, CAST(nulls AS BIGINT) AS nulls
FROM (VALUES (0, 'doc_id', 'bigint'), (1, 'text', 'string'), (2, 'lang', 'string'), (3, 'source', 'string'),
             (4, 'n_chars', 'bigint'), (5, 'long_text', 'string')) columns(position, column_name, column_type)
JOIN (SELECT unnest([0, 1, 2, 3, 4, 5]) AS position, unnest([count_if(doc_id IS NULL), count_if(text IS NULL),
    count_if(lang IS NULL), count_if(source IS NULL), count_if(n_chars IS NULL), count_if(n_chars <= 2000)]) AS nulls
    FROM documents) USING (position)
"""
)
def table_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of a table in order, with their types and their nulls."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long"))
    return sinks.column_list(documents.withColumn("long_text", F.when(F.col("n_chars") > 2000, F.col("text"))))


@query("SELECT key, value FROM (SELECT 'k' AS key, CAST(props ->> '$.k' AS INT) AS value FROM events)")
def map_files(spark: SparkSession, folder: str) -> DataFrame:
    """JSON objects written one to a line and read as key/value rows."""
    path = work_path(spark, "maps")
    table(spark, folder, "events").select("props").write.text(path)
    return sources.read_map_file(spark, path, per_line=True)



@query("SELECT o_orderkey, o_orderdate FROM orders")
def table_export(spark: SparkSession, folder: str) -> DataFrame:
    """A table's rows written to Parquet and read back."""
    name = f"{new_database(spark)}.orders"
    sinks.create_table_as(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), name)
    path = work_path(spark, "export")
    sinks.table_to_parquet(spark, name, path)
    return sources.read_parquet(spark, path)
