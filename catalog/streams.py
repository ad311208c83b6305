"""Streams over landed files, run until the landed files are used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill import sinks, sources
from askmill.plans.answers import ANSWER_KEYS, read_answers
from askmill.schemas import LINKS
from askmill.session import work_path
from askmill.streaming import (
    compact,
    dedup_stream,
    first_seen_stream,
    ingest_stream,
    read_sink,
    stream_csv,
    stream_parquet,
    survivors,
)
from askmill.streaming.first_seen import STATE_STORE
from catalog.answers import _RECORDS, document_pages
from catalog.files import MIXED_LINES, mixed_links
from catalog.registry import SITE, query, table

_KEYS = ["user_id", "event_type"]


def _landed_events(spark: SparkSession, folder: str, files: int = 4, files_per_batch: int = 2):
    """Events landed as several CSV files."""
    events = table(spark, folder, "events").select(*_KEYS)
    path = work_path(spark, "landing")
    sinks.append_csv(events.repartition(files), path)
    return stream_csv(spark, path, events.schema, files_per_batch, multi_line=False)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files appended to a keyed sink, twice over; the second run adds nothing."""
    stream = _landed_events(spark, folder)
    sink = work_path(spark, "sink")
    for _ in range(2):
        state = work_path(spark, "state")
        ingest_stream(stream, sink, _KEYS, state, buckets=8).awaitTermination()
    return read_sink(spark, sink)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Small batches whose buckets are rewritten when they hold over two files, then all of them once more."""
    sink = work_path(spark, "sink")
    stream = _landed_events(spark, folder, files=6, files_per_batch=1)
    ingest_stream(stream, sink, _KEYS, work_path(spark, "state"), buckets=4, compact_beyond=2).awaitTermination()
    compact(spark, sink, _KEYS, beyond=0)
    return read_sink(spark, sink)


@query(
    """
SELECT user_id, event_type, ts, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
"""
)
def stream_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of each key by time, held as state; files arrive in any order."""
    events = table(spark, folder, "events").select(*_KEYS, "ts", "event_id")
    landing, sink = work_path(spark, "landing"), work_path(spark, "sink")
    events.repartition(4).write.parquet(landing)
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, STATE_STORE)
    try:
        stream = stream_parquet(spark, landing, events.schema, files_per_batch=2)
        writer = first_seen_stream(stream, _KEYS, ["ts", "event_id"]).writeStream.outputMode("update")
        writer = writer.option("checkpointLocation", work_path(spark, "state")).trigger(availableNow=True)

        def keep(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

        writer.foreachBatch(keep).start().awaitTermination()
    finally:
        spark.conf.set(name, before)
    return survivors(spark.read.parquet(sink).drop("batch"), _KEYS, ["ts", "event_id"])


@query(
    MIXED_LINES
    + """
SELECT 'good' AS reason, NULL AS line, o_orderkey AS "qId", o_custkey AS aid, title AS question_title, s AS topic_url
FROM l WHERE p NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
UNION ALL SELECT CASE p WHEN '1-URGENT' THEN 'type' ELSE 'fields' END, line, NULL, NULL, NULL, NULL
FROM l WHERE p IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
UNION ALL SELECT 'no key column', 'n_name,n_regionkey', NULL, NULL, NULL, NULL
"""
)
def stream_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Link files of mixed headers streamed into a keyed table; what does not fit is in its quarantine."""
    sink, aside = work_path(spark, "sink"), work_path(spark, "aside")
    stream = sources.stream_headed(spark, mixed_links(spark, folder), LINKS, work_path(spark, "taken"), ["qId", "aid"])
    ingest_stream(
        stream, sink, ["qId", "aid"], work_path(spark, "state"), buckets=8, quarantine=aside
    ).awaitTermination()
    good = read_sink(spark, sink).withColumn("reason", F.lit("good"))
    bad = spark.read.parquet(aside).select("reason", F.col("row").alias("line"))
    return good.unionByName(bad, allowMissingColumns=True).select("reason", "line", *LINKS.fieldNames())


@query(
    """
SELECT count(*) AS added, max(n) AS total FROM (
  SELECT DISTINCT user_id, event_type, (SELECT count(DISTINCT (user_id, event_type)) FROM events) AS n
  FROM events)
"""
)
def stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Sum of the rows added by each batch, and the last running total."""
    metrics = work_path(spark, "metrics")
    query = ingest_stream(
        _landed_events(spark, folder),
        work_path(spark, "sink"),
        _KEYS,
        work_path(spark, "state"),
        metrics=metrics,
        buckets=8,
    )
    query.awaitTermination()
    return spark.read.parquet(metrics).agg(
        F.sum("added").alias("added"), F.max("total").alias("total")
    )


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """First row per key, with the keys kept as the engine's state."""
    sink = work_path(spark, "sink")
    writer = (
        dedup_stream(_landed_events(spark, folder), _KEYS)
        .writeStream.option("checkpointLocation", work_path(spark, "state"))
        .trigger(availableNow=True)
    )
    writer.format("parquet").start(sink).awaitTermination()
    return spark.read.parquet(sink)


def _streamed_answers(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Landed pages streamed through extraction: the answers table and its quarantine."""
    pages = document_pages(spark, folder)
    landing, sink, aside = (work_path(spark, name) for name in ("landing", "sink", "aside"))
    pages.repartition(16).write.parquet(landing)
    ingest_stream(
        stream_parquet(spark, landing, pages.schema, files_per_batch=8),
        sink,
        list(ANSWER_KEYS),
        work_path(spark, "state"),
        transform=lambda batch: read_answers(batch, SITE),
        buckets=8,
        quarantine=aside,
        aside=ANSWER_KEYS,
    ).awaitTermination()
    return sink, aside


@query(
    _RECORDS
    + """
SELECT question_id, answer_id, author_id, question_title, content, upvotes, answer_creation_time,
       request_url
FROM read WHERE reject_reason IS NULL
"""
)
def stream_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Landed pages streamed through extraction into the answers table."""
    return read_sink(spark, _streamed_answers(spark, folder)[0])


@query(
    _RECORDS
    + """
SELECT question_id, answer_id, reject_reason FROM read WHERE reject_reason IS NOT NULL
"""
)
def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of the stream that gave no answer, with the reason."""
    aside = spark.read.parquet(_streamed_answers(spark, folder)[1])
    ids = F.from_json("row", "question_id long, answer_id long")
    return aside.select(ids.alias("ids"), F.col("reason").alias("reject_reason")).select("ids.*", "reject_reason")
