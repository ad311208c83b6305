"""Landed files to a keyed Parquet table, in micro-batches.

The table is laid out by a hash bucket of the key and, within a bucket, by generation. A micro-batch is
computed once, kept, and compared with the key columns of the buckets it touches; files are sorted by key
and carry Bloom filters on it, so a batch of few keys reads only the row groups that may hold them. No key
state is kept between batches. ``compact`` rewrites buckets of many small files as one generation more, and
``read_sink`` reads the last complete generation of each bucket.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, IntegralType, LongType, StringType, StructField, StructType
from pyspark.storagelevel import StorageLevel

from askmill.operators.batches import hash_bucket
from askmill.operators.dedup import keep_first
from askmill.operators.joins import without_keys
from askmill.session import file_system
from askmill.sources import headed

BUCKET_COLUMN, GENERATION_COLUMN = "key_bucket", "key_generation"
LAYOUT = (BUCKET_COLUMN, GENERATION_COLUMN)
#: The text of a CSV row that did not fit; null in all others.
CORRUPT_COLUMN = "_corrupt_line"
#: A transform's rows with a reason here are set aside.
REASON_COLUMN = "reject_reason"
#: Lists of keys that a scan of the table may be given; a list is as long as the session lets the reader push down.
#: Low, since a batch asks a row group's filter for all its keys: of 10,000 about one in a hundred groups hits falsely.
FALSE_HITS = 1e-6
#: Files under this many bytes count as small.
SMALL_FILE = 1 << 25
LOOKUP_LISTS, _LIST_LENGTH = 40, "spark.sql.parquet.pushdown.inFilterThreshold"

_GENERATIONS = StructType([StructField("bucket", IntegerType()), StructField("generation", LongType())])
_METRICS_SCHEMA = StructType().add("batch_id", "long").add("added", "long").add("total", "long")


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    files_per_batch: int | None = None,
    keep_corrupt: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Watch a folder of CSV files that share the schema's header; another header fails.

    With ``keep_corrupt`` a column holds the text of rows that do not fit, which ``ingest_stream`` sets aside.
    ``sources.stream_headed`` binds files by their own headers instead. Files without quoted line breaks
    are split where ``multi_line`` is off.
    """
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType())])
    reader = (
        spark.readStream.schema(schema)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def stream_parquet(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Watch a folder of Parquet files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def dedup_stream(
    stream: DataFrame, keys: Sequence[str], time_column: str | None = None, bound: str | None = None
) -> DataFrame:
    """First row per key over the whole stream, kept as state in the engine.

    State grows with the keys. With a time column and a bound, keys are forgotten once
    they lie that far behind.
    """
    if time_column and bound:
        return stream.withWatermark(time_column, bound).dropDuplicatesWithinWatermark(list(keys))
    return stream.dropDuplicates(list(keys))


def _read_if_present(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at the path, or an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _beside(sink: str, name: str) -> str:
    return f"{sink.rstrip('/')}-{name}"


def _generations(spark: SparkSession, sink: str) -> dict[int, int]:
    """The last complete generation of each compacted bucket; at most one entry a bucket."""
    switches = _read_if_present(spark, _beside(sink, "generations"), _GENERATIONS)
    return {row[0]: row[1] for row in switches.groupBy("bucket").agg(F.max("generation")).collect()}


def _current(generations: dict[int, int]) -> Column:
    """The generation of a row's bucket that counts; 0 before the first compaction."""
    if not generations:
        return F.lit(0).cast("long")
    entries = [F.lit(x) for entry in generations.items() for x in entry]
    return F.coalesce(F.try_element_at(F.create_map(*entries), F.col(BUCKET_COLUMN)), F.lit(0)).cast("long")


def _with_layout(schema: StructType) -> StructType:
    own = [field for field in schema.fields if field.name not in LAYOUT]
    return StructType([*own, StructField(BUCKET_COLUMN, IntegerType()), StructField(GENERATION_COLUMN, LongType())])


def _laid_out(spark: SparkSession, sink: str, schema: StructType, generations: dict[int, int]) -> DataFrame:
    held = _read_if_present(spark, sink, _with_layout(schema))
    # A condition on partition columns: folders of other generations are not opened.
    return held.where(F.col(GENERATION_COLUMN) == _current(generations))


def read_sink(spark: SparkSession, sink: str, schema: StructType | None = None) -> DataFrame:
    """The rows of a table written by ``ingest_stream``, without the columns of its layout."""
    if schema is None:
        schema = spark.read.parquet(sink).schema
    return _laid_out(spark, sink, schema, _generations(spark, sink)).drop(*LAYOUT)


def _key_writer(frame: DataFrame, keys: Sequence[str]) -> DataFrameWriter:
    writer = frame.write.mode("append").partitionBy(*LAYOUT)
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer = writer.option(f"parquet.bloom.filter.fpp#{key}", str(FALSE_HITS))
    # Sized by the keys a row group holds, up to this many bytes.
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    return writer.option("parquet.bloom.filter.max.bytes", str(1 << 23))


def held_keys(
    spark: SparkSession,
    sink: str,
    schema: StructType,
    keys: Sequence[str],
    buckets: Sequence[int],
    first_keys: Sequence = (),
    generations: dict[int, int] | None = None,
) -> DataFrame:
    """The keys the table holds in these buckets; with ``first_keys``, whole numbers, only those whose first column
    is among them.

    The values go into the scan's filter, where statistics and Bloom filters rule out row groups. They go as lists
    of the length the reader takes, put together as a balanced tree: one long list would not be pushed down.
    """
    generations = _generations(spark, sink) if generations is None else generations
    held = _laid_out(spark, sink, schema, generations).where(F.col(BUCKET_COLUMN).isin(list(buckets)))
    values, step = sorted(first_keys), max(1, int(spark.conf.get(_LIST_LENGTH)))
    lists = (values[n : n + step] for n in range(0, len(values), step))
    tests = [F.expr(f"`{keys[0]}` IN ({', '.join(map(str, some))})") for some in lists]
    while len(tests) > 1:
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + tests[len(tests) // 2 * 2 :]
    return (held.where(tests[0]) if tests else held).select(*keys)


def _last_number(spark: SparkSession, folder: str) -> int:
    system, place = file_system(spark, folder)
    if not system.exists(place):
        return -1
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return max((int(name) for name in names if name.isdigit()), default=-1)


def _unfinished_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The batch that an earlier run began and did not commit; it will run again first."""
    begun = _last_number(spark, f"{checkpoint}/offsets")
    return begun if begun > _last_number(spark, f"{checkpoint}/commits") else None


def _split_source_rejects(batch: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """A batch's good rows, and reason and text of those that its reader set aside."""
    if CORRUPT_COLUMN in batch.columns:
        text, reason, own = F.col(CORRUPT_COLUMN), F.lit("corrupt"), [CORRUPT_COLUMN]
        bad = text.isNotNull()
    elif headed.REASON_COLUMN in batch.columns:
        text, reason, own = F.col(headed.REJECT_COLUMN), F.col(headed.REASON_COLUMN), list(headed.EXTRA)
        bad = reason.isNotNull()
    else:
        return batch, None
    return batch.where(~bad).drop(*own), batch.where(bad).select(reason.alias("_reason"), text.alias("_row"))


def ingest_stream(
    stream: DataFrame,
    sink: str,
    keys: Sequence[str],
    checkpoint: str,
    metrics: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = 64,
    available_now: bool = True,
    quarantine: str | None = None,
    aside: Sequence[str] | None = None,
    compact_beyond: int | None = None,
) -> StreamingQuery:
    """Append the rows of a stream whose keys the sink does not hold; read them with ``read_sink``.

    Each micro-batch is transformed and kept once. Rows the reader set aside, rows the transform gives a
    ``reject_reason``, and rows with a null key go to ``quarantine``, by default the sink's path with
    ``-quarantine``, as ``reason`` and ``row`` (JSON of the ``aside`` columns, of all if none are named); a batch
    without such rows writes nothing there. Of the rest one row per key is kept, keys in the sink are removed, and
    what is left is appended. A batch that is run again after a failure finds its own rows in the sink and adds
    only what is missing.

    ``metrics`` receives one row per batch: ``batch_id``, ``added``, ``total``. Added rows are counted by the
    write itself and the total is carried forward; the sink is counted only where nothing is recorded yet and for a
    batch that an earlier run left unfinished, which may have added rows.
    With ``compact_beyond`` buckets of more files than that are rewritten after a batch. With ``available_now`` the
    query ends when the landed files are used up.
    """
    keys = list(keys)
    unfinished = _unfinished_batch(stream.sparkSession, checkpoint)
    # The one writer of the table knows its generations: read once a run, and after a compaction.
    generations = _generations(stream.sparkSession, sink)

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = f"query={spark.sparkContext.getLocalProperty('sql.streaming.queryId')}/batch={batch_id}"
        raw = None
        if transform and {CORRUPT_COLUMN, headed.REASON_COLUMN} & set(batch.columns):
            batch = raw = batch.persist(StorageLevel.MEMORY_AND_DISK)  # two branches read it
        good, refused = _split_source_rejects(batch)
        rows = transform(good) if transform else good
        data = [c for c in rows.columns if c != REASON_COLUMN]
        whole = F.lit(True)
        for key in keys:
            whole = whole & F.col(key).isNotNull()
        reason = F.when(~whole, F.lit("null key"))
        if REASON_COLUMN in rows.columns:
            reason = F.coalesce(F.col(REASON_COLUMN), reason)
        rows = rows.select(*data, reason.alias("_reason"))
        text = F.to_json(F.struct(*(aside or data)), {"ignoreNullFields": "false"})
        rows = hash_bucket(rows, keys, buckets, BUCKET_COLUMN)
        rows = rows.withColumns(
            {
                "_row": F.when(F.col("_reason").isNotNull(), text),
                BUCKET_COLUMN: F.when(F.col("_reason").isNull(), F.col(BUCKET_COLUMN)),
            }
        )
        schema = rows.select(*data).schema
        if refused is not None:
            rows = rows.unionByName(refused, allowMissingColumns=True)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sizes = {row[0]: row[1] for row in rows.groupBy(BUCKET_COLUMN).count().collect()}
            if sizes.pop(None, 0):
                bad = rows.where(F.col("_reason").isNotNull())
                bad = bad.select(F.col("_reason").alias("reason"), F.col("_row").alias("row"))
                # A batch that runs again replaces its own rows.
                bad.write.mode("overwrite").parquet(f"{quarantine or _beside(sink, 'quarantine')}/{place}")
            recorded = _recorded_total(spark, metrics, place, batch_id) if metrics else None
            before = recorded
            if metrics and (recorded is None or batch_id == unfinished):
                before = _laid_out(spark, sink, schema, generations).count()
            added = 0
            if sizes:
                good = rows.where(F.col("_reason").isNull())
                fresh = keep_first(good.select(*data, BUCKET_COLUMN), keys)
                system, folder = file_system(spark, sink)
                if system.exists(folder):
                    names = []
                    numbers = isinstance(schema[keys[0]].dataType, IntegralType)
                    if numbers and sum(sizes.values()) <= LOOKUP_LISTS * int(spark.conf.get(_LIST_LENGTH)):
                        names = [row[0] for row in good.select(keys[0]).distinct().collect()]
                    held = held_keys(spark, sink, schema, keys, list(sizes), names, generations)
                    fresh = without_keys(fresh, held, {k: k for k in keys})
                fresh = fresh.withColumn(GENERATION_COLUMN, _current(generations))
                # One file per bucket, or several where a bucket's share of the batch is large.
                fresh = fresh.hint("rebalance", BUCKET_COLUMN).sortWithinPartitions(*LAYOUT, *keys)
                seen = Observation()
                _key_writer(fresh.observe(seen, F.count("*").alias("added")), keys).parquet(sink)
                added = seen.get["added"]
            if metrics:
                total = before + added
                _write_metrics(spark, metrics, place, batch_id, total - (before if recorded is None else recorded), total)
            if compact_beyond is not None and compact(spark, sink, keys, compact_beyond):
                generations.update(_generations(spark, sink))
        finally:
            rows.unpersist()
            if raw is not None:
                raw.unpersist()

    writer = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _recorded_total(spark: SparkSession, metrics: str, place: str, batch_id: int) -> int | None:
    """The table's size as recorded before this batch; None where nothing is recorded."""
    query = place.split("/")[0].removeprefix("query=")
    log = _read_if_present(spark, metrics, StructType([*_METRICS_SCHEMA.fields, StructField("query", StringType())]))
    return log.where((F.col("query") != query) | (F.col("batch_id") < batch_id)).agg(F.max("total")).first()[0]


def _write_metrics(spark: SparkSession, metrics: str, place: str, batch_id: int, added: int, total: int) -> None:
    """Record what a batch added and the table's size; a batch that runs again replaces its own row."""
    row = spark.createDataFrame([(batch_id, added, total)], _METRICS_SCHEMA)
    row.write.mode("overwrite").parquet(f"{metrics}/{place}")


def _buckets(spark: SparkSession, sink: str) -> list[int]:
    system, place = file_system(spark, sink)
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{BUCKET_COLUMN}="))


def _small_files(spark: SparkSession, sink: str, bucket: int, generation: int) -> int:
    folder = f"{sink.rstrip('/')}/{BUCKET_COLUMN}={bucket}/{GENERATION_COLUMN}={generation}"
    system, place = file_system(spark, folder)
    if not system.exists(place):
        return 0
    return sum(1 for status in system.listStatus(place) if status.isFile() and status.getLen() < SMALL_FILE)


def compact(spark: SparkSession, sink: str, keys: Sequence[str], beyond: int = 16) -> list[int]:
    """Rewrite the buckets that hold more than ``beyond`` small files, sorted by key, as a new generation.

    The new files count once a row in the ``-generations`` table says so, which is one small append: a run that
    is killed before it leaves the old generation in force, and its own files unread. A replaced generation stays
    until the next compaction of its bucket, for readers that began before the switch. Meant to run between
    batches, by the one writer of the table. Returns the buckets rewritten.
    """
    generations = _generations(spark, sink)
    try:
        frame = spark.read.parquet(sink)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    full = [bucket for bucket in _buckets(spark, sink) if _small_files(spark, sink, bucket, generations.get(bucket, 0)) > beyond]
    if not full:
        return []
    generation = time.time_ns()
    rows = _laid_out(spark, sink, frame.schema, generations).where(F.col(BUCKET_COLUMN).isin(full))
    rows = rows.withColumn(GENERATION_COLUMN, F.lit(generation))
    rows = rows.hint("rebalance", BUCKET_COLUMN).sortWithinPartitions(*LAYOUT, *keys)
    _key_writer(rows, list(keys)).parquet(sink)
    switch = spark.createDataFrame([(bucket, generation) for bucket in full], _GENERATIONS)
    switch.coalesce(1).write.mode("append").parquet(_beside(sink, "generations"))
    for bucket in full:
        _drop_older(spark, f"{sink.rstrip('/')}/{BUCKET_COLUMN}={bucket}", generations.get(bucket, 0))
    return full


def _drop_older(spark: SparkSession, folder: str, generation: int) -> None:
    """Remove a bucket's generations before this one; unfinished ones of killed runs lie among them."""
    system, place = file_system(spark, folder)
    for status in system.listStatus(place):
        name = status.getPath().getName()
        if name.startswith(f"{GENERATION_COLUMN}=") and int(name.split("=")[1]) < generation:
            system.delete(status.getPath(), True)
