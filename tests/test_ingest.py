"""The streamed table: one computation a batch, totals, lookups that skip, compaction, first-seen state."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from askmill import sinks
from askmill.streaming import (
    compact,
    first_seen_stream,
    ingest_stream,
    read_sink,
    stream_csv,
    stream_parquet,
    survivors,
)
from askmill.streaming import ingest
from askmill.streaming.first_seen import STATE_STORE


def land(spark, path, data, files=1, schema="a long, b long"):
    spark.createDataFrame(data, schema).repartition(files).write.mode("append").parquet(path)


def stream(spark, path, schema="a long, b long", files_per_batch=1):
    return stream_parquet(spark, path, spark.createDataFrame([], schema).schema, files_per_batch)


def test_a_batch_is_transformed_once(spark, tmp_path):
    landing, seen = str(tmp_path / "in"), spark.sparkContext.accumulator(0)
    land(spark, landing, [(n, n) for n in range(50)] + [(None, 1)], 1)

    def transform(batch):
        def count(frames):
            for frame in frames:
                seen.add(len(frame))
                yield frame

        found = batch.mapInPandas(count, "a long, b long")
        return found.withColumn("reject_reason", F.when(F.col("b") % 10 == 3, F.lit("three")))

    ingest_stream(
        stream(spark, landing), str(tmp_path / "sink"), ["a"], str(tmp_path / "state"), transform=transform, aside=["b"],
        metrics=str(tmp_path / "metrics"),
    ).awaitTermination()
    assert seen.value == 51
    assert read_sink(spark, str(tmp_path / "sink")).count() == 45
    aside = spark.read.parquet(str(tmp_path / "sink-quarantine")).select("reason", "row")
    assert Counter(rows(aside)) == Counter([("three", f'{{"b":{n}}}') for n in (3, 13, 23, 33, 43)] + [("null key", '{"b":1}')])


def test_no_quarantine_is_written_without_rejects(spark, tmp_path):
    land(spark, str(tmp_path / "in"), [(1, 1)])
    ingest_stream(stream(spark, str(tmp_path / "in")), str(tmp_path / "sink"), ["a"], str(tmp_path / "state")).awaitTermination()
    assert not (tmp_path / "sink-quarantine").exists()


def test_totals_are_carried_and_a_cut_off_batch_is_counted(spark, tmp_path, monkeypatch):
    landing, sink, metrics, state = (str(tmp_path / n) for n in ("in", "sink", "metrics", "state"))
    land(spark, landing, [(n, n) for n in range(30)], 1)
    land(spark, landing, [(n, n) for n in range(20, 60)], 1)

    def run():
        ingest_stream(stream(spark, landing), sink, ["a"], state, metrics=metrics).awaitTermination()

    run()
    log = spark.read.parquet(metrics).select("batch_id", "added", "total")
    assert [r["total"] for r in log.orderBy("batch_id").collect()][-1] == 60
    assert log.agg(F.sum("added")).first()[0] == 60

    # A table that was there before its metrics were kept is counted once.
    other = str(tmp_path / "other")
    ingest_stream(stream(spark, landing), sink, ["a"], str(tmp_path / "again"), metrics=other).awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(other).select("added", "total").collect()} == {(0, 60)}

    # The next batch fails after its rows reached the table and before it is recorded.
    land(spark, landing, [(n, n) for n in range(50, 75)], 1)
    written = ingest._write_metrics

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "_write_metrics", fail)
    with pytest.raises(Exception, match="lost"):
        run()
    assert read_sink(spark, sink).count() == 75
    monkeypatch.setattr(ingest, "_write_metrics", written)
    run()
    log = spark.read.parquet(metrics).select("batch_id", "added", "total")
    last = log.orderBy(F.col("batch_id").desc()).first()
    assert (last["added"], last["total"]) == (15, 75)
    assert sorted(read_sink(spark, sink).collect()) == [(n, n) for n in range(75)]


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    """Keys the table does not hold, and a few it does, against files of many row groups."""
    sink = str(tmp_path / "sink")
    table = spark.range(0, 2_000_000, 2, 4).select(
        F.col("id").alias("a"), F.lit(0).alias("key_bucket"), F.lit(0).cast("long").alias("key_generation")
    )
    writer = ingest._key_writer(table.repartitionByRange(4, "a").sortWithinPartitions("a"), ["a"])
    writer.option("parquet.block.row.count.limit", "10000").parquet(sink)
    schema = spark.createDataFrame([], "a long").schema

    def read(keys):
        held = ingest.held_keys(spark, sink, schema, ["a"], [0], keys)
        held.collect()
        plan = held._jdf.queryExecution().executedPlan()
        plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
        leaf = plan.collectLeaves().head()
        return held.count(), leaf.metrics().apply("numOutputRows").value()

    absent = list(range(1, 2_000_000, 200))  # 10,000 odd numbers, spread over all files
    none, scanned = read(absent)
    assert none == 0 and scanned < 200_000
    near = list(range(500_000, 520_000, 2))
    some, scanned = read(near)
    assert some == 10_000 and scanned < 60_000


def test_file_count_is_bounded_over_many_batches(spark, tmp_path):
    landing, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    for n in range(14):
        land(spark, landing, [(k, n) for k in range(n * 5, n * 5 + 10)])
    ingest_stream(
        stream(spark, landing), sink, ["a"], str(tmp_path / "state"), buckets=2, compact_beyond=3
    ).awaitTermination()
    generations = ingest._generations(spark, sink)
    assert all(ingest._small_files(spark, sink, b, generations[b]) <= 3 for b in ingest._buckets(spark, sink))
    assert sorted(read_sink(spark, sink).select("a").collect()) == [(k,) for k in range(75)]


def test_a_kill_between_write_and_switch_loses_nothing(spark, tmp_path, monkeypatch):
    landing, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    land(spark, landing, [(k, k) for k in range(40)], 4)
    ingest_stream(stream(spark, landing), sink, ["a"], str(tmp_path / "state"), buckets=2).awaitTermination()
    want = [(k, k) for k in range(40)]
    real = ingest._key_writer

    class Killed(Exception):
        pass

    class Writer:
        def __init__(self, writer):
            self.writer = writer

        def parquet(self, path):
            self.writer.parquet(path)
            raise Killed

    monkeypatch.setattr(ingest, "_key_writer", lambda *args: Writer(real(*args)))
    with pytest.raises(Killed):
        compact(spark, sink, ["a"], beyond=0)
    monkeypatch.setattr(ingest, "_key_writer", real)
    assert sorted(read_sink(spark, sink).collect()) == want
    # What is appended next goes to the generation in force; a later compaction takes it along.
    land(spark, landing, [(k, k) for k in range(30, 50)])
    ingest_stream(stream(spark, landing), sink, ["a"], str(tmp_path / "state"), buckets=2).awaitTermination()
    want = [(k, k) for k in range(50)]
    assert sorted(read_sink(spark, sink).collect()) == want
    assert compact(spark, sink, ["a"], beyond=0) == [0, 1]
    assert sorted(read_sink(spark, sink).collect()) == want
    assert compact(spark, sink, ["a"], beyond=1) == []
    assert compact(spark, sink, ["a"], beyond=0) == [0, 1]
    assert sorted(read_sink(spark, sink).collect()) == want
    # The generation before the present one stays for readers that began earlier; older ones are gone.
    kept = [sorted(p.name for p in (tmp_path / "sink" / f"key_bucket={b}").iterdir() if "=" in p.name) for b in (0, 1)]
    assert [len(x) for x in kept] == [2, 2]
    assert compact(spark, str(tmp_path / "absent"), ["a"]) == []


@pytest.mark.parametrize("files_per_batch", [1, 3])
def test_first_seen_rows_do_not_depend_on_the_batches(spark, tmp_path, files_per_batch):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    data = [(k % 7, (k * 37) % 100, f"r{k}") for k in range(90)] + [(None, 1, "x"), (1, None, "y")]
    for n in range(6):
        land(spark, landing, data[n::6], 1, "k long, place long, row string")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    try:
        source = stream(spark, landing, "k long, place long, row string", files_per_batch)
        found = first_seen_stream(source, ["k"], ["place", "row"])
        (
            found.writeStream.outputMode("update")
            .option("checkpointLocation", str(tmp_path / "state"))
            .trigger(availableNow=True)
            .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"))
            .start()
            .awaitTermination()
        )
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    given_on = spark.read.parquet(out).drop("batch")
    best = {}
    for k, place, row in data:
        if k is not None and place is not None:
            best[k] = min(best.get(k, (place, row)), (place, row))
    assert rows(survivors(given_on, ["k"], ["place", "row"])) == sorted(((k, *v) for k, v in best.items()), key=repr)
    assert given_on.count() <= 90


def test_csv_without_line_breaks_is_split(spark, tmp_path):
    path = str(tmp_path / "in")
    sinks.append_csv(spark.range(10).withColumnRenamed("id", "a"), path)
    found = stream_csv(spark, path, spark.createDataFrame([], "a long").schema, multi_line=False)
    ingest_stream(found, str(tmp_path / "sink"), ["a"], str(tmp_path / "state")).awaitTermination()
    assert rows(read_sink(spark, str(tmp_path / "sink"))) == [(n,) for n in range(10)]


def test_first_seen_state_calls_no_python_and_gives_on_only_what_is_less(spark, tmp_path):
    landing, out, schema = str(tmp_path / "in"), str(tmp_path / "out"), "k long, place long, m map<string,long>"
    land(spark, landing, [], 1, schema)
    found = first_seen_stream(stream(spark, landing, schema), ["k"], ["place"])
    assert "TransformWithState" not in found._jdf.queryExecution().analyzed().toString()
    for n, batch in enumerate([[(1, 5, {"a": 1}), (1, 4, {"a": 2}), (2, 3, None)], [(1, 4, {"a": 3}), (2, 2, None)], [(1, 9, {}), (None, 0, {})]]):
        land(spark, landing, batch, 1, schema)
        writer = found.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state"))
        keep = writer.foreachBatch(lambda part, _, n=n: part.write.mode("overwrite").parquet(f"{out}/batch={n}"))
        keep.trigger(availableNow=True).start().awaitTermination()
    given_on = spark.read.parquet(out).selectExpr("batch", "k", "place", "m['a'] AS a")
    assert rows(given_on) == sorted([(0, 1, 4, 2), (0, 2, 3, None), (1, 2, 2, None)], key=repr)
