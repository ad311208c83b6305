"""Properties that hold for any input, plans, skew, and streams."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from askmill.sources import api
from askmill import sinks
from askmill.operators import batches, counts, custom, dedup, joins
from askmill.plans.comments import relate_comments
from askmill.plans.frontier import pending_answers
from askmill.session import drop_work, shared_folder, work_path
from askmill.streaming import dedup_stream, ingest_stream, read_sink, stream_csv
from catalog.registry import spread
from askmill.streaming.ingest import LAYOUT
from catalog import QUERIES

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
SMALL_ID = st.one_of(st.none(), st.integers(0, 4))


@FEW
@given(
    links=st.lists(st.tuples(SMALL_ID, SMALL_ID, st.sampled_from("ab")), max_size=25),
    held=st.lists(st.tuples(SMALL_ID, SMALL_ID), max_size=10),
)
def test_pending_and_held_split_the_valid_links(spark, links, held):
    frame = spark.createDataFrame(
        [(q, a, t, "u") for q, a, t in links],
        "qId long, aid long, question_title string, topic_url string",
    )
    held_frame = spark.createDataFrame(held, "question_id long, answer_id long")
    pending = {(r["qId"], r["aid"]) for r in pending_answers(frame, held_frame).collect()}
    valid = {(q, a) for q, a, _ in links if q is not None and a is not None}
    assert pending == valid - set(held)
    assert pending_answers(frame, held_frame).count() == len(pending)


@FEW
@given(data=st.lists(st.tuples(SMALL_ID, SMALL_ID, SMALL_ID), max_size=30))
def test_keep_first_is_idempotent_and_whole(spark, data):
    frame = spark.createDataFrame(data, "k long, v long, w long").repartition(3)
    once = dedup.keep_first(frame, ["k"], ["v"])
    assert rows(dedup.keep_first(once, ["k"], ["v"])) == rows(once)
    low = {}
    for k, v, w in data:
        rank = tuple((x is not None, x or 0) for x in (v, w))
        if k not in low or rank < low[k][0]:
            low[k] = (rank, (k, v, w))
    assert rows(once) == sorted((row for _, row in low.values()), key=repr)


@FEW
@given(
    sizes=st.lists(st.integers(0, 60), min_size=1, max_size=6), size=st.integers(1, 30)
)
def test_batches_cover_all_rows(spark, sizes, size):
    data = [(p, i) for p, n in enumerate(sizes) for i in range(n)]
    frame = spark.createDataFrame(data, "p long, i long").repartition(4)
    made = batches.batches(frame, ["p", "i"], size).collect()
    assert sorted((r["p"], r["i"]) for r in made) == data
    order = {key: place for place, key in enumerate(data)}
    assert all(r["batch_id"] == order[(r["p"], r["i"])] // size for r in made)


def test_positions_over_several_partitions(spark):
    frame = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k")).repartition(6)
    wrong = batches.with_position(frame, ["k"]).join(
        frame.select("k").withColumn("less", F.lit(0)), "k"
    )
    placed = {r["k"]: r["position"] for r in wrong.collect()}
    assert [placed[k] for k in sorted(placed)] == list(range(20_000))


def test_skip_first_and_shuffle(spark):
    frame = spark.range(100).repartition(5)
    assert rows(batches.skip_first(frame, ["id"], 3)) == rows(spark.range(3, 100))
    mixed = [r["id"] for r in batches.shuffled(frame, ["id"], 1).collect()]
    assert sorted(mixed) == list(range(100)) != mixed
    assert mixed == [r["id"] for r in batches.shuffled(frame.repartition(2), ["id"], 1).collect()]
    assert mixed != [r["id"] for r in batches.shuffled(frame, ["id"], 2).collect()]


def test_buckets_are_dealt_in_turn(spark):
    names = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "position long, name string")
    dealt = batches.assign_buckets(spark.range(10), names, ["id"])
    assert {r["id"]: r["name"] for r in dealt.collect()} == {i: "abc"[i % 3] for i in range(10)}


def test_spread_leaves_a_scan_of_many_partitions(spark):
    many = spark.range(0, 100, 1, 64)
    assert spread(many) is many
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() >= 8


def hot_comments(spark):
    replies = spark.range(3000).select(
        F.lit(7).cast("long").alias("answer_id"),
        (F.col("id") + 100).alias("id"),
        F.when(F.col("id") < 1500, F.lit(1)).otherwise(F.col("id") % 50).cast("long").alias(
            "reply_root_comment_id"
        ),
        F.col("id").alias("reply_comment_id"),
        F.lit("r").alias("content"),
        F.lit("n").alias("author.name"),
    )
    roots = spark.range(60).select(
        F.lit(7).cast("long").alias("answer_id"),
        "id",
        F.lit("c").alias("content"),
        F.lit(1).cast("long").alias("child_comment_count"),
        F.lit("n").alias("author.name"),
    )
    subjects = spark.createDataFrame(
        [(7, "t", "b")], "answer_id long, question_title string, content string"
    )
    return roots, replies, subjects


def test_splitting_hot_roots_changes_no_row(spark):
    plain = relate_comments(*hot_comments(spark))
    split = relate_comments(*hot_comments(spark), split_hot_roots=True)
    assert rows(plain) == rows(split)
    assert plain.count() == 3000


def test_hot_keys_are_few_and_right(spark):
    _, replies, _ = hot_comments(spark)
    found = joins.hot_keys(replies, "reply_root_comment_id", share=0.1)
    assert found == [1]


def test_a_hot_key_is_spread_over_tasks(spark):
    roots, replies, _ = hot_comments(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = roots.select(F.col("id").alias("root"))
        many = replies.select("reply_root_comment_id", "id")
        joined = joins.join_splitting_hot_keys(many, few, "reply_root_comment_id", "root", pieces=16)
        sizes = (
            joined.where("root = 1").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
        )
        assert sum(r["n"] for r in sizes) == replies.where("reply_root_comment_id = 1").count()
        assert max(r["n"] for r in sizes) < 900
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_splitting_gives_the_rows_of_the_plain_join(spark, how):
    many = spark.range(400).select(
        F.when(F.col("id") < 200, F.lit(1)).when(F.col("id") < 210, F.lit(None)).otherwise(F.col("id") % 9).alias("k"),
        "id",
    )
    few = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "f long, v string")
    split = joins.join_splitting_hot_keys(many, few, "k", "f", how, pieces=5)
    assert rows(split) == rows(many.join(few, many["k"] == few["f"], how))


def test_splitting_refuses_joins_that_would_repeat_rows(spark):
    frame = spark.range(3)
    with pytest.raises(ValueError, match="more than once"):
        joins.join_splitting_hot_keys(frame, frame, "id", "id", "right")


def test_adaptive_execution_splits_a_hot_root(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        roots, replies, subjects = hot_comments(spark)
        frame = relate_comments(roots, replies.repartition(8), subjects)
        frame.write.format("noop").mode("overwrite").save()
        assert frame.count() == 3000
        query = frame._jdf.queryExecution()
        frame.collect()
        assert "skew=true" in query.executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pending_shuffles_each_side_once(spark, folder, no_broadcast):
    text = plan(QUERIES["pending_two_sources"](spark, folder))
    assert text.count("Exchange hashpartitioning") == 2
    assert "LeftAnti" in text


def test_deduplication_combines_before_its_one_shuffle(spark, folder):
    for name in ("dedup_keep_first", "consolidate_answers"):
        text = plan(QUERIES[name](spark, folder))
        assert text.count("Exchange") == 1
        assert "partial_min" in text


def test_scans_read_only_the_columns_needed(spark, folder):
    text = plan(QUERIES["distinct_pair_count"](spark, folder))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    text = plan(QUERIES["parquet_columns"](spark, folder))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text


def test_filters_reach_the_scan(spark, folder):
    text = plan(QUERIES["instruction_pairs"](spark, folder))
    assert "EqualTo(role,user)" in text
    assert "EqualTo(role,assistant)" in text


def test_one_root_filters_both_sides(spark, folder):
    text = plan(QUERIES["relate_one_root"](spark, folder))
    assert len(re.findall(r"conv_id#\d+L \* 1000\) = 2000", text)) >= 2


def test_pages_are_parsed_once(spark, folder):
    text = plan(QUERIES["answer_records"](spark, folder))
    assert text.count("Contains(content") == 1
    assert "Filter isnull(reject_reason" in text


STREAMED = {name for name in QUERIES if name.startswith("stream_")}
#: Callers' functions, and the reader that binds CSV files by their headers.
PYTHON = {"apply_value_function", "map_batches_function", "csv_by_name", "csv_rejects", "csv_mixed_headers"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED - PYTHON))
def test_no_cross_join_and_no_python(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert node not in text


def test_work_goes_to_the_folder_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x").startswith(shared_folder(spark))


def test_working_data_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("askmill.session.shared_folder", lambda _: str(tmp_path))
    spark.range(3).write.parquet(work_path(spark, "x"))
    assert list((tmp_path / "work").iterdir())
    drop_work(spark)
    assert not (tmp_path / "work").exists()
    drop_work(spark)


def test_counts(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None)], "g string, v long")
    assert rows(counts.distinct_count_by(frame, ["g"], "v")) == [("a", 2), ("b", 0)]
    assert rows(counts.count_by(frame, "g")) == [("a", 3), ("b", 1)]
    assert rows(counts.stage_metrics({"x": frame, "y": frame.limit(1)})) == [("x", 4), ("y", 1)]


def test_preview_shows_rows_and_names(spark, capsys):
    assert sinks.preview(spark.range(3).withColumnRenamed("id", "answer_id"), 2) == ["answer_id"]
    assert "answer_id" in capsys.readouterr().out


def test_published_manifest(spark, tmp_path):
    manifest = sinks.publish(spark.range(10), str(tmp_path / "out"), files=3)
    assert rows(manifest) == [(0, "id", "bigint", 10)]
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 3


def test_custom_functions(spark):
    frame = spark.createDataFrame([(1, "ab"), (2, None)], "k long, v string")
    assert rows(custom.apply_value(frame, "v", len, "bigint", "n").select("k", "n")) == [(1, 2), (2, None)]
    twice = custom.map_batches(frame, lambda pdf: pdf[["k"]], "k long", partitions=2)
    assert rows(twice) == [(1,), (2,)]


def landed(spark, frame, path):
    sinks.append_csv(frame.repartition(3), path)
    return stream_csv(spark, path, frame.schema, files_per_batch=1)


def test_replay_and_new_files_add_only_what_is_new(spark, tmp_path):
    first = spark.createDataFrame([(i % 7, i % 2) for i in range(40)] + [(None, 1)], "a long, b long")
    landing, sink, metrics = (str(tmp_path / n) for n in ("landing", "sink", "metrics"))
    stream = landed(spark, first, landing)
    for state in ("one", "two"):
        ingest_stream(stream, sink, ["a", "b"], str(tmp_path / state), metrics=metrics).awaitTermination()
        held = read_sink(spark, sink)
        assert Counter(rows(held)) == Counter({(i % 7, i % 2) for i in range(40)})
    more = spark.createDataFrame([(0, 0), (99, 9)], "a long, b long")
    sinks.append_csv(more, landing)
    ingest_stream(stream, sink, ["a", "b"], str(tmp_path / "two"), metrics=metrics).awaitTermination()
    assert read_sink(spark, sink).count() == 15
    log = spark.read.parquet(metrics)
    assert log.agg(F.max("total")).first()[0] == 15


def test_a_batch_cut_off_in_mid_write_is_completed(spark, tmp_path):
    """Rows of the batch that reached the sink before a failure are not added again."""
    frame = spark.createDataFrame([(i, i) for i in range(30)], "a long, b long")
    landing, sink = str(tmp_path / "landing"), str(tmp_path / "sink")
    stream = landed(spark, frame, landing)
    ingest_stream(stream, sink, ["a"], str(tmp_path / "one"), buckets=4).awaitTermination()
    half = str(tmp_path / "half")
    spark.read.parquet(sink).where("a < 12").write.partitionBy(*LAYOUT).parquet(half)
    ingest_stream(stream, half, ["a"], str(tmp_path / "two"), buckets=4).awaitTermination()
    assert rows(read_sink(spark, half)) == rows(frame)


def test_stream_state_dedup(spark, tmp_path):
    frame = spark.createDataFrame([(i % 3,) for i in range(20)], "a long")
    stream = landed(spark, frame, str(tmp_path / "landing"))
    out = str(tmp_path / "out")
    (
        dedup_stream(stream, ["a"])
        .writeStream.option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .format("parquet")
        .start(out)
        .awaitTermination()
    )
    assert rows(spark.read.parquet(out)) == [(0,), (1,), (2,)]


def test_stream_rejects_another_header(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2)], "a long, b long")
    landing = str(tmp_path / "landing")
    landed(spark, frame, landing)
    swapped = stream_csv(spark, landing, frame.select("b", "a").schema)
    query = ingest_stream(swapped, str(tmp_path / "sink"), ["a"], str(tmp_path / "state"))
    with pytest.raises(Exception, match="(?i)header"):
        query.awaitTermination()


def test_members_have_no_bound_unless_one_is_asked_for(spark):
    page = "member string, offset long, data array<struct<id: long>>, paging struct<totals: long>"
    pages = spark.createDataFrame([("m", n, [(n,)], (200_000,)) for n in (0, 100_000, 100_020)], page)
    assert api.api_rows(pages).count() == 3
    assert api.api_rows(pages, 50_000).count() == 1


def test_equal_rows_of_a_hot_key_use_many_pieces(spark):
    many = spark.range(0, 20_000, 1, 40).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    few = spark.createDataFrame([(1, "y")], "f int, w string")
    joined = joins.join_splitting_hot_keys(many, few, "k", "f")
    assert joined.count() == 20_000
    pieces = many.select(joins._stable_piece(many, 64).alias("p")).distinct().count()
    assert pieces > 20


def test_a_task_that_runs_again_deals_its_rows_alike(spark):
    """In another order of its rows, as after a lost executor: each row keeps its piece."""
    many = spark.range(0, 5_000, 1, 4).select((F.col("id") % 900).alias("k"), F.lit("x").alias("v"))

    def dealt(frame):
        return rows(frame.select("k", "v", joins._stable_piece(frame, 16).alias("p")))

    assert dealt(many.sortWithinPartitions("k")) == dealt(many.sortWithinPartitions(F.col("k").desc()))
    plan = joins.join_splitting_hot_keys(many, many.selectExpr("k AS f", "v AS w"), "k", "f", share=0.001)
    assert "rand(" not in plan._jdf.queryExecution().optimizedPlan().toString()
