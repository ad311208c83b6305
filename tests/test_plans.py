"""Plans and jobs: what is moved, what is pushed down, what a write costs, how hot keys are split."""

from __future__ import annotations

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from askmill import sinks, sources
from askmill.operators import batches, counts, custom, dedup, joins
from askmill.operators.dedup import last_value
from askmill.plans import answers, instructions, links
from askmill.schemas import API_PAGE
from askmill.sources.api import kept_pages
from catalog.answers import _viewed, order_answer_pages, question_pages, topic_pages
from catalog.registry import SITE, new_database


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def splitting(spark):
    """Adaptive splitting at sizes a test can reach."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark):
    """A third of the rows on one key, as files of many partitions."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).cast("long")
    return spark.range(0, 60_000, 1, 24).select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("t"))


def largest_share(frame, condition):
    """The part of a condition's rows that the task with most of them holds."""
    # All columns take part, or the optimizer would leave out what is to be measured.
    whole = frame.where(condition).select(F.spark_partition_id().alias("p"), F.xxhash64(*frame.columns).alias("h"))
    placed = whole.groupBy("p").agg(F.count("*").alias("n"), F.max("h"))
    sizes = [r["n"] for r in placed.collect()]
    return max(sizes) / sum(sizes)


def test_a_hot_key_is_split_beside_an_aggregate(spark, splitting):
    frame = hot(spark)
    values = last_value(frame, ["k"], F.col("v"), F.col("v"), "last")
    joined = joins.lookup(frame, values, ["k"])
    assert largest_share(joined, "k = 7 AND last IS NOT NULL") < 0.5
    best = {k: max(v for x, v in ((r["k"], r["v"]) for r in frame.select("k", "v").collect()) if x == k) for k in (7, 8)}
    got = {r["k"]: r["last"] for r in joined.where("k IN (7, 8)").select("k", "last").distinct().collect()}
    assert got == best and joined.count() == 60_000


def test_a_hot_member_is_split(spark, splitting):
    page = F.struct(F.lit(10**9).cast("long").alias("totals")).alias("paging")
    item = API_PAGE["data"].dataType.elementType
    data = F.from_json(F.lit('[{"url": "u"}]'), "array<" + item.simpleString() + ">").alias("data")
    pages = hot(spark).select(F.col("k").cast("string").alias("member"), F.col("v").alias("offset"), page, data, "t")
    kept = kept_pages(pages, max_count=59_000)
    assert largest_share(kept, "member = '7'") < 0.5
    assert kept.count() == 59_001


def test_a_member_with_all_pages_is_spread_whatever_the_settings(spark):
    page = F.struct(F.lit(50_000).cast("long").alias("totals")).alias("paging")
    item = API_PAGE["data"].dataType.elementType
    data = F.from_json(F.lit('[{"url": "u"}]'), "array<" + item.simpleString() + ">").alias("data")
    for member in (F.lit("m1"), F.lit(None).cast("string")):
        pages = hot(spark).select(member.alias("member"), F.col("v").alias("offset"), page, data, "t")
        before = {c: spark.conf.get(c, None) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert largest_share(kept_pages(pages), "true") < 0.5
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    some = hot(spark).select(F.lit("m1").alias("member"), F.col("v").alias("offset"), page, data)
    assert kept_pages(some).count() == 50_000


def test_a_hot_user_is_split_by_the_elapsed_filter(spark, splitting):
    frame = hot(spark)
    first = frame.groupBy("k").agg(F.min("v").alias("started"))
    late = joins.join_aggregate(frame, first, ["k"]).where("v > started + 100")
    assert largest_share(late, "k = 7") < 0.5


def test_hot_members_texts_are_split(spark, splitting):
    frame = hot(spark).withColumnsRenamed({"k": "question_id", "v": "answer_id"})
    values = frame.groupBy("question_id").agg(F.max_by("t", "answer_id").alias("text"))
    assert largest_share(joins.lookup(frame, values, ["question_id"]), "question_id = 7 AND text IS NOT NULL") < 0.5
    # The plain join takes over the aggregate's partitioning, and the key stays in one task.
    assert largest_share(frame.join(values, "question_id", "left"), "question_id = 7 AND text IS NOT NULL") == 1.0


def test_joins_to_aggregates_keep_nulls_and_misses(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "k long, v string")
    values = spark.createDataFrame([(1, "x"), (None, "n")], "k long, w string")
    assert rows(joins.lookup(frame, values, ["k"])) == sorted(
        [(1, "a", "x"), (2, "b", None), (None, "c", None), (1, "d", "x")], key=repr
    )
    assert rows(joins.join_aggregate(frame, values, ["k"])) == [(1, "a", "x"), (1, "d", "x")]
    assert rows(joins.join_aggregate(frame, values, ["k"], "left_anti")) == sorted([(2, "b"), (None, "c")], key=repr)


# landed pages

def test_no_exchange_carries_landed_pages(spark, folder):
    database = new_database(spark)
    pages = question_pages(spark, folder).select(F.regexp_extract("url", r"/question/(\d+)", 1).cast("long").alias("question_id"), "url", "html")
    sources.land_pages(pages, f"{database}.questions", ["question_id"], 8, pieces=3)
    sources.land_pages(order_answer_pages(spark, folder), f"{database}.answers", ["question_id", "answer_id"], 8)
    questions, held = (sources.landed_pages(spark, f"{database}.{name}") for name in ("questions", "answers"))
    assert (questions.keys, questions.buckets, questions.pieces) == (("question_id",), 8, 3)
    assert (held.keys, held.pieces) == (("question_id", "answer_id"), 8)
    viewed = _viewed(spark, folder)
    for frame in (
        links.extract_links(topic_pages(spark, folder), questions, viewed)[0],
        answers.topics_to_answers(topic_pages(spark, folder), questions, held, SITE, viewed),
    ):
        tree = frame._jdf.queryExecution().executedPlan().toString()
        lines = tree.split("\n")
        # The page scans, and the nodes above each of them up to the join that takes it.
        for at, line in enumerate(lines):
            if "Scan parquet" not in line or "html" not in line.split("ReadSchema")[-1]:
                continue
            depth, above = len(line) - len(line.lstrip(" :+-")), at - 1
            while "Join" not in lines[above]:
                here = len(lines[above]) - len(lines[above].lstrip(" :+-"))
                if here < depth:
                    assert "Exchange" not in lines[above], lines[above]
                    depth = here
                above -= 1
    plain = links.extract_links(topic_pages(spark, folder), question_pages(spark, folder), viewed)[0]
    landed = links.extract_links(topic_pages(spark, folder), questions, viewed)[0]
    assert rows(plain) == rows(landed)


def test_pages_land_twice_and_a_hot_question_is_spread(spark):
    name = f"{new_database(spark)}.pages"
    first = spark.range(400).select(F.lit(5).cast("long").alias("question_id"), F.col("id").cast("string").alias("html"))
    more = spark.createDataFrame([(6, "x"), (None, "y")], "question_id long, html string")
    for frame in (first, more):
        sources.land_pages(frame, name, ["question_id"], 16, pieces=8)
    landed = sources.landed_pages(spark, name)
    wanted = spark.createDataFrame([(5, "a"), (6, "b"), (7, "c")], "question_id long, topic string")
    met = landed.meet(wanted)
    assert met.columns == ["question_id", "topic", "html"]
    assert rows(met.groupBy("topic").agg(F.count("*").alias("n"))) == [("a", 400), ("b", 1)]
    assert largest_share(met, "question_id = 5") < 0.5


# what is pushed down

def test_filters_on_kept_columns_reach_the_scan(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    assert "GreaterThan(page_id,10)" in plan(links.page_links(pages, "page_id", "url").where("page_id > 10"))
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    measured = custom.apply_value(documents, "text", len, "bigint", "n")
    assert "GreaterThan(doc_id,10)" in plan(measured.where("doc_id > 10"))
    twice = plan(measured.where("n > 10"))
    assert len(re.findall(r"ArrowEvalPython", twice)) == 1


# what a write costs

def jobs_of(spark, action):
    group = f"group-{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_appends_are_one_job_and_count_their_rows(spark, tmp_path):
    frame = spark.range(0, 100, 1, 4).selectExpr("id AS a", "id AS b")
    path, name = str(tmp_path / "csv"), f"{new_database(spark)}.rows"
    assert jobs_of(spark, lambda: sinks.append_csv(frame, path)) == (100, 1)
    assert sinks.append_to_table(frame, name) == 100
    assert jobs_of(spark, lambda: sinks.append_to_table(frame.select("b", "a"), name)) == (100, 1)
    assert spark.table(name).count() == 200


def test_empty_appends_leave_no_file(spark, tmp_path):
    frame = spark.range(0, 3, 1, 1).selectExpr("id AS a")
    path, name = tmp_path / "csv", f"{new_database(spark)}.rows"
    sinks.append_csv(frame, str(path))
    before = sorted(p.name for p in path.glob("part-*"))
    assert sinks.append_csv(frame.where("a < 0"), str(path)) == 0
    assert sorted(p.name for p in path.glob("part-*")) == before
    sinks.append_to_table(frame, name)
    held = set(spark.table(name).inputFiles())
    assert sinks.append_to_table(frame.where("a < 0"), name) == 0
    spark.catalog.refreshTable(name)
    assert set(spark.table(name).inputFiles()) == held
    with pytest.raises(ValueError, match="columns"):
        sinks.append_to_table(frame.withColumnRenamed("a", "c"), name)


def test_observed_counts_cost_no_job(spark, tmp_path):
    frame, seen = counts.observed(spark.range(10))
    frame.write.parquet(str(tmp_path / "out"))
    metrics, jobs = jobs_of(spark, lambda: counts.observed_metrics(spark, {"ids": seen}))
    assert rows(metrics) == [("ids", 10)] and jobs == 0


def test_column_list(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "`a.b` long, c string")
    assert rows(sinks.column_list(frame)) == [(0, "a.b", "bigint", 2, 0), (1, "c", "string", 2, 1)]
    assert rows(sinks.column_list(frame.where("c = 'no'"))) == [(0, "a.b", "bigint", 0, 0), (1, "c", "string", 0, 0)]


# selection

@pytest.mark.parametrize("skipped", [0, 1, 7, 20, 50, 199, 200, 300])
@pytest.mark.parametrize("order", [["a", "b"], ["t", "b"], ["b"]])
def test_skipping_equals_sorting(spark, order, skipped):
    data = [(None if n % 10 == 0 else n % 6, n, None if n % 9 == 0 else str(n % 4)) for n in range(200)]
    frame = spark.createDataFrame(data, "a long, b long, t string").repartition(5)
    place = {"a": 0, "b": 1, "t": 2}
    want = sorted(data, key=lambda r: [(r[place[c]] is not None, r[place[c]] or 0 if c != "t" else r[place[c]] or "") for c in order])
    assert rows(batches.skip_first(frame, order, skipped)) == sorted(want[skipped:], key=repr)


def test_skipping_half_of_a_table_numbers_few_rows(spark, monkeypatch):
    seen = []
    real = batches.with_position
    monkeypatch.setattr(batches, "with_position", lambda frame, *rest: seen.append(frame.count()) or real(frame, *rest))
    frame = spark.range(0, 400_000, 1, 8).withColumn("id", F.xxhash64("id"))
    assert batches.skip_first(frame, ["id"], 200_000).count() == 200_000
    assert seen and seen[0] < 2_000


# a member's texts

def test_repeated_texts_add_no_rows_and_misses_are_listed(spark):
    item = API_PAGE["data"].dataType.elementType
    schema = StructType([StructField("member", API_PAGE["data"].dataType.elementType["url"].dataType)])
    payload = '[{"url": "https://x/answers/1", "question": {"id": 5, "title": "q"}}, {"url": "https://x/answers/2", "question": {"id": 5, "title": "q"}}]'
    pages = spark.createDataFrame([("m",)], schema).select(
        "member",
        F.lit(0).cast("long").alias("offset"),
        F.struct(F.lit(9).cast("long").alias("totals")).alias("paging"),
        F.from_json(F.lit(payload), "array<" + item.simpleString() + ">").alias("data"),
    )
    texts = spark.createDataFrame(
        [(5, 1, "old", 1), (5, 1, "new", 2), (5, 1, "new", 2), (6, 2, "x", 1)],
        "question_id long, answer_id long, content string, fetched int",
    )
    found = instructions.member_answers_to_instructions(pages, texts, "s", written="fetched")
    assert rows(found.select("RESPONSE")) == sorted([("new",), (None,)], key=repr)
    assert rows(instructions.member_answer_misses(pages, texts)) == [(5, "2")]


# first rows by address

def test_first_rows_of_files_are_fetched_unsorted(spark, tmp_path):
    data = [(n % 50 if n % 11 else None, n // 100, n, "x" * n) for n in range(400)]
    frame = spark.createDataFrame(data, "k long, o long, n long, t string")
    frame = frame.withColumn("m", F.create_map(F.lit("a"), F.col("n")))
    frame.repartition(6).write.parquet(str(tmp_path / "in"))
    scan = spark.read.parquet(str(tmp_path / "in"))
    found = dedup.keep_first_of_files(scan, ["k"], ["o"])
    assert found.columns == scan.columns
    text = plan(found)
    assert "SortMergeJoin" not in text and "LeftSemi" in text
    assert not [line for line in text.split("\n") if "Sort" in line and re.search(r"\b[tm]#", line)]
    kept = [tuple(r)[:4] for r in found.collect()]
    assert len(kept) == 51 and set(kept) <= set(data)
    best = {}
    for k, o, *_ in data:
        best[k] = min(best.get(k, o), o)
    assert {k: o for k, o, *_ in kept} == best
    again = dedup.keep_first_of_files(scan, ["k"], ["o"])
    assert sorted(tuple(r)[:4] for r in again.where("k IS NOT NULL").collect()) == sorted(x for x in kept if x[0] is not None)
    total = dedup.keep_first_of_files(scan.drop("m"), ["k"], ["o", "n"])
    assert rows(total) == rows(dedup.keep_first(scan.drop("m"), ["k"], ["o", "n"]))
