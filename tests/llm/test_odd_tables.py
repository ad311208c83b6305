"""Every document operator on empty tables, on very long texts, and between columns named like its own."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from askmill.llm import (
    compact_windows,
    edit_pigeonhole,
    fill_middle,
    jump_shards,
    license_scan,
    piece_codec,
    quality_trees,
    queries,
    super_minhash,
    syncmers,
    token_files,
    toxicity,
)
from askmill.session import work_path

#: Names the operators use for columns of their own.
NAMES = """key tie part place around a b score kept features hash node bucket band size law shard slot tokens labels n_words n_long
base start stop n_tokens ids component_id n_shingles fingerprint anchors words item_id distance signature text_hash _spans
chunk form back copies digest member code docs held_out predicted decoded parity rank id label""".split()


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 1), (5, 0, 0)], "doc_id long, quality int, toxic int")


def bench(spark):
    return spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again and again")], "item_id long, text string")


OPERATORS = {
    "op1": lambda spark, docs: toxicity.with_score(
        docs.select("doc_id", "text"), toxicity.train(docs, labels(spark))
    ).select("doc_id", "score"),
    "op2": lambda spark, docs: license_scan.scan(docs),
    "op3": lambda spark, docs: token_files.read(
        token_files.write(docs, work_path(spark, "odd"), queries.tokenizer_file("word_bpe_49k.json"), 2)
    ),
    "op4": lambda spark, docs: jump_shards.number_slots(
        jump_shards.shard(docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n")), 7), ["doc_id", "n"]
    ),
    "op5": lambda spark, docs: super_minhash.group(docs, 85),
    "op6": lambda spark, docs: syncmers.compare_edits(docs),
    "op7": lambda spark, docs: compact_windows.without_passages(docs, compact_windows.repeated(docs)).select("doc_id", "text"),
    "op8": lambda spark, docs: piece_codec.encode(docs, queries.tokenizer_file("piece_bpe_32k.model")),
    "op10": lambda spark, docs: edit_pigeonhole.matches(docs, bench(spark)),
    "op11": lambda spark, docs: quality_trees.judge(docs, quality_trees.train(docs, labels(spark))),
    "op13": lambda spark, docs: fill_middle.digests(docs),
}


def documents(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(20_000))
    rows = [(n, " ".join(f"w{rng.randrange(300)}" for _ in range(40))) for n in range(1, 9)]
    rows += [(10, long), (11, "x" * 150_000), (12, "the quick brown fox jumps over the lazy dog again and again"), (13, None), (14, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def found(frame):
    return sorted((str(tuple(row)) for row in frame.collect()))


@pytest.mark.parametrize("name", list(OPERATORS))
def test_names_may_clash_and_texts_be_long(spark, name):
    docs = documents(spark)
    wide = docs.withColumns({n: F.lit(f"own {n}") for n in NAMES})
    plain, clashing = (found(OPERATORS[name](spark, frame)) for frame in (docs, wide))
    assert plain == clashing
    if name != "op10":
        assert len(plain) == docs.count()
    else:
        assert len(plain) == 1


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_tables_give_no_rows(spark, name):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert OPERATORS[name](spark, empty).count() == 0
