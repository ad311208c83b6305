"""Small hand-written tables for every edge case of the semantics."""

from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from askmill import schemas, sinks, sources
from askmill.functions import clock, jsontext, text, urls
from askmill.operators import counts, dedup, filters, joins
from askmill.plans.comments import OUTPUT_COLUMNS, relate_comments
from askmill.plans.frontier import pending_answers
from askmill.plans.instructions import to_instructions


def answers(spark, contents):
    data = [(1, i, None, "q", content, "5", "") for i, content in enumerate(contents)]
    return spark.createDataFrame(
        data,
        "question_id long, answer_id long, author_id string, question_title string, "
        "content string, upvotes string, answer_creation_time string",
    )


def test_blank_filter_drops_one_space_only(spark):
    frame = to_instructions(answers(spark, [" ", "", None, "x"]), "s")
    assert {r["RESPONSE"] for r in frame.collect()} == {"", None, "x"}


def test_blank_filter_can_drop_nulls(spark):
    frame = to_instructions(answers(spark, [" ", "", None, "x"]), "s", drop_null=True)
    assert {r["RESPONSE"] for r in frame.collect()} == {"", "x"}


def test_metadata_keeps_nulls_order_and_wide_text(spark):
    row = to_instructions(answers(spark, ["x"]), "源").first()
    assert row["METADATA"] == (
        '{"question_id":1,"answer_id":0,"author_id":null,"upvotes":"5","answer_creation_time":""}'
    )
    assert row["SOURCE"] == "源"


def test_spaced_metadata_is_what_python_writes(spark):
    record = {"n": 3, "text": '引"\n\\', "none": None}
    frame = spark.createDataFrame([(3, record["text"], None)], "n long, text string, none string")
    written = frame.select(
        jsontext.json_object({c: F.col(c) for c in frame.columns}, spaced=True).alias("j")
    ).first()["j"]
    assert written == json.dumps(record, ensure_ascii=False)


def test_nan_is_written_as_null(spark):
    frame = spark.createDataFrame([(float("nan"), 1.5)], "a double, b double")
    types = {f.name: f.dataType for f in frame.schema.fields}
    made = jsontext.json_object({"a": F.col("a"), "b": F.col("b")}, types)
    assert frame.select(made.alias("j")).first()["j"] == '{"a":null,"b":1.5}'


def test_pair_count_counts_nulls(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 2), (1, None), (None, None), (12, 3)], "a long, b long")
    assert counts.distinct_tuple_count(pairs, ["a", "b"]).first()["n"] == 4


LINKS = "qId long, aid long, question_title string, topic_url string"
HELD = "question_id long, answer_id long"


def test_keys_that_compose_alike_stay_apart(spark):
    links = spark.createDataFrame([(1, 23, "t", "u")], LINKS)
    held = spark.createDataFrame([(12, 3)], HELD)
    (row,) = pending_answers(links, held).collect()
    assert (row["qId"], row["aid"], row["qaId"]) == (1, 23, "123")


def test_held_nulls_remove_nothing(spark):
    links = spark.createDataFrame([(1, 2, "t", "u")], LINKS)
    held = spark.createDataFrame([(None, None), (1, None)], HELD)
    assert pending_answers(links, held).count() == 1


def test_pending_drops_blank_ids_and_repeats(spark):
    links = spark.createDataFrame(
        [(1, 2, "b", "u"), (1, 2, "a", "u"), (None, 2, "c", "u"), (3, 4, "d", "u")], LINKS
    )
    held = spark.createDataFrame([(3, 4), (3, 4)], HELD)
    assert rows(pending_answers(links, held)) == [(1, 2, "a", "u", "12")]


def test_first_row_is_the_same_for_any_partitioning(spark):
    data = [(1, c, i) for i, c in enumerate("cab")] + [(2, None, 9), (2, "z", 1)]
    frame = spark.createDataFrame(data, "k long, v string, n long")
    for parts in (1, 3, 5):
        assert rows(dedup.keep_first(frame.repartition(parts), ["k"], ["v"])) == [
            (1, "a", 1),
            (2, None, 9),
        ]


def test_keep_first_without_other_columns(spark):
    frame = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    assert rows(dedup.keep_first(frame, ["k"])) == [(1,), (None,)]


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("https://h/question/438/answer/179?write", "438"),
        ("https://h/question/438/answer/179", "438"),
    ],
)
def test_question_id_at_the_question_stage(spark, url, expected):
    frame = spark.createDataFrame([(url,)], "u string")
    assert frame.select(urls.question_id_text(F.col("u"))).first()[0] == expected


@pytest.mark.parametrize(
    ("url", "question", "answer"),
    [
        ("https://h/question/438/answer/179", 438, 179),
        ("https://h/question/438/answer/179#!", 438, 179),
        ("https://h/question/438/answer/17?x", 438, None),
        ("https://h/question/438/answer/1.5", 438, None),
        ("short", None, None),
    ],
)
def test_link_ids(spark, url, question, answer):
    frame = spark.createDataFrame([(url,)], "u string")
    row = frame.select(urls.link_question_id(F.col("u")), urls.link_answer_id(F.col("u"))).first()
    assert tuple(row) == (question, answer)


def test_id_containment_is_by_text(spark):
    frame = spark.createDataFrame([("https://h/question/123/answer/5", 12)], "u string, q long")
    assert frame.select(urls.contains_id(F.col("u"), F.col("q"))).first()[0]


def test_blocklist_looks_past_the_first_ten_characters(spark):
    frame = spark.createDataFrame(
        [("png://host/page",), ("https://h/A.PNG",), ("0123456789gif",), ("012345678gif",)], "u string"
    )
    flags = [r[0] for r in frame.select(urls.is_blocked(F.col("u"))).collect()]
    assert flags == [False, True, True, False]


def test_elapsed_is_strict(spark):
    frame = spark.createDataFrame([(0, 1200), (0, 1201)], "a long, b long")
    late = clock.elapsed_more_than(clock.from_epoch(F.col("a")), clock.from_epoch(F.col("b")))
    assert [r[0] for r in frame.select(late).collect()] == [False, True]


@pytest.mark.parametrize("edge", ["　", " ", "\n", "\t", " ", "\x0b", "\x1c", "\x85"])
def test_strip_takes_all_white_space(spark, edge):
    value = f"{edge} a{edge}b {edge}"
    frame = spark.createDataFrame([(value,)], "v string")
    assert frame.select(text.strip_text(F.col("v"))).first()[0] == value.strip()


def test_white_space_list_is_pythons():
    import sys

    known = {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}
    assert set(text.WHITE_SPACE) == known


@pytest.mark.parametrize(
    "value",
    [
        "&amp;lt; &lt;b&gt; &copy;&#233;",
        "&hellip; &#8220;&#x4e2d;&#X1F600; &nbsp;x",
        "&#150; &#128;&#0;&#55555;&#99999999;&#99999999999999999999;&#x110000;&#1;|",
        "&nosuch; & &; &# &#; AT&T &copy 1 &AMP",
        "&ngE; &acE;",
        "",
    ],
)
def test_entities_are_decoded_once(spark, value):
    import html

    frame = spark.createDataFrame([(value,), (None,)], "v string")
    read = frame.select(text.decode_entities(F.col("v"))).collect()
    assert [r[0] for r in read] == [html.unescape(value), None]


def test_bare_names_stay_in_attributes(spark):
    frame = spark.createDataFrame([("?a=1&copy=2&amp;b",)], "v string")
    assert frame.select(text.decode_entities(F.col("v"), False)).first()[0] == "?a=1&copy=2&b"


@pytest.mark.parametrize(
    ("href", "expected"),
    [
        ("/a", "https://h.x/a"),
        ("//o.y/a", "https://o.y/a"),
        ("http://o.y/a", "http://o.y/a"),
        ("mailto:a@b", "mailto:a@b"),
        ("#f", "https://h.x/d/p?q=1#f"),
        ("?z", "https://h.x/d/p?z"),
        ("", "https://h.x/d/p?q=1"),
        ("s", "https://h.x/d/s"),
        ("../s", "https://h.x/s"),
        ("./s/../t/", "https://h.x/d/t/"),
        ("../../../s", "https://h.x/s"),
        ("/a/b/..", "https://h.x/a/"),
    ],
)
def test_links_are_resolved_as_a_browser_does(spark, href, expected):
    frame = spark.createDataFrame([(href, "https://h.x/d/p?q=1#e")], "h string, p string")
    assert frame.select(urls.resolve_url(F.col("h"), F.col("p"))).first()[0] == expected


def test_resolving_against_a_bare_host(spark):
    frame = spark.createDataFrame([("s", "https://h.x"), ("/s", "https://h.x")], "h string, p string")
    made = [r[0] for r in frame.select(urls.resolve_url(F.col("h"), F.col("p"))).collect()]
    assert made == ["https://h.x/s", "https://h.x/s"]


def test_reject_reasons_come_in_order(spark):
    frame = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (None, 0)], "a int, b int")
    judged = filters.with_reject_reason(frame, {"a": F.col("a") == 1, "b": F.col("b") == 1})
    assert [r["reject_reason"] for r in judged.collect()] == ["a", "b", None, None]


def test_only_overlapping_names_are_suffixed(spark):
    left = spark.createDataFrame([(1, "x", 5)], "id long, content string, child long")
    right = spark.createDataFrame([(9, 1, "y")], "id long, root long, content string")
    joined = joins.join_on_different_keys(left, right, "id", "root", ("_l", "_r"))
    assert joined.columns == ["id_l", "content_l", "child", "id_r", "root", "content_r"]
    assert rows(joined) == [(1, "x", 5, 9, 1, "y")]


def test_null_keys_meet_only_when_asked(spark):
    left = spark.createDataFrame([(None, 1), (2, 2)], "k long, a long")
    right = spark.createDataFrame([(None, 3), (2, 4)], "k long, b long")
    assert rows(joins.join_on_shared_key(left, right, "k")) == [(2, 2, 4)]
    assert len(rows(joins.join_on_shared_key(left, right, "k", null_safe=True))) == 2


def test_related_comments_columns(spark):
    roots = spark.createDataFrame([(7, 1, "root", 2, "ann")], schemas.ROOT_COMMENTS)
    replies = spark.createDataFrame(
        [(7, 11, 1, 1, "reply", "bob"), (7, 12, 5, 5, "other", "eve")], schemas.COMMENT_TREE
    )
    subjects = spark.createDataFrame(
        [(7, "title", "body")], "answer_id long, question_title string, content string"
    )
    for frame in (
        relate_comments(roots, replies, subjects),
        relate_comments(roots, replies, subjects, root_id=1),
        relate_comments(roots, replies, subjects, split_hot_roots=True),
    ):
        assert tuple(frame.columns) == OUTPUT_COLUMNS
        assert rows(frame) == [
            (7, "title", "body", 1, "root", "ann", 11, 1, 1, "bob", "reply")
        ]


def write_file(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(lines, encoding="utf-8")


def test_csv_binds_by_name_and_sets_rows_aside(spark, tmp_path):
    landing = tmp_path / "links"
    write_file(landing, "a.csv", 'qId,aid,question_title,topic_url\n1,2,"t, ""x""",u\nzz,4,t,u\n')
    write_file(landing, "b.csv", "aid,qId,topic_url,question_title\n20,10,u,\"two\nlines\"\n")
    write_file(landing, "c.csv", ",qId,aid,question_title,topic_url\n0,100.0,200,t,u\n1,,5,t,u\n")
    write_file(landing, "d.csv", "")
    write_file(landing, "e.txt", "qId,aid\n9,9\n")
    frame = sources.read_csv_files(spark, str(landing), schemas.LINKS, ["qId", "aid"])
    good, bad = sources.split_rejects(frame)
    assert rows(good) == sorted(
        [
            (1, 2, 't, "x"', "u"),
            (10, 20, "two\nlines", "u"),
            (100, 200, "t", "u"),
            (None, 5, "t", "u"),
        ],
        key=repr,
    )
    assert [r["_rejected_line"] for r in bad.collect()] == ["zz,4,t,u"]
    assert bad.select("_rejected_line").count() == 1
    unread = [r["file"] for r in sources.unread_files(frame).collect()]
    assert [u.rsplit("/", 1)[1] for u in unread] == ["d.csv"]


def test_csv_with_a_known_layout(spark, tmp_path):
    landing = tmp_path / "links"
    write_file(landing, "a.csv", "aid,qId\n2,1\n")
    frame = sources.read_csv_files(spark, str(landing), schemas.LINKS, layout=["aid", "qId"])
    assert rows(sources.split_rejects(frame)[0]) == [(1, 2, None, None)]


def test_csv_header_mismatch_is_an_error(spark, tmp_path):
    landing = tmp_path / "links"
    write_file(landing, "a.csv", "aid,qId,question_title,topic_url\n2,1,a,b\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv(spark, str(landing), schemas.LINKS).collect()


def test_csv_keeps_a_space_and_reads_empty_as_null(spark, tmp_path):
    frame = spark.createDataFrame([(" ",), ("NA",), (None,), (" x ",)], "v string").withColumn("n", F.lit(1))
    path = str(tmp_path / "out")
    sinks.write_csv(frame, path)
    again = sources.read_csv(spark, path, frame.schema)
    assert {r["v"] for r in again.collect()} == {" ", "NA", None, " x "}


def test_row_groups_are_bounded(spark, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "groups"
    sinks.write_parquet(spark.range(1000).coalesce(1), str(path), rows_per_group=100)
    (file,) = path.glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [100] * 10


def test_second_create_keeps_the_table_and_refresh_replaces_it(spark):
    name = "create_twice"
    try:
        assert sinks.create_table_as(spark.range(3), name)
        assert not sinks.create_table_as(spark.range(5), name)
        assert spark.table(name).count() == 3
        assert sinks.create_table_as(spark.range(5), name, refresh=True)
        assert spark.table(name).count() == 5
    finally:
        sinks.drop_table(spark, name)


def test_append_goes_by_name(spark):
    name = "append_by_name"
    try:
        sinks.append_to_table(spark.createDataFrame([(1, 2)], "a long, b long"), name)
        sinks.append_to_table(spark.createDataFrame([(4, 3)], "b long, a long"), name)
        sinks.append_to_table(spark.createDataFrame([], "b long, a long"), name)
        assert rows(spark.table(name)) == [(1, 2), (3, 4)]
    finally:
        sinks.drop_table(spark, name)


def test_map_file(spark, tmp_path):
    (tmp_path / "map.json").write_text('{\n "a:1": 3,\n "b:2": 1\n}', encoding="utf-8")
    assert rows(sources.read_map_file(spark, str(tmp_path / "map.json"))) == [("a:1", 3), ("b:2", 1)]


def test_base_topics(spark):
    frame = sources.base_topics(spark)
    assert frame.count() == 32
    assert frame.where("position = 0").first()["topic"] == "生活方式"


def api_page(member, offset, totals, n):
    item = {
        "author": {"name": "a", "id": "i", "url_token": "t"},
        "voteup_count": 1,
        "created_time": 2,
        "updated_time": 3,
        "url": f"https://h/answers/{offset}",
        "question": {"id": 5, "title": "q"},
    }
    paging = None if totals is None else {"totals": totals}
    return {"member": member, "offset": offset, "paging": paging, "data": [item] * n}


def kept_offsets(spark, tmp_path, pages, max_count):
    path = tmp_path / "pages.json"
    path.write_text("\n".join(json.dumps(p) for p in pages), encoding="utf-8")
    frame = sources.api_rows(sources.read_api_pages(spark, str(path)), max_count)
    return sorted({(r["member"], r["offset"]) for r in frame.collect()})


def test_paging_stops(spark, tmp_path):
    pages = [api_page("m", o, 45, 20 if o < 40 else 5) for o in (0, 20, 40)]
    pages.append(api_page("m", 60, 45, 0))
    assert kept_offsets(spark, tmp_path, pages, 10**6) == [("m", 0), ("m", 20), ("m", 40)]


def test_paging_bound_is_strict_and_on_the_offset(spark, tmp_path):
    pages = [api_page("m", o, 45, 5) for o in (0, 20, 40)]
    assert kept_offsets(spark, tmp_path, pages, 20) == [("m", 0), ("m", 20)]


def test_an_empty_page_ends_the_member_and_no_other(spark, tmp_path):
    pages = [api_page("m", 0, 90, 1), api_page("m", 20, 90, 0), api_page("m", 40, 90, 1)]
    pages += [api_page("n", o, 90, 1) for o in (0, 20, 40)]
    assert kept_offsets(spark, tmp_path, pages, 10**6) == [("m", 0), ("n", 0), ("n", 20), ("n", 40)]


def test_missing_paging_voids_the_member_only_if_reached(spark, tmp_path):
    pages = [api_page("m", 0, 90, 1), api_page("m", 20, None, 1)]
    pages += [api_page("n", 0, 90, 1), api_page("n", 20, 90, 0), api_page("n", 40, None, 1)]
    assert kept_offsets(spark, tmp_path, pages, 10**6) == [("n", 0)]


def test_structs_flatten_to_dotted_names(spark):
    frame = spark.createDataFrame([((1, ("x",)), 2)], "a struct<b:long,c:struct<d:string>>, e long")
    flat = sources.flatten_structs(frame)
    assert flat.columns == ["a.b", "a.c.d", "e"]
    assert rows(flat) == [(1, "x", 2)]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([(2,)], "k long")
    assert rows(joins.union_by_name(a, b)) == [(1, "x"), (2, None)]


def test_csv_rows_of_wrong_length_are_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text("qId,aid\n1,2\n3\n4,5,6\n7,\n")
    frame = sources.read_csv_files(spark, str(tmp_path), schemas.LINKS, ["qId", "aid"])
    good, bad = sources.split_rejects(frame)
    assert rows(good.select("qId", "aid")) == [(1, 2), (7, None)]
    assert sorted(r[0] for r in bad.collect()) == ["3", "4,5,6"]


def test_stream_rows_that_do_not_fit_go_to_quarantine(spark, tmp_path):
    from pyspark.sql.types import StructType

    from askmill.streaming import ingest_stream, stream_csv

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,n\n1,2\nzz,4\n5\n,6\n")
    stream = stream_csv(spark, str(tmp_path / "in"), StructType().add("id", "long").add("n", "long"), keep_corrupt=True)
    ingest_stream(stream, str(tmp_path / "sink"), ["id"], str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "sink")).select("id", "n")) == [(1, 2)]
    aside = spark.read.parquet(str(tmp_path / "sink-quarantine")).select("reason", "row")
    assert rows(aside) == [("corrupt", "5"), ("corrupt", "zz,4"), ("null key", '{"id":null,"n":6}')]
