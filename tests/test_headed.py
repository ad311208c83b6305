"""CSV bound by its own headers, in batches and in a stream."""

from __future__ import annotations

import csv
import gzip
import io

import pytest
from conftest import rows
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructType

from askmill import schemas, sources
from askmill.sources import headed
from askmill.sources.headed import FILE_COLUMN, REASON_COLUMN, REJECT_COLUMN
from askmill.streaming import ingest_stream, read_sink

HEAD = "qId,aid,question_title,topic_url\n"


def read(spark, folder, required=("qId", "aid"), schema=schemas.LINKS):
    return sources.read_headed(spark, str(folder), schema, list(required))


def found(frame):
    return rows(frame.select(F.coalesce(REASON_COLUMN, F.lit("good")), REJECT_COLUMN, "qId", "aid"))


def test_files_and_rows_that_do_not_fit_have_a_reason(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + "1,2,t,u\n3,4,t\n5,6,t,u,x\nzz,7,t,u\n,8,t,u\n")
    (tmp_path / "b.csv").write_text("name,url\nx,y\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("aid,qId\n")
    (tmp_path / "_hidden.csv").write_text(HEAD + "9,9,t,u\n")
    packed = gzip.compress((HEAD + "11,12,t,u\n").encode() * 1)
    (tmp_path / "e.csv.gz").write_bytes(packed)
    (tmp_path / "f.csv.gz").write_bytes(packed[: len(packed) - 12])
    frame = sources.read_headed(spark, str(tmp_path), schemas.LINKS, ["qId", "aid"], "*.csv*")
    assert found(frame.where(f"{FILE_COLUMN} not like '%f.csv.gz'")) == sorted(
        [
            ("good", None, 1, 2),
            ("fields", "3,4,t", None, None),
            ("fields", "5,6,t,u,x", None, None),
            ("type", "zz,7,t,u", None, 7),
            ("good", None, None, 8),
            ("no key column", "name,url", None, None),
            ("empty file", None, None, None),
            ("good", None, 11, 12),
        ],
        key=repr,
    )
    broken = frame.where(f"{FILE_COLUMN} like '%f.csv.gz'")
    assert [r[0] for r in broken.select(REASON_COLUMN).collect()][-1] == "unreadable"
    files = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in sources.unread_files(frame).collect()}
    assert files == {"b.csv": "no key column", "c.csv": "empty file", "f.csv.gz": "unreadable"}


def test_an_absent_folder_is_empty(spark, tmp_path):
    assert read(spark, tmp_path / "absent").count() == 0


def test_byte_order_marks_line_ends_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbf"aid","qId"\r\n2,"1"\r\n\r\n4,3\r\n')
    (tmp_path / "b.csv").write_bytes(HEAD.encode() + '5,6,"two\nlines, ""q""",""\n7,8,,u\xe9\n'.encode("latin-1"))
    frame = read(spark, tmp_path)
    assert rows(frame.select("qId", "aid", "question_title", "topic_url")) == sorted(
        [(1, 2, None, None), (3, 4, None, None), (5, 6, 'two\nlines, "q"', ""), (7, 8, None, "u�")], key=repr
    )


def test_every_type_and_a_type_it_does_not_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "i,l,d,b,t\n1,+2,1.5,true,2020-01-02\n3000000000,99999999999999999999,x,maybe,no\n 4.0 ,-5.,1e3,FALSE,\n"
    )
    schema = StructType().add("i", "integer").add("l", "long").add("d", "double").add("b", "boolean").add("t", "date")
    frame = read(spark, tmp_path, [], schema)
    good = frame.where(f"{REASON_COLUMN} is null").select("i", "l", "d", "b", F.col("t").cast("string"))
    assert rows(good) == sorted([(1, 2, 1.5, True, "2020-01-02"), (4, -5, 1000.0, False, None)], key=repr)
    assert rows(frame.where(f"{REASON_COLUMN} = 'type'").select("i", "l", "d", "b", "t")) == [(None,) * 5]
    with pytest.raises(Exception, match="no reading of map"):
        read(spark, tmp_path, [], StructType().add("m", MapType(StringType(), LongType()))).collect()


@given(st.lists(st.tuples(st.text(), st.one_of(st.none(), st.integers(-(1 << 63), (1 << 63) - 1))), max_size=20))
def test_written_rows_come_back(data):
    """Any text through a CSV writer: row for row, whatever the batches."""
    out = io.StringIO()
    writer = csv.writer(out)
    writer.writerow(["text", "n"])
    data = [(t.replace("\x00", ""), n) for t, n in data]
    data = [(t.encode("utf-8", "replace").decode(), n) for t, n in data]
    for text, n in data:
        out.write('"' + text.replace('"', '""') + '",' + ("" if n is None else str(n)) + "\n")

    class Held(headed._Reader):
        pass

    reader = Held({"path": "x"}, StructType().add("n", "long").add("text", "string"))
    original = headed._lines
    headed._lines = lambda name: io.StringIO(out.getvalue(), newline="")
    try:
        got = [row for batch in reader.read(headed.Files(["x"])) for row in batch.to_pylist()]
    finally:
        headed._lines = original
    assert [(row["text"], row["n"], row[REASON_COLUMN]) for row in got] == [(t, n, None) for t, n in data]


def test_small_files_share_a_task_and_large_ones_do_not():
    files = [(f"f{n}", size, 0) for n, size in enumerate([4, 4, 4, 100, 1, 9])]
    assert [p.names for p in headed.packed(files, 10)] == [["f0", "f1"], ["f2"], ["f3"], ["f4", "f5"]]


def test_no_text_scan_and_no_names_through_a_group(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD)
    plan = read(spark, tmp_path)._jdf.queryExecution().toString()
    assert "headed_csv" in plan and "collect_list" not in plan and "FileScan text" not in plan


def test_a_stream_of_mixed_headers_takes_each_file_once(spark, tmp_path):
    landing, sink, aside = tmp_path / "in", str(tmp_path / "sink"), str(tmp_path / "aside")
    landing.mkdir()
    (landing / "a.csv").write_text(HEAD + "1,2,t,u\nzz,3,t,u\n")
    (landing / "b.csv").write_text("x,y\n1,2\n")

    def run():
        stream = sources.stream_headed(spark, str(landing), schemas.LINKS, str(tmp_path / "log"), ["qId", "aid"])
        ingest_stream(stream, sink, ["qId", "aid"], str(tmp_path / "state"), quarantine=aside).awaitTermination()

    run()
    run()
    (landing / "c.csv").write_text("topic_url,aid,qId\nv,20,10\nu,2,1\n")
    run()
    assert rows(read_sink(spark, sink).select("qId", "aid", "topic_url")) == [(1, 2, "u"), (10, 20, "v")]
    assert rows(spark.read.parquet(aside).select("reason", "row")) == [("no key column", "x,y"), ("type", "zz,3,t,u")]
    assert len(list((tmp_path / "log").glob("*.json"))) == 2


def test_a_stream_that_runs_again_reads_the_files_of_its_log(tmp_path):
    landing, log = tmp_path / "in", str(tmp_path / "log")
    landing.mkdir()
    (landing / "a.csv").write_text(HEAD)
    options = {"path": str(landing), "log": log}
    first = headed.HeadedStreamReader(options, schemas.LINKS)
    assert first.initialOffset() == {"taken": 0} and first.latestOffset() == {"taken": 1}
    (landing / "b.csv").write_text(HEAD)
    # Another run takes up the list where the first one left it, and replays its step alike.
    second = headed.HeadedStreamReader(options, schemas.LINKS)
    assert second.latestOffset() == {"taken": 2}
    names = [[n.rsplit("/", 1)[1] for p in r.partitions({"taken": a}, {"taken": b}) for n in p.names]
             for r, a, b in ((second, 0, 1), (second, 1, 2), (first, 0, 1))]
    assert names == [["a.csv"], ["b.csv"], ["a.csv"]]
    assert second.latestOffset() == {"taken": 2} and [p.names for p in second.partitions({"taken": 2}, {"taken": 2})] == [[]]
    with pytest.raises(ValueError, match="log"):
        headed.HeadedStreamReader({"path": str(landing)}, schemas.LINKS)
