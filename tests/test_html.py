"""Extraction from pages, against hand-written markup and a plain-Python reading."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from askmill.functions import html as H
from askmill.functions.text import decode_entities
from askmill.plans.answers import BLOCK_PAGE_MARK, EMPTY_PAGE_TEXT, extract_answers, read_answers
from askmill.plans.links import answer_links, extract_links, page_links, questions_not_landed, region_links


def one(spark, page, make):
    frame = spark.createDataFrame([(page,)], "html string")
    return frame.select(make(H.markup_only(F.col("html"))).alias("v")).first()["v"]


def elements(markup):
    return H.meta_and_button_elements(markup, "Button VoteButton VoteButton--up")


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<p>a</P>b</p>c", "a"),
        ("<p>a</p >b</p>", "a"),
        ("<p>a</pre>b</p>", "ab"),
        ("<p>a</p><p class='x'> b <i>c</i>\n</p>", "a b c"),
        ("<p>a<script>var p = '</p>';</script>b</p>", "ab"),
        ("<!-- <p>no</p> --><style>p{}</style><p>yes</p>", "yes"),
        ("<P>a</P ><param><pre>no</pre>", "a"),
        ("<p></p><p> </p>", " "),
        ("no paragraphs", ""),
        ("<p>a<p>b</p>c<p>d", "a b d"),
        ("<div><p>a</div><footer>f</footer>", "a"),
        ("<p>1 &lt; 2 &amp;amp; 3&nbsp;</p>", "1 < 2 &amp; 3"),
        ("<p>a < b</p>", "a < b"),
        ("<script>never closed <p>x</p>", ""),
    ],
)
def test_paragraph_text(spark, page, expected):
    assert one(spark, page, H.paragraph_text) == expected


QUOTED = """<a title="a>b" href="/x">l</a><p title="1>2">hi &hellip;</p><div title="see href=foo">d</div>"""


def test_quoted_values_may_look_like_markup(spark):
    assert one(spark, QUOTED, H.hrefs) == ["/x"]
    assert one(spark, QUOTED, H.paragraph_text) == "hi …"
    page = """<i title=">class='x'">no</i><b data-class='x' title='<' class="x y">yes</b><p a='</p>'>t"""
    assert one(spark, page, lambda m: H.text_by_class(m, "x")) == "yes"
    page = """<meta title="content=a>" itemprop='url' content='b'><a href=c/d>x</a><a title=it's href="e">"""
    assert one(spark, page, lambda m: H.contents_of(H.meta_properties(elements(m)), "url")) == ["b"]
    assert one(spark, page, H.hrefs) == ["c/d", "e"]


def test_hrefs_in_all_quotings(spark):
    page = (
        """<a href="/a&amp;b">x</a><A class=c HREF='b'>x</A><link rel=x href=c><i data-href="no"></i>"""
        """<script>document.write('<a href="no">')</script>href="no" """
    )
    assert one(spark, page, H.hrefs) == ["/a&b", "b", "c"]


def test_element_by_class_is_balanced(spark):
    page = (
        '<div class="side">s</div><div id=1 class="x Question-main y">a<div>b<div>c</div></div>'
        "<DIV/>d</div>e</div>f"
    )
    assert one(spark, page, lambda m: H.element_by_class(m, "Question-main")) == (
        "a<div>b<div>c</div></div><DIV/>d</div>e"
    )
    assert one(spark, page, lambda m: H.element_by_class(m, "Question-mai")) is None
    assert one(spark, page, lambda m: H.text_by_class(m, "side")) == "s"


def test_unclosed_element_runs_to_the_end(spark):
    assert one(spark, "<nav>a<nav>b</nav>c", lambda m: H.element_by_tag(m, "nav")) == "a<nav>b</nav>c"


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ('<button class="Button VoteButton VoteButton--up">​ 5 <b>k</b></button>', "​ 5 k"),
        ("<button a=1 class='  Button  VoteButton VoteButton--up '>7</button>", "7"),
        ('<button class="VoteButton Button VoteButton--up">7</button>', None),
        ('<button class="Button VoteButton VoteButton--up x">7</button>', None),
        ('<button class="Button VoteButton VoteButton--up"></button>', ""),
        ('<button><meta a=1><BUTTON class="Button VoteButton VoteButton--up">1</button>', "1"),
    ],
)
def test_button_text(spark, page, expected):
    assert one(spark, page, lambda m: H.button_text(elements(m))) == expected


def test_meta_contents(spark):
    page = (
        '<meta itemProp="dateCreated" content="1"/><meta content=\'2\' ITEMPROP="dateCreated">'
        '<meta itemprop="url" content="u"><meta itemprop="dateCreated">'
    )
    found = one(spark, page, lambda m: H.contents_of(H.meta_properties(elements(m)), "dateCreated"))
    assert found == ["1", "2", None]
    empty = one(spark, '<meta itemprop="url" content="">', lambda m: H.meta_properties(elements(m)))
    assert [tuple(p) for p in empty] == [("url", "")]


VOTES = '<button class="Button VoteButton VoteButton--up">​9</button>'
AUTHOR = '<meta itemprop="url" content="https://h/question/1"><meta itemprop="url" content="https://h/people/p">'
PAGE_SCHEMA = "question_id long, answer_id long, question_title string, status int, html string"


def page_cases():
    good = f"<p>a</p>{VOTES}{AUTHOR}"
    return {
        None: good,
        "status": good,
        "no page": None,
        "empty page": f"<p>{EMPTY_PAGE_TEXT}</p>{VOTES}{AUTHOR}",
        "block page": f"<p>x {BLOCK_PAGE_MARK} y</p>{VOTES}{AUTHOR}",
        "no date": f'{good}<meta itemprop="dateCreated">',
        "no votes": f"<p>a</p>{AUTHOR}",
        "no author": f"<p>a</p>{VOTES}",
    }


def test_answers_and_rejects_partition_the_pages(spark):
    cases = page_cases()
    data = [
        (i, 1, "t", 500 if reason == "status" else 200, page)
        for i, (reason, page) in enumerate(cases.items())
    ]
    pages = spark.createDataFrame(data, PAGE_SCHEMA)
    good, bad = extract_answers(pages, "https://h")
    assert rows(good) == [
        (0, 1, "https://h/people/p", "t", "a", "9", "", "https://h/question/0/answer/1")
    ]
    reasons = {r["question_id"]: r["reject_reason"] for r in bad.collect()}
    assert reasons == dict(list(enumerate(cases))[1:])
    assert read_answers(pages, "https://h").count() == len(data)


def test_page_and_region_links(spark):
    pages = spark.createDataFrame(
        [("https://h/a", '<nav><a href="/n">n</a></nav><a href="http://o/x">x</a><a href="//o/y">y</a>')],
        "url string, html string",
    )
    assert rows(page_links(pages).select("href")) == [("https://h/n",), ("https://o/y",)]
    assert rows(region_links(pages, tag="nav").select("href")) == [("https://h/n",)]


def test_links_of_all_topics(spark):
    topics = spark.createDataFrame(
        [
            ("https://h/topic/2", '<a href="/question/5/answer/50?write">x</a>'),
            ("https://h/topic/1", '<a href="/question/5/answer/51">x</a><a href="/question/6/answer/60">x</a>'),
            ("https://h/topic/3", '<a href="/question/x/answer/60">x</a><a href="/p/1">p</a>'),
        ],
        "url string, html string",
    )
    listing = (
        '<h1 class="QuestionHeader-title">T</h1><div class="Question-main">'
        '<a href="/question/5/answer/51">a</a><a href="/question/5/answer/51">again</a>'
        '<a href="/question/5/answer/52#!">b</a><a href="/question/6/answer/1">other</a>'
        '<a href="/question/5/answer/5x">c</a></div><a href="/question/5/answer/99">outside</a>'
    )
    questions = spark.createDataFrame(
        [("https://h/question/5/answer/51", listing), ("https://h/question/6/answer/60", listing)],
        "url string, html string",
    )
    viewed = spark.createDataFrame([(6,), (6,), (None,)], "question_id long")
    links, aside = extract_links(topics, questions, viewed)
    assert rows(links) == [(5, 51, "T", "https://h/topic/1"), (5, 52, "T", "https://h/topic/1")]
    assert [r["href"] for r in aside.collect()] == ["https://h/question/5/answer/5x"]


def test_questions_landed_elsewhere_or_not_at_all_are_accounted_for(spark):
    topics = spark.createDataFrame(
        [("https://h/topic/1", "".join(f'<a href="/question/{n}/answer/1">x</a>' for n in (11, 12, 13)))],
        "url string, html string",
    )
    pages = spark.createDataFrame(
        [
            (
                f"https://h/question/{n}/answer/{landed}",
                f'<h1 class="QuestionHeader-title">T</h1><div class="Question-main"><a href="/question/{n}/answer/{n}0">a</a></div>',
            )
            for n, landed in ((11, 2), (13, 1))
        ],
        "url string, html string",
    )
    links, aside = extract_links(topics, pages)
    assert rows(links) == [(11, 110, "T", "https://h/topic/1"), (13, 130, "T", "https://h/topic/1")]
    assert aside.count() == 0
    missing = questions_not_landed(topics, pages)
    assert [(r.question_id, r.reject_reason) for r in missing.collect()] == [(12, "not landed")]


def test_a_page_without_a_title_is_set_aside(spark):
    pages = spark.createDataFrame(
        [("t", 5, "https://h/q", '<div class="Question-main"><a href="/question/5/answer/51">a</a></div>')],
        "topic_url string, question_id long, url string, html string",
    )
    links, aside = answer_links(pages)
    assert links.count() == 0
    assert aside.count() == 1


def test_decoding_compiles_no_pattern_for_each_row(spark):
    texts = ["a &amp; b&lt;", "&", "&&amp;&", "no\n&nope; &#65;x", "", "&copy", None]
    decoded = spark.createDataFrame([(t,) for t in texts], "t string").select(decode_entities(F.col("t")).alias("d"))
    assert "split(" not in decoded._jdf.queryExecution().analyzed().toString()
    assert [r["d"] for r in decoded.collect()] == ["a & b<", "&", "&&&", "no\n&nope; Ax", "", "©", None]
