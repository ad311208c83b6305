"""Answer pages, question pages and topic pages made out of the given tables, and their
extraction back to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.plans import answers as A
from askmill.plans import links as L
from askmill.sources import LandedPages, land_pages, landed_pages
from catalog.registry import SITE, new_database, pages_table, query, table


def _escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def document_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as an answer page: a paragraph per line, its metadata in the head.

    Long documents carry two dates, short ones none. Some sources lack an author, some a
    vote button; one language answers with status 404.
    """
    documents = pages_table(spark, folder, "documents")
    paragraphs = F.array_join(
        F.transform(
            F.split("text", "\n", -1),
            lambda line: F.concat(F.lit('<p class="t"> <b>'), _escaped(line), F.lit("</b>\n</p>")),
        ),
        "",
    )
    content = (
        F.when(F.col("source") == "src3", F.lit(f"<p>{A.EMPTY_PAGE_TEXT}</p>"))
        .when(F.col("source") == "src4", F.concat(paragraphs, F.lit(f"<p>{A.BLOCK_PAGE_MARK}</p>")))
        .otherwise(paragraphs)
    )
    date = F.when(
        F.col("n_chars") > 2000,
        F.lit('<meta itemProp="dateCreated" content="2020-01-01"/><meta content=\'2021-02-03\' ITEMPROP="dateCreated">'),
    ).when(F.col("n_chars") > 500, F.lit('<meta itemprop="dateCreated" content="2022-05-06T07:08:09.000Z"/>'))
    author = F.when(
        F.col("source") != "src1",
        F.concat(
            F.lit(f'<meta itemProp="url" content="{SITE}/question/1"/><meta itemProp="url" content="{SITE}/people/'),
            F.col("source"),
            F.lit('"/>'),
        ),
    )
    votes = F.when(
        F.col("source") != "src2",
        F.concat(
            F.lit('<button type="button" class="Button  VoteButton VoteButton--up"><span>​赞同 '),
            F.col("n_chars").cast("string"),
            F.lit("</span></button>"),
        ),
    )
    page = F.concat_ws(
        "",
        F.lit("<html><head>"),
        date,
        author,
        F.lit('</head><body><script>var p = "<p>no</p>";</script><!-- <p>no</p> -->'),
        F.lit('<button class="Button VoteButton">0</button>'),
        content,
        votes,
        F.lit("</body></html>"),
    )
    return documents.select(
        F.col("doc_id").alias("question_id"),
        (F.col("doc_id") * 10).alias("answer_id"),
        F.col("lang").alias("question_title"),
        F.when(F.col("lang") == "de", 404).otherwise(200).alias("status"),
        page.alias("html"),
    )


_RECORDS = r"""
WITH read AS (
  SELECT doc_id AS question_id, doc_id * 10 AS answer_id,
         'https://qa.example.com/people/' || source AS author_id,
         lang AS question_title,
         array_to_string(list_transform(string_split(text, chr(10)), lambda line:
           regexp_replace(line, '^[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]+|[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]+\z',
                          '', 'g')), ' ') AS content,
         '赞同 ' || n_chars AS upvotes,
         CASE WHEN n_chars > 2000 THEN '2021-02-03'
              WHEN n_chars > 500 THEN '2022-05-06T07:08:09.000Z' ELSE '' END AS answer_creation_time,
         'https://qa.example.com/question/' || doc_id || '/answer/' || (doc_id * 10) AS request_url,
         CASE WHEN lang = 'de' THEN 'status'
              WHEN source = 'src3' THEN 'empty page'
              WHEN source = 'src4' THEN 'block page'
              WHEN source = 'src2' THEN 'no votes'
              WHEN source = 'src1' THEN 'no author' END AS reject_reason
  FROM documents
)
"""


@query(
    _RECORDS
    + """
SELECT question_id, answer_id, author_id, question_title, content, upvotes, answer_creation_time,
       request_url
FROM read WHERE reject_reason IS NULL
"""
)
def answer_records(spark: SparkSession, folder: str) -> DataFrame:
    """Answer records of the good pages."""
    return A.extract_answers(document_pages(spark, folder), SITE)[0]


@query(
    _RECORDS
    + """
SELECT question_id, answer_id, request_url, reject_reason FROM read WHERE reject_reason IS NOT NULL
"""
)
def answer_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The rejected pages with the reason."""
    return A.extract_answers(document_pages(spark, folder), SITE)[1]


_NEAR = 1000
_FAR = 1_000_000


def _question_url(question: Column) -> Column:
    text = question.cast("string")
    return F.concat(F.lit(f"{SITE}/question/"), text, F.lit("/answer/"), text)


def topic_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as questions listed on their nation's topic page, fifty to a landed page."""
    listed = table(spark, folder, "customer").select(
        F.concat(F.lit(f"{SITE}/topic/"), F.col("c_nationkey").cast("string")).alias("url"),
        F.floor(F.col("c_custkey") / 50).alias("part"),
        F.concat(
            F.lit('<a class="q" href="'),
            F.replace(_question_url(F.col("c_custkey") + _NEAR), F.lit(SITE), F.lit("")),
            F.when(F.col("c_mktsegment") == "FURNITURE", "?write").otherwise(""),
            F.lit('">q</a><a href="/question/waiting">w</a><a href="/p/1">p</a>'),
        ).alias("link"),
    )
    return listed.groupBy("url", "part").agg(
        F.concat(
            F.lit("<html><body>"), F.array_join(F.collect_list("link"), ""), F.lit("</body></html>")
        ).alias("html")
    )


def question_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as answers listed on their customer's question page.

    A page lists the answers of one span of a thousand order keys, so no page grows with
    the data. Every link is there twice; some have an unreadable answer id.
    """
    question = F.col("o_custkey") + _NEAR
    answer = F.concat(
        F.lit("/question/"),
        question.cast("string"),
        F.lit("/answer/"),
        (F.col("o_orderkey") + _FAR).cast("string"),
        F.when(F.col("o_orderstatus") == "P", "?x").when(F.col("o_orderstatus") == "F", "#!").otherwise(""),
    )
    links = table(spark, folder, "orders").select(
        question.alias("question"),
        F.floor(F.col("o_orderkey") / 1000).alias("part"),
        F.concat(
            F.lit('<div class="item"><a href="'), answer, F.lit("\">a</a></div><a href='"), answer, F.lit("'>b</a>")
        ).alias("link"),
    )
    listed = links.groupBy("question", "part").agg(F.array_join(F.collect_list("link"), "").alias("list"))
    return listed.select(
        _question_url(F.col("question")).alias("url"),
        F.concat(
            F.lit('<html><body><h1 class="QuestionHeader-title big"> Q&amp;A <i>'),
            F.col("question").cast("string"),
            F.lit('</i>\n</h1><div><div class="Question-main wide"><a href="/question/1/answer/2">x</a>'),
            F.col("list"),
            F.lit('</div><div class="side"><a href="/question/'),
            F.col("question").cast("string"),
            F.lit('/answer/77">y</a></div></div></body></html>'),
        ).alias("html"),
    )


def _viewed(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    return customers.select((F.col("c_custkey") + _NEAR).alias("question_id"))


@query(
    """
SELECT DISTINCT 'https://qa.example.com/topic/' || c_nationkey AS topic_url,
       'https://qa.example.com/question/' || (c_custkey + 1000) || '/answer/' || (c_custkey + 1000)
       || CASE WHEN c_mktsegment = 'FURNITURE' THEN '?write' ELSE '' END AS question_url
FROM customer
"""
)
def question_link_table(spark: SparkSession, folder: str) -> DataFrame:
    """Question links found on topic pages."""
    return L.question_links(topic_pages(spark, folder))


@query(
    """
SELECT 'https://qa.example.com/topic/' || c_nationkey AS topic_url,
       'https://qa.example.com/question/' || (c_custkey + 1000) || '/answer/' || (c_custkey + 1000)
       AS question_url,
       c_custkey + 1000 AS question_id
FROM customer WHERE c_mktsegment <> 'BUILDING'
"""
)
def new_question_table(spark: SparkSession, folder: str) -> DataFrame:
    """Questions not viewed before, each once."""
    return L.new_questions(L.question_links(topic_pages(spark, folder)), _viewed(spark, folder))


_FOUND = """
WITH found AS (
  SELECT o_custkey + 1000 AS "qId", o_orderkey + 1000000 AS aid,
         'Q&A ' || (o_custkey + 1000) AS question_title,
         'https://qa.example.com/topic/' || c_nationkey AS topic_url, o_orderstatus, o_orderkey,
         o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING'
)
"""


@query(_FOUND + """SELECT "qId", aid, question_title, topic_url FROM found WHERE o_orderstatus <> 'P'""")
def link_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Answer links reached from topic pages over question pages."""
    return L.extract_links(
        topic_pages(spark, folder), question_pages(spark, folder), _viewed(spark, folder)
    )[0]


def landed_questions(spark: SparkSession, folder: str) -> LandedPages:
    """The question pages in a table by question."""
    number = F.regexp_extract("url", r"/question/(\d+)", 1).cast("long").alias("question_id")
    name = f"{new_database(spark)}.question_pages"
    pages = question_pages(spark, folder).select(number, "url", "html")
    land_pages(pages, name, ["question_id"], buckets=16, pieces=2)
    return landed_pages(spark, name)


@query(_FOUND + """SELECT "qId", aid, question_title, topic_url FROM found WHERE o_orderstatus <> 'P'""")
def link_extract_landed(spark: SparkSession, folder: str) -> DataFrame:
    """As ``link_extract``, from pages in a table by question, which are not moved."""
    return L.extract_links(topic_pages(spark, folder), landed_questions(spark, folder), _viewed(spark, folder))[0]


@query(
    _FOUND
    + """
SELECT "qId", CAST(NULL AS BIGINT) AS aid, question_title, topic_url,
       'https://qa.example.com/question/' || "qId" || '/answer/' || aid || '?x' AS href
FROM found WHERE o_orderstatus = 'P'
"""
)
def link_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Links whose ids cannot be read."""
    return L.extract_links(
        topic_pages(spark, folder), question_pages(spark, folder), _viewed(spark, folder)
    )[1]


@query(
    """
SELECT 'https://qa.example.com/topic/' || c_nationkey AS topic_url,
       'https://qa.example.com/question/' || (c_custkey + 1000) || '/answer/' || (c_custkey + 1000)
       AS question_url,
       c_custkey + 1000 AS question_id,
       'not landed' AS reject_reason
FROM customer
WHERE c_mktsegment <> 'BUILDING'
  AND ((c_custkey + 1000) % 3 = 0 OR NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey))
"""
)
def link_questions_not_landed(spark: SparkSession, folder: str) -> DataFrame:
    """New questions without a page, where those of every third question were not landed."""
    pages = question_pages(spark, folder)
    landed = pages.where(F.regexp_extract("url", r"/question/(\d+)", 1).cast("long") % 3 != 0)
    return L.questions_not_landed(topic_pages(spark, folder), landed, _viewed(spark, folder))


@query(
    _FOUND
    + """
SELECT "qId" AS question_id, aid AS answer_id,
       'https://qa.example.com/people/' || o_orderpriority AS author_id, question_title,
       'Order ' || o_orderkey || ' <' || o_orderpriority || '>' AS content,
       CAST(length(o_orderpriority) AS VARCHAR) AS upvotes, '' AS answer_creation_time,
       'https://qa.example.com/question/' || "qId" || '/answer/' || aid AS request_url
FROM found WHERE o_orderstatus <> 'P'
"""
)
def topics_to_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Answer records reached from topic pages in one pass."""
    return A.topics_to_answers(
        topic_pages(spark, folder),
        question_pages(spark, folder),
        order_answer_pages(spark, folder),
        SITE,
        _viewed(spark, folder),
    )


@query(
    _FOUND
    + """
SELECT "qId" AS question_id, aid AS answer_id,
       'https://qa.example.com/people/' || o_orderpriority AS author_id, question_title,
       'Order ' || o_orderkey || ' <' || o_orderpriority || '>' AS content,
       CAST(length(o_orderpriority) AS VARCHAR) AS upvotes, '' AS answer_creation_time,
       'https://qa.example.com/question/' || "qId" || '/answer/' || aid AS request_url
FROM found WHERE o_orderstatus <> 'P'
"""
)
def topics_to_answers_landed(spark: SparkSession, folder: str) -> DataFrame:
    """As ``topics_to_answers``, with question and answer pages in tables by their ids."""
    name = f"{new_database(spark)}.answer_pages"
    land_pages(order_answer_pages(spark, folder), name, ["question_id", "answer_id"], buckets=16, pieces=1)
    return A.topics_to_answers(
        topic_pages(spark, folder),
        landed_questions(spark, folder),
        landed_pages(spark, name),
        SITE,
        _viewed(spark, folder),
    )


def order_answer_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as answer pages."""
    return table(spark, folder, "orders").select(
        (F.col("o_custkey") + _NEAR).alias("question_id"),
        (F.col("o_orderkey") + _FAR).alias("answer_id"),
        F.concat(
            F.lit(f'<html><meta content="{SITE}/people/'),
            F.col("o_orderpriority"),
            F.lit('" itemprop="url"><p>Order '),
            F.col("o_orderkey").cast("string"),
            F.lit(" &lt;"),
            F.col("o_orderpriority"),
            F.lit('&gt;</p><button class="Button VoteButton VoteButton--up">'),
            F.length("o_orderpriority").cast("string"),
            F.lit("</button></html>"),
        ).alias("html"),
    )


def roundtable_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as bare question links on their segment's roundtable, fifty to a page."""
    listed = table(spark, folder, "customer").select(
        F.concat(F.lit(f"{SITE}/roundtable/"), F.lower("c_mktsegment")).alias("url"),
        F.floor(F.col("c_custkey") / 50).alias("part"),
        F.concat(
            F.lit('<a href="/question/'),
            (F.col("c_custkey") + _NEAR).cast("string"),
            F.lit('">q</a><a href="/question/waiting/5">w</a>'),
        ).alias("link"),
    )
    return listed.groupBy("url", "part").agg(F.array_join(F.collect_list("link"), "").alias("html"))


@query(
    """
SELECT o_custkey + 1000 AS "qId", o_orderkey + 1000000 AS aid, 'T' || (o_custkey + 1000) AS question_title,
       'https://qa.example.com/roundtable/' || lower(c_mktsegment) AS topic_url
FROM orders JOIN customer ON o_custkey = c_custkey
"""
)
def roundtable_answer_links(spark: SparkSession, folder: str) -> DataFrame:
    """Answer links reached from roundtables, which link to questions without an answer."""
    question = (F.col("o_custkey") + _NEAR).cast("string")
    links = table(spark, folder, "orders").select(
        question.alias("question"),
        F.floor(F.col("o_orderkey") / 1000).alias("part"),
        F.concat(
            F.lit('<p><a href="/question/'),
            question,
            F.lit("/answer/"),
            (F.col("o_orderkey") + _FAR).cast("string"),
            F.lit('">a</a></p>'),
        ).alias("link"),
    )
    listed = links.groupBy("question", "part").agg(F.array_join(F.collect_list("link"), "").alias("list"))
    pages = listed.select(
        F.concat(F.lit(f"{SITE}/question/"), "question").alias("url"),
        F.concat(
            F.lit('<h1 class="QuestionHeader-title">T'),
            "question",
            F.lit('</h1><div class="QuestionAnswers-answers">'),
            "list",
            F.lit('</div><a href="/question/1/answer/1">x</a>'),
        ).alias("html"),
    )
    return L.extract_links(roundtable_pages(spark, folder), pages, any_question=True)[0]
