"""From landed pages to topic, roundtable, question and answer links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmill.functions import html as H
from askmill.functions import urls as U
from askmill.operators.dedup import keep_first
from askmill.operators.filters import computed_once
from askmill.operators.joins import without_keys
from askmill.sources.landed import LandedPages

# The page regions that hold a question's title and its answer links.
TITLE_CLASS = "QuestionHeader-title"
ANSWERS_CLASS = "Question-main"
ANSWER_LIST_CLASS = "QuestionAnswers-answers"


def _resolved(found: DataFrame, *keep: Column | str) -> DataFrame:
    """Links made absolute against the page's URL; those without ``https://`` go."""
    links = found.select(*keep, U.resolve_url(F.col("_href"), F.col("_page")).alias("href"))
    return computed_once(links, ["href"]).where(F.col("href").contains(U.SECURE_SCHEME))


def page_links(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per ``https://`` link of each page, with the page's kept columns."""
    found = pages.select(
        *keep,
        F.col("url").alias("_page"),
        F.explode(H.hrefs(H.markup_only(F.col("html")))).alias("_href"),
    )
    return _resolved(found, *keep)


def region_links(
    pages: DataFrame, *keep: str, tag: str | None = None, css_class: str | None = None
) -> DataFrame:
    """As ``page_links``, from the first element with this tag name or class alone."""
    cut = pages.select(
        *keep, F.col("url").alias("_page"), H.markup_only(F.col("html")).alias("_markup")
    )
    markup = F.col("_markup")
    region = H.element_by_tag(markup, tag) if tag else H.element_by_class(markup, css_class)
    found = cut.select(*keep, "_page", F.explode(H.hrefs(region)).alias("_href"))
    return _resolved(found, *keep)


def topic_links(pages: DataFrame, topic_prefix: str) -> DataFrame:
    """Distinct topic links of base-topic pages with the page's category.

    ``pages`` has ``url``, ``html`` and ``category``.
    """
    found = page_links(pages, "category").where(F.col("href").contains(topic_prefix))
    return found.select(
        F.col("href").alias("topic_urls"), F.col("category").alias("basic_topic_category")
    ).distinct()


def roundtable_links(pages: DataFrame, roundtable_prefix: str) -> DataFrame:
    """Roundtable links as they occur, repeats included."""
    found = page_links(pages).where(F.col("href").contains(roundtable_prefix))
    return found.select(F.col("href").alias("round_table_topic_url"))


def question_links(topic_pages: DataFrame, any_question: bool = False) -> DataFrame:
    """Question links found on topic pages: ``topic_url``, ``question_url``.

    By default only links that lead to an answer of a question count. ``any_question``
    takes all question links save those of waiting questions.
    """
    test = U.is_question if any_question else U.is_answer_of_question
    found = page_links(topic_pages, "url").where(test(F.col("href")))
    return found.select(
        F.col("url").alias("topic_url"), F.col("href").alias("question_url")
    ).distinct()


def new_questions(
    links: DataFrame, viewed: DataFrame | None = None, any_question: bool = False
) -> DataFrame:
    """One row per question not viewed before: the first by topic and URL.

    Adds ``question_id``; links without a numeric id are left out. ``viewed`` has
    ``question_id``. Each question is reduced to one row before the anti-join, so one
    that many topics link to weighs no more than any other.
    """
    url = F.col("question_url")
    number = U.any_question_id(url) if any_question else U.to_long(U.question_id_text(url))
    named = links.select(
        "topic_url",
        U.without_write_suffix(url).alias("question_url"),
        number.alias("question_id"),
    ).dropna(subset=["question_id"])
    first = keep_first(named, ["question_id"], ["topic_url", "question_url"])
    if viewed is None:
        return first
    return without_keys(first, viewed, {"question_id": "question_id"})


def answer_links(
    question_pages: DataFrame, region: str = ANSWERS_CLASS, own_question: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Answer links of landed question pages, and the links without readable ids.

    ``question_pages`` has ``topic_url``, ``question_id``, ``url`` and ``html``. Links are
    taken from the first element of the region's class, must look like an answer (of the
    page's question, unless ``own_question`` is off), and are kept once over all pages, by
    topic and question.
    """
    cut = question_pages.select(
        "topic_url", "question_id", "url", H.markup_only(F.col("html")).alias("markup")
    )
    read = cut.select(
        "topic_url",
        "question_id",
        F.col("url").alias("_page"),
        H.text_by_class(F.col("markup"), TITLE_CLASS).alias("question_title"),
        H.element_by_class(F.col("markup"), region).alias("_region"),
    )
    listed = read.select(
        "topic_url",
        "question_id",
        "question_title",
        "_page",
        F.explode(H.hrefs(F.col("_region"))).alias("_href"),
    )
    found = _resolved(listed, "topic_url", "question_id", "question_title")
    found = found.where(U.has_answer_path(F.col("href")))
    if own_question:
        found = found.where(U.contains_id(F.col("href"), F.col("question_id")))
    unique = keep_first(found, ["href"], ["topic_url", "question_id"])
    parsed = unique.select(
        U.link_question_id(F.col("href")).alias("qId"),
        U.link_answer_id(F.col("href")).alias("aid"),
        "question_title",
        "topic_url",
        "href",
    )
    readable = (
        F.col("qId").isNotNull() & F.col("aid").isNotNull() & F.col("question_title").isNotNull()
    )
    return parsed.where(readable).drop("href"), parsed.where(~readable)


def extract_links(
    topic_pages: DataFrame,
    question_pages: DataFrame | LandedPages,
    viewed: DataFrame | None = None,
    any_question: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Answer links of all questions that landed topic pages lead to.

    ``question_pages`` holds the landed question pages as ``url`` and ``html``; a page counts
    for its question whichever answer its URL names. Pages landed by ``question_id`` in a table
    (``LandedPages``) are not moved; of a plain frame the pages are shuffled. Returns the links and the ones set aside;
    see ``questions_not_landed`` for questions without a page. ``any_question`` follows every question link of a
    topic page, such as a roundtable's, and reads the bare answer list of the question.
    """
    linked = question_links(topic_pages, any_question)
    questions = new_questions(linked, viewed, any_question)
    wanted = questions.drop("question_url")
    if isinstance(question_pages, LandedPages):
        joined = question_pages.meet(wanted)
    else:
        joined = wanted.join(question_pages.select(U.any_question_id(F.col("url")).alias("question_id"), "url", "html"), "question_id")
    if any_question:
        return answer_links(joined, ANSWER_LIST_CLASS, own_question=False)
    return answer_links(joined)


def questions_not_landed(
    topic_pages: DataFrame,
    question_pages: DataFrame,
    viewed: DataFrame | None = None,
    any_question: bool = False,
) -> DataFrame:
    """The questions ``extract_links`` has no page for, with a ``reject_reason``."""
    questions = new_questions(question_links(topic_pages, any_question), viewed, any_question)
    landed = question_pages.select(U.any_question_id(F.col("url")).alias("question_id"))
    missing = without_keys(questions, landed, {"question_id": "question_id"})
    return missing.withColumn("reject_reason", F.lit("not landed"))
