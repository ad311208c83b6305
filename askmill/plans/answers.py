"""From answer pages to answer records, and from raw answers to unique ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmill.functions import html as H
from askmill.functions import urls as U
from askmill.functions.text import remove_literal
from askmill.operators.dedup import keep_first
from askmill.operators.filters import computed_once, with_reject_reason
from askmill.plans.links import extract_links
from askmill.schemas import ANSWERS
from askmill.sinks import create_table_as, export_parquet
from askmill.sources.landed import LandedPages

# The site's empty-page sentence, the mark of a block page, the vote button's
# classes, and the invisible character in its caption.
EMPTY_PAGE_TEXT = "你似乎来到了没有知识存在的荒原"
BLOCK_PAGE_MARK = "var BC_IP_PORT = 9000;"
VOTE_BUTTON_CLASSES = "Button VoteButton VoteButton--up"
ZERO_WIDTH_SPACE = "​"
DATE_ITEMPROP = "dateCreated"
URL_ITEMPROP = "url"

ANSWER_KEYS = ("question_id", "answer_id")


def read_answers(pages: DataFrame, site: str) -> DataFrame:
    """Answer record of every page plus ``reject_reason``, null where the page is good.

    ``pages`` has ``question_id``, ``answer_id``, ``question_title``, ``html`` and, where
    recorded, ``status``. A page is rejected for its status, for the empty-page sentence
    or the block-page mark in its text, and for a missing vote button or author. A page
    without a date has an empty one.
    """
    status = F.col("status") if "status" in pages.columns else F.lit(200)
    cut = pages.select(
        *ANSWER_KEYS,
        "question_title",
        status.alias("_status"),
        H.markup_only(F.col("html")).alias("markup"),
    )
    markup = F.col("markup")
    found = cut.select(
        "*", H.meta_and_button_elements(markup, VOTE_BUTTON_CLASSES).alias("_elements")
    )
    metas = found.select("*", H.meta_properties(F.col("_elements")).alias("_metas"))
    tags = metas.select(
        "*",
        H.contents_of(F.col("_metas"), DATE_ITEMPROP).alias("dates"),
        H.contents_of(F.col("_metas"), URL_ITEMPROP).alias("authors"),
    )
    dates, authors = F.col("dates"), F.col("authors")
    read = tags.select(
        "question_id",
        "answer_id",
        F.try_element_at(F.filter(authors, lambda a: a.contains(U.PEOPLE_PART)), F.lit(1)).alias(
            "author_id"
        ),
        "question_title",
        H.paragraph_text(markup).alias("content"),
        remove_literal(H.button_text(F.col("_elements")), [ZERO_WIDTH_SPACE]).alias("upvotes"),
        F.when(F.size(dates) == 0, F.lit(""))
        .otherwise(F.try_element_at(dates, F.lit(-1)))
        .alias("answer_creation_time"),
        U.answer_url(site, F.col("question_id"), F.col("answer_id")).alias("request_url"),
        "_status",
        F.exists(authors, lambda a: a.isNull()).alias("_author_unreadable"),
    )
    reasons = {
        "status": ~F.col("_status").eqNullSafe(200),
        "no page": F.col("content").isNull(),
        "empty page": F.col("content") == EMPTY_PAGE_TEXT,
        "block page": F.col("content").contains(BLOCK_PAGE_MARK),
        "no date": F.col("answer_creation_time").isNull(),
        "no votes": F.col("upvotes").isNull(),
        "no author": F.col("author_id").isNull() | F.col("_author_unreadable"),
    }
    judged = with_reject_reason(read, reasons).drop("_status", "_author_unreadable")
    return computed_once(judged, [c for c in judged.columns if c not in (*ANSWER_KEYS, "question_title")])


def extract_answers(pages: DataFrame, site: str) -> tuple[DataFrame, DataFrame]:
    """Answer records of the good pages, and the ids of the rejected ones with the reason.

    The two partition the input. Reading them as two jobs parses the pages twice; write
    ``read_answers`` once and split it there when both are wanted.
    """
    read = read_answers(pages, site)
    good = read.where(F.col("reject_reason").isNull()).select(*ANSWERS.fieldNames())
    rejected = read.where(F.col("reject_reason").isNotNull())
    return good, rejected.select(*ANSWER_KEYS, "request_url", "reject_reason")


def consolidate(
    raw: DataFrame, keys: Sequence[str] = ANSWER_KEYS, order: Sequence[str] = ()
) -> DataFrame:
    """Unique answers: repeats dropped, then one row per key, the first by ``order``.

    Full-row repeats fall to the same aggregate that picks the first row of a key, so one
    shuffle does both.
    """
    return keep_first(raw, list(keys), list(order))


def consolidate_to_table(
    raw: DataFrame,
    table: str,
    export_path: str,
    keys: Sequence[str] = ANSWER_KEYS,
    refresh: bool = False,
) -> DataFrame:
    """Keep the distinct rows as a table, and export its unique answers to Parquet.

    An existing table is left as it is unless ``refresh``.
    """
    create_table_as(raw.distinct(), table, refresh)
    return export_parquet(consolidate(raw.sparkSession.table(table), keys), export_path)


def topics_to_answers(
    topic_pages: DataFrame,
    question_pages: DataFrame | LandedPages,
    landed_answers: DataFrame | LandedPages,
    site: str,
    viewed: DataFrame | None = None,
    any_question: bool = False,
) -> DataFrame:
    """Answer records reached from topic pages in one pass.

    ``landed_answers`` has ``question_id``, ``answer_id`` and ``html``; the question title
    comes from the question page. Pages landed in tables (``LandedPages``) are not moved. ``any_question`` is as in ``extract_links``.
    """
    links, _ = extract_links(topic_pages, question_pages, viewed, any_question)
    wanted = links.select(
        F.col("qId").alias("question_id"), F.col("aid").alias("answer_id"), "question_title"
    )
    if isinstance(landed_answers, LandedPages):
        pages = landed_answers.meet(wanted)
    else:
        pages = wanted.join(landed_answers, list(ANSWER_KEYS))
    return extract_answers(pages, site)[0]
