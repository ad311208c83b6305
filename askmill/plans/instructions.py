"""Instruction tables: INSTRUCTION, RESPONSE, SOURCE, METADATA."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmill.functions import urls as U
from askmill.functions.jsontext import json_object
from askmill.operators.dedup import last_value
from askmill.operators.filters import drop_exact
from askmill.operators.joins import lookup, lookup_misses
from askmill.sources.api import api_rows

# Metadata keys of the two answer shapes, the response that counts as blank,
# and the column names of a member's answers.
SCRAPED_METADATA = ("question_id", "answer_id", "author_id", "upvotes", "answer_creation_time")
MEMBER_METADATA = ("回答点赞数", "回答时间")
BLANK_RESPONSE = " "
MEMBER_COLUMNS = (
    "作者名称",
    "作者ID",
    "作者token",
    "回答点赞数",
    "回答时间",
    "更新时间",
    "回答ID",
    "问题ID",
    "问题内容",
)
MEMBER_CONTENT = "回答内容"


def instruction_rows(
    frame: DataFrame,
    instruction: str,
    response: str,
    source: str,
    metadata: Sequence[str],
    spaced: bool = False,
) -> DataFrame:
    """The four instruction columns; the metadata columns become one JSON object."""
    types = {field.name: field.dataType for field in frame.schema.fields}
    return frame.select(
        F.col(f"`{instruction}`").alias("INSTRUCTION"),
        F.col(f"`{response}`").alias("RESPONSE"),
        F.lit(source).alias("SOURCE"),
        json_object({key: F.col(f"`{key}`") for key in metadata}, types, spaced).alias("METADATA"),
    )


def to_instructions(
    answers: DataFrame, source: str, drop_null: bool = False, spaced: bool = False
) -> DataFrame:
    """Instruction rows of scraped answers; responses of one space are dropped.

    Null responses stay unless ``drop_null``.
    """
    rows = instruction_rows(
        answers, "question_title", "content", source, SCRAPED_METADATA, spaced
    )
    return drop_exact(rows, "RESPONSE", BLANK_RESPONSE, drop_null)


def project(frame: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Columns by a map from new name to expression, nested fields included."""
    return frame.select(*[expression.alias(name) for name, expression in columns.items()])


def member_answers(pages: DataFrame, max_count: int | None = None) -> DataFrame:
    """A member's answers out of landed API pages, nested fields brought to columns."""
    item = (
        F.col("author.name"),
        F.col("author.id"),
        F.col("author.url_token"),
        F.col("voteup_count"),
        F.col("created_time"),
        F.col("updated_time"),
        U.path_part(F.col("url"), -1),
        F.col("question.id"),
        F.col("question.title"),
    )
    return project(api_rows(pages, max_count), dict(zip(MEMBER_COLUMNS, item)))


_MEMBER_KEYS = [MEMBER_COLUMNS[7], MEMBER_COLUMNS[6]]


def _last_texts(contents: DataFrame, written: str | None) -> DataFrame:
    question, answer = _MEMBER_KEYS
    texts = contents.select(
        F.col("question_id").alias(question),
        F.col("answer_id").cast("string").alias(answer),
        F.col("content").alias(MEMBER_CONTENT),
        F.struct(*[f"`{c}`" for c in [*([written] if written else []), "content"]]).alias("_written"),
    )
    return last_value(texts, _MEMBER_KEYS, F.col(MEMBER_CONTENT), F.col("_written"), MEMBER_CONTENT)


def member_answer_misses(pages: DataFrame, contents: DataFrame, max_count: int | None = None) -> DataFrame:
    """The distinct (question, answer) ids of a member's answers that ``contents`` has no text for."""
    return lookup_misses(member_answers(pages, max_count), _last_texts(contents, None), _MEMBER_KEYS)


def member_answers_to_instructions(
    pages: DataFrame,
    contents: DataFrame,
    source: str,
    max_count: int | None = None,
    spaced: bool = False,
    written: str | None = None,
) -> DataFrame:
    """Instruction rows of a member's answers.

    ``contents`` has ``question_id``, ``answer_id`` and ``content``. The text is looked up by both ids, so two
    answers to one question keep their own. Of a pair's several texts the last by ``written`` counts (without it
    the greatest text), so repeats add no rows; see ``member_answer_misses`` for answers without a text.
    """
    answered = lookup(member_answers(pages, max_count), _last_texts(contents, written), _MEMBER_KEYS)
    return instruction_rows(
        answered, MEMBER_COLUMNS[8], MEMBER_CONTENT, source, MEMBER_METADATA, spaced
    )
