"""Answers related to their root comments and the replies below them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmill.operators.joins import join_on_shared_key, join_splitting_hot_keys, suffix_overlap

# The suffixes and the columns of the related comments.
_SUFFIXES = ("_root_comment", "_comment_tree")

_ROOT_COLUMNS = ("id", "content", "author.name", "answer_id")
_REPLY_COLUMNS = ("id", "reply_root_comment_id", "reply_comment_id", "author.name", "content")
_ANSWER_COLUMNS = ("answer_id", "question_title", "content")

OUTPUT_COLUMNS = (
    "answer_id",
    "question_title",
    "answer_content",
    "id_root_comment",
    "content_root_comment",
    "author.name_root_comment",
    "id_comment_tree",
    "reply_root_comment_id",
    "reply_comment_id",
    "author.name_comment_tree",
    "content_comment_tree",
)


def _only(frame: DataFrame, columns) -> DataFrame:
    return frame.select(*[F.col(f"`{c}`") for c in columns])


def relate_comments(
    roots: DataFrame,
    replies: DataFrame,
    answers: DataFrame,
    root_id: int | None = None,
    split_hot_roots: bool = False,
) -> DataFrame:
    """One row per reply with its root comment and the answer commented on.

    ``root_id`` limits the work to one root comment; the optimizer carries the limit over
    to the replies' scan. Adaptive execution splits a root that holds a large share of
    the replies; ``split_hot_roots`` splits it in the plan instead, at the cost of a count.
    """
    roots = _only(roots, _ROOT_COLUMNS)
    if root_id is not None:
        roots = roots.where(F.col("id") == root_id)
    left, right = suffix_overlap(roots, _only(replies, _REPLY_COLUMNS), _SUFFIXES)
    if split_hot_roots:
        threads = join_splitting_hot_keys(right, left, "reply_root_comment_id", "id_root_comment")
    else:
        threads = left.join(right, left["id_root_comment"] == right["reply_root_comment_id"])
    subjects = _only(answers, _ANSWER_COLUMNS).withColumnRenamed("content", "answer_content")
    related = join_on_shared_key(subjects, threads, "answer_id", ("_answer", "_root_comment"))
    return _only(related, OUTPUT_COLUMNS)
