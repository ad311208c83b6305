"""Column lists of the tables that the toolkit reads and writes."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


_LONG, _TEXT = LongType(), StringType()

LINKS = _struct(("qId", _LONG), ("aid", _LONG), ("question_title", _TEXT), ("topic_url", _TEXT))

# Votes stay text (they are button captions) and the creation time stays ISO-8601 text.
ANSWERS = _struct(
    ("question_id", _LONG),
    ("answer_id", _LONG),
    ("author_id", _TEXT),
    ("question_title", _TEXT),
    ("content", _TEXT),
    ("upvotes", _TEXT),
    ("answer_creation_time", _TEXT),
    ("request_url", _TEXT),
)

ROOT_COMMENTS = _struct(
    ("answer_id", _LONG),
    ("id", _LONG),
    ("content", _TEXT),
    ("child_comment_count", _LONG),
    ("author.name", _TEXT),
)

COMMENT_TREE = _struct(
    ("answer_id", _LONG),
    ("id", _LONG),
    ("reply_root_comment_id", _LONG),
    ("reply_comment_id", _LONG),
    ("content", _TEXT),
    ("author.name", _TEXT),
)

API_PAGE = _struct(
    ("paging", _struct(("totals", _LONG))),
    (
        "data",
        ArrayType(
            _struct(
                ("author", _struct(("name", _TEXT), ("id", _TEXT), ("url_token", _TEXT))),
                ("voteup_count", _LONG),
                ("created_time", _LONG),
                ("updated_time", _LONG),
                ("url", _TEXT),
                ("question", _struct(("id", _LONG), ("title", _TEXT))),
            )
        ),
    ),
)

BUCKET_MAP = MapType(StringType(), IntegerType())
