"""URL predicates, id extraction and URL building."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from askmill.functions.text import bound

# Path patterns and markers of question-and-answer URLs.
ANSWER_PATH = r"/question/\d+/answer/\d+"
QUESTION_PART = "/question/"
ANSWER_PART = "/answer/"
TOPIC_PART = "/topic/"
ROUNDTABLE_PART = "/roundtable/"
PEOPLE_PART = "/people/"
WAITING_MARK = "waiting"
WRITE_SUFFIX = "?write"
FRAGMENT_MARK = "#!"
SECURE_SCHEME = "https://"
TOP_ANSWERS_SUFFIX = "/top-answers"
MEDIA_BLOCKLIST = ("jpeg", "png", "gif", "banners", "webp")
BLOCKLIST_OFFSET = 10


def contains_all(url: Column, *parts: str) -> Column:
    """True where the URL holds every literal part."""
    test = url.contains(parts[0])
    for part in parts[1:]:
        test = test & url.contains(part)
    return test


def contains_without(url: Column, wanted: str, unwanted: str) -> Column:
    """True where the URL holds one literal and not the other."""
    return url.contains(wanted) & ~url.contains(unwanted)


def is_question(url: Column) -> Column:
    return contains_without(url, QUESTION_PART, WAITING_MARK)


def is_answer_of_question(url: Column) -> Column:
    return contains_all(url, QUESTION_PART, ANSWER_PART)


def has_answer_path(url: Column) -> Column:
    return url.rlike(ANSWER_PATH)


def contains_id(url: Column, identifier: Column) -> Column:
    """True where the id's digits occur anywhere in the URL; 12 is also found in 123."""
    return url.contains(identifier.cast("string"))


def is_blocked(
    url: Column,
    patterns: Sequence[str] = MEDIA_BLOCKLIST,
    offset: int = BLOCKLIST_OFFSET,
) -> Column:
    """True where any pattern, case aside, occurs at or after the given 0-based offset."""
    tail = F.substr(url, F.lit(offset + 1))
    return tail.rlike("(?iu)" + "|".join(patterns))


def path_part(url: Column, index: int) -> Column:
    """A piece of the URL between slashes, counted from the end when negative."""
    position = index + 1 if index >= 0 else index
    return F.try_element_at(F.split(url, "/", -1), F.lit(position))


def to_long(text: Column) -> Column:
    """Whole number or null; text with a fraction is not a whole number."""
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*\z"), text.try_cast("bigint"))


def without_write_suffix(url: Column) -> Column:
    return F.replace(url, F.lit(WRITE_SUFFIX), F.lit(""))


def without_fragment_mark(part: Column) -> Column:
    return F.replace(part, F.lit(FRAGMENT_MARK), F.lit(""))


def question_id_text(url: Column) -> Column:
    """The question id of ``…/question/Q/answer/A``, as text, ``?write`` removed first."""
    return path_part(without_write_suffix(url), -3)


def any_question_id(url: Column) -> Column:
    """The question id of any question link, with or without an answer part."""
    return to_long(F.regexp_extract(url, r"/question/(\d+)", 1))


def link_question_id(url: Column) -> Column:
    return to_long(without_fragment_mark(path_part(url, -3)))


def link_answer_id(url: Column) -> Column:
    return to_long(without_fragment_mark(path_part(url, -1)))


def last_part_id(url: Column) -> Column:
    """The id after the last slash, query and fragment left out."""
    return to_long(path_part(F.regexp_replace(url, r"[?#].*\z", ""), -1))


def answer_url(site: str, question_id: Column, answer_id: Column) -> Column:
    return F.concat(
        F.lit(site.rstrip("/") + QUESTION_PART),
        question_id.cast("string"),
        F.lit(ANSWER_PART),
        answer_id.cast("string"),
    )


def member_url(site: str, token: Column) -> Column:
    return F.concat(F.lit(site.rstrip("/") + PEOPLE_PART), token.cast("string"))


def member_answers_url(site: str, member_id: Column) -> Column:
    return F.concat(
        F.lit(site.rstrip("/") + "/members/"), member_id.cast("string"), F.lit("/answers")
    )


def topic_list_url(site: str, topic: Column) -> Column:
    return F.concat(F.lit(site.rstrip("/") + "/topics#"), topic)


def top_answers_url(topic_url: Column) -> Column:
    return F.concat(topic_url, F.lit(TOP_ANSWERS_SUFFIX))


def _without_dot_parts(url: Column) -> Column:
    """Apply ``.`` and ``..`` path parts the way a browser does."""
    head = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    tail = F.regexp_extract(url, r"([?#].*)\z", 1)
    parts = F.split(path, "/", -1)

    def step(kept, part):
        parent = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return (
            F.when(part == "..", parent)
            .when(part == ".", kept)
            .otherwise(F.concat(kept, F.array(part)))
        )

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    ends_in_dots = F.element_at(parts, -1).isin(".", "..")
    closing = F.when(ends_in_dots & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(head, F.lit("/"), F.array_join(kept, "/"), closing, tail)


def resolve_url(href: Column, page_url: Column) -> Column:
    """The absolute form of a link found on a page."""
    origin = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    no_fragment = F.regexp_replace(page_url, r"#.*\z", "")
    no_query = F.regexp_replace(page_url, r"[?#].*\z", "")
    folder = F.regexp_extract(no_query, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/]*/(?:.*/)?)", 1)
    folder = F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder)
    joined = (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .when(href == "", no_fragment)
        .otherwise(F.concat(folder, href))
    )
    dots = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^?#]*/\.\.?(/|\?|#|\z)"
    return bound(joined, lambda u: F.when(u.rlike(dots), _without_dot_parts(u)).otherwise(u))
