"""Reading values out of HTML with Spark SQL expressions.

Pages stay a string column; each function is a column expression, so scans, filters and
extraction run in one stage on the executors. Scripts, styles and comments must be cut out
first because their bodies may hold text that looks like markup: ``markup`` below stands
for a column made by ``markup_only``, computed once per page and shared by all readers.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from askmill.functions.text import (
    TAG_BODY,
    bound,
    decode_entities,
    join_parts,
    strip_tags,
    strip_text,
)

_NOT_MARKUP = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|script\b.*?(?:</script\s*>|\z)"
    r"|style\b.*?(?:</style\s*>|\z))"
)
_P_OPEN = rf"(?i)<p(?:\s{TAG_BODY})?>"
_P_CLOSE = r"(?i)</p\s*>"
_FROM_P_CLOSE = r"(?is)</p\s*>.*\z"
_FROM_BLOCK_CLOSE = (
    r"(?is)</(?:article|aside|body|div|footer|header|html|main|nav|section|td)\s*>.*\z"
)
_START_TAG = rf"(?is)<[a-z]{TAG_BODY}>"
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _attributes_before(name: str) -> str:
    """Pattern of a tag's attributes up to the first of this name and its equals sign.

    Whole pairs of name and value are stepped over, so a value that looks like the attribute is not
    taken for it.
    """
    pair = r"""(?:[^\s=>/"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+|["'=])"""
    wanted = rf"{re.escape(name)}\s*="
    return rf"(?:[\s/]*+(?!{wanted}){pair})*+[\s/]*+{wanted}\s*"


def markup_only(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, _NOT_MARKUP, "")


def text_of(markup: Column) -> Column:
    """Text of a piece of markup: tags out, entities decoded."""
    return decode_entities(strip_tags(markup))


def paragraphs(markup: Column) -> Column:
    """Array with the stripped text of every paragraph, in page order.

    A paragraph ends at its end tag, or at the next paragraph's start tag if that comes
    first, so no text is given twice. An unclosed one ends with the block around it.
    """
    pieces = F.filter(F.split(markup, _P_OPEN, -1), lambda piece, place: place > 0)

    def cut(piece: Column) -> Column:
        closed = F.when(piece.rlike(_P_CLOSE), F.regexp_replace(piece, _FROM_P_CLOSE, ""))
        return closed.otherwise(F.regexp_replace(piece, _FROM_BLOCK_CLOSE, ""))

    def untag(text: Column) -> Column:
        return F.when(text.contains("<"), strip_tags(text)).otherwise(text)

    def decode(text: Column) -> Column:
        return F.when(text.contains("&"), decode_entities(text)).otherwise(text)

    # One transform to a step: a lambda that uses its argument twice must not repeat the
    # step before it.
    bare = F.transform(F.transform(pieces, cut), untag)
    return F.transform(F.transform(bare, decode), strip_text)


def paragraph_text(markup: Column) -> Column:
    """All paragraphs of the page joined by one space."""
    return join_parts(paragraphs(markup), " ")


def hrefs(markup: Column) -> Column:
    """Array with the href value of every element that has one, as written."""
    tags = F.regexp_extract_all(markup, F.lit(_START_TAG), F.lit(0))
    likely = F.filter(tags, lambda tag: tag.rlike(r"(?i)href"))
    found = F.filter(
        F.transform(likely, lambda tag: F.regexp_extract(tag, _attribute_pattern("href"), 1)),
        lambda raw: raw != "",
    )
    return F.transform(F.transform(found, _unquoted), strip_text)


def _attribute_pattern(name: str) -> str:
    return rf"(?is)^<[a-z][^\s/>]*+{_attributes_before(name)}{_VALUE}"


def _unquoted(raw: Column) -> Column:
    return decode_entities(F.regexp_replace(raw, r"""^["']|["']\z""", ""), bare_names=False)


def _inner_markup(markup: Column, open_pattern: str) -> Column:
    """Markup between the first tag that matches and the end tag that balances it.

    ``open_pattern`` captures the tag name in group 1. The text after the start tag is cut
    at every end tag of that name; the element ends with the piece that brings the depth
    back to zero. Null where no tag matches.
    """
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("taken"))

    def inner(open_tag: Column) -> Column:
        name = F.lower(F.regexp_extract(open_tag, r"^<([a-zA-Z][a-zA-Z0-9]*)", 1))
        rest = F.substr(markup, F.instr(markup, open_tag) + F.length(open_tag))
        balanced = bound(name, lambda tag: bound(F.split(rest, _end_of(tag), -1), _up_to(tag)))
        return F.when(open_tag != "", balanced)

    def _end_of(tag: Column) -> Column:
        return F.concat(F.lit("(?i)</"), tag, F.lit(r"\s*>"))

    def _up_to(tag: Column):
        nested = F.concat(F.lit("(?i)<"), tag, F.lit(rf"(?:[\s/]{TAG_BODY})?>"))
        end_tag = F.concat(F.lit("</"), tag, F.lit(">"))

        def step(state: Column, piece: Column) -> Column:
            depth = state["depth"] + F.regexp_count(piece, nested) - 1
            return F.when(state["depth"] == 0, state).otherwise(
                F.struct(depth.alias("depth"), (state["taken"] + 1).alias("taken"))
            )

        def join(pieces: Column) -> Column:
            taken = F.aggregate(pieces, start, step)["taken"]
            return F.call_function("array_join", F.slice(pieces, F.lit(1), taken), end_tag)

        return join

    return bound(F.regexp_extract(markup, open_pattern, 0), inner)


def element_by_tag(markup: Column, tag: str) -> Column:
    """Inner markup of the first element with this tag name."""
    return _inner_markup(markup, rf"(?i)<({re.escape(tag)})(?:\s{TAG_BODY})?>")


def _class_pattern(class_name: str) -> str:
    token = re.escape(class_name)
    quoted = rf"""(?:"(?:[^"]*\s)?{token}(?:\s[^"]*)?"|'(?:[^']*\s)?{token}(?:\s[^']*)?')"""
    return rf"(?is)<([a-z][a-z0-9]*+)(?=[\s/]){_attributes_before('class')}{quoted}{TAG_BODY}>"


def element_by_class(markup: Column, class_name: str) -> Column:
    """Inner markup of the first element that carries this class among its classes."""
    return _inner_markup(markup, _class_pattern(class_name))


def text_by_class(markup: Column, class_name: str) -> Column:
    """Stripped text of the first element that carries this class; null if there is none."""
    return strip_text(text_of(element_by_class(markup, class_name)))


def text_by_tag(markup: Column, tag: str) -> Column:
    return strip_text(text_of(element_by_tag(markup, tag)))


def _button_pattern(classes: str) -> str:
    words = r"\s+".join(re.escape(word) for word in classes.split())
    value = rf"""(?:"\s*{words}\s*"|'\s*{words}\s*')"""
    return rf"button(?=[\s/]){_attributes_before('class')}{value}{TAG_BODY}>.*?</button\s*>"


def meta_and_button_elements(markup: Column, classes: str) -> Column:
    """Array of all ``<meta>`` tags and of the buttons with exactly these classes, in order,
    found in one pass over the page."""
    pattern = rf"(?is)<(?:meta\b{TAG_BODY}>|{_button_pattern(classes)})"
    return F.regexp_extract_all(markup, F.lit(pattern), F.lit(0))


def _is_meta(element: Column) -> Column:
    return F.lower(F.substring(element, 2, 4)) == "meta"


def button_text(elements: Column) -> Column:
    """Text of the first button among ``meta_and_button_elements``; null if there is none."""
    buttons = F.filter(elements, lambda element: ~_is_meta(element))
    return text_of(F.try_element_at(buttons, F.lit(1)))


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, its name matched without case; null where absent."""

    def value(raw: Column) -> Column:
        return F.when(raw != "", _unquoted(raw))

    return bound(F.regexp_extract(tag, _attribute_pattern(name), 1), value)


def meta_properties(elements: Column) -> Column:
    """Array with the ``itemprop`` and ``content`` of every ``<meta>`` tag among the
    elements, null where absent."""

    def pair(tag: Column) -> Column:
        return F.struct(
            _attribute(tag, "itemprop").alias("itemprop"),
            _attribute(tag, "content").alias("content"),
        )

    return F.transform(F.filter(elements, _is_meta), pair)


def contents_of(properties: Column, itemprop: str) -> Column:
    """Array of the contents that ``meta_properties`` found under one itemprop."""
    return F.filter(properties, lambda p: p["itemprop"] == itemprop)["content"]
