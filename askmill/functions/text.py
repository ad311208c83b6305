"""Text cleaning as Spark SQL expressions."""

from __future__ import annotations

import html.entities
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Unicode counts as white space. SQL trim() removes the
# plain space alone unless it is told otherwise.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

#: A tag from its name to its end: a ``>`` inside a quoted value does not end it. Quantifiers are
#: possessive, so long tags neither backtrack nor recurse. A quote without a partner is plain text.
TAG_BODY = r"""(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+"""
_TAG = rf"</?[a-zA-Z!?]{TAG_BODY}>"

# The names and their characters come from the standard table; frequent ones are found first.
_FREQUENT = ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;")
_NAMED = {name: html.entities.html5[name] for name in (*_FREQUENT, *html.entities.html5)}
_BARE = sorted((name for name in _NAMED if not name.endswith(";")), key=len, reverse=True)
# Numbers from 128 to 159 mean the characters of code page 1252 where that has one.
_C1 = {chr(n): bytes([n]).decode("cp1252", "ignore") for n in range(128, 160)}
_C1 = {c: plain for c, plain in _C1.items() if plain}


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    An expression used several times inside another is otherwise copied into it, and
    copies of copies multiply.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_text(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def strip_tags(markup: Column) -> Column:
    """Remove tags and leave the text between them as it stands."""
    return F.regexp_replace(markup, _TAG, "")


def decode_entities(text: Column, bare_names: bool = True) -> Column:
    """Decode every named and numeric HTML reference once, without leaving the JVM.

    Unknown names stay as they stand. The old names that need no semicolon are read without one
    if ``bare_names``, as in text; in attribute values they are not. Numbers that are no character
    give U+FFFD, those of control characters nothing.
    """
    names = f"|(?:{'|'.join(_BARE)})" if bare_names else ""
    # The text up to a reference and the reference, or the rest: a split would compile its pattern for every row.
    reference = rf"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]*+;{names})"
    pattern = F.lit(rf"(?s)(.*?)({reference}|\z)")

    def decoded(value: Column) -> Column:
        parts = F.zip_with(
            F.regexp_extract_all(value, pattern, F.lit(1)),
            F.regexp_extract_all(value, pattern, F.lit(2)),
            lambda plain, found: F.when(found == "", plain).otherwise(
                F.concat(plain, F.coalesce(_character(found), F.lit("")))
            ),
        )
        return F.array_join(parts, "")

    return bound(text, lambda value: F.when(value.contains("&"), decoded(value)).otherwise(value))


def _character(reference: Column) -> Column:
    """The text that one reference stands for; itself if its name is unknown."""
    named = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")
    name = F.substring(reference, 2, 64)
    hexadecimal = F.conv(F.regexp_extract(reference, "([0-9a-fA-F]+);?$", 1), 16, 10)
    digits = F.when(F.lower(F.substring(reference, 3, 1)) == "x", hexadecimal).otherwise(
        F.regexp_extract(reference, "([0-9]+);?$", 1)
    )

    def character(number: Column) -> Column:
        known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        bytes_ = F.unhex(F.lpad(F.hex(F.when(known, number)), 8, "0"))
        plain = F.translate(F.decode(bytes_, "UTF-32"), "".join(_C1), "".join(_C1.values()))
        plain = F.regexp_replace(plain, r"[\x01-\x08\x0B\x0E-\x1F\x7F-\x9F]", "")
        return F.coalesce(plain, F.lit("\ufffd"))

    numeric = bound(digits.try_cast("long"), character)
    return F.when(F.substring(reference, 2, 1) == "#", numeric).otherwise(
        F.coalesce(F.try_element_at(named, name), reference)
    )


def remove_literal(text: Column, literals: Sequence[str]) -> Column:
    """Remove each literal wherever it occurs."""
    for literal in literals:
        text = F.replace(text, F.lit(literal), F.lit(""))
    return text


def join_parts(parts: Column, separator: str = " ") -> Column:
    """Concatenate an array of text in order; an empty array gives empty text."""
    return F.array_join(parts, separator)


def composed_key(*columns: Column) -> Column:
    """Ids written one after the other, nulls as nothing.

    For display only: (1, 23) and (12, 3) compose to the same text, so joins use the ids.
    """
    return F.concat_ws("", *[c.cast("string") for c in columns])


def random_hex_id() -> Column:
    """32 random hexadecimal characters."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))
