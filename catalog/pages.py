"""Text and links out of the landed pages table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.functions import html as H
from askmill.operators.counts import distinct_count_by
from askmill.plans.links import page_links, region_links, roundtable_links, topic_links
from catalog.registry import pages_table, query

_CUT = (
    r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
)
_SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]"
_EDGE = rf"^{_SPACE}+|{_SPACE}+\z"


def _decoded(text: str) -> str:
    for entity, plain in (
        ("&lt;", "'<'"),
        ("&gt;", "'>'"),
        ("&quot;", "'\"'"),
        ("&apos;", "''''"),
        ("&#39;", "''''"),
        ("&nbsp;", "chr(160)"),
        ("&amp;", "'&'"),
    ):
        text = f"replace({text}, '{entity}', {plain})"
    return text


def _text(markup: str) -> str:
    bare = f"regexp_replace({markup}, '</?[a-zA-Z!?][^>]*>', '', 'g')"
    return f"regexp_replace({_decoded(bare)}, '{_EDGE}', '', 'g')"


# Up to the end tag; of a paragraph never closed, up to the end of the block around it.
_PARAGRAPH = (
    r"(CASE WHEN regexp_matches(p, '(?i)</p\s*>') THEN regexp_split_to_array(p, '(?i)</p\s*>')[1] "
    r"ELSE regexp_split_to_array(p, '(?i)</(article|aside|body|div|footer|header|html|main|nav|section|td)\s*>')[1] "
    r"END)"
)

MARKUP = f"WITH cut AS (SELECT page_id, url, regexp_replace(html, '{_CUT}', '', 'g') AS m FROM pages)"

_ORIGIN = "regexp_extract(url, '^[a-z]+://[^/?#]*')"


def _links(source: str) -> str:
    """Links of the test pages, which are all relative to the site's root."""
    return f"""
SELECT page_id, url, {_ORIGIN} || {_decoded("href")} AS href
FROM (SELECT page_id, url, unnest(regexp_extract_all({source}, '(?i)<a href="([^"]*)"', 1)) AS href
      FROM cut)
WHERE contains({_ORIGIN} || {_decoded("href")}, 'https://')
"""


@query(
    MARKUP
    + rf"""
, pieces AS (
  SELECT page_id, regexp_split_to_array(m, '(?i)<p(?:\s[^>]*)?>')[2:] AS ps FROM cut
)
SELECT page_id, array_to_string(list_transform(ps, lambda p: {_text(_PARAGRAPH)}), ' ') AS content
FROM pieces
"""
)
def page_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    """All paragraphs of a page joined by one space."""
    cut = pages_table(spark, folder).select("page_id", H.markup_only(F.col("html")).alias("m"))
    return cut.select("page_id", H.paragraph_text(F.col("m")).alias("content"))


@query(
    MARKUP
    + f"""
SELECT page_id, {_text("regexp_extract(m, '(?is)<title>(.*?)</title>', 1)")} AS title,
       {_text("regexp_extract(m, '(?is)<h1>(.*?)</h1>', 1)")} AS heading,
       {_text("regexp_extract(m, '(?is)<div class=.ad.>(.*?)</div>', 1)")} AS ad
FROM cut
"""
)
def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Text of the title, the heading, and the first element of a class."""
    cut = pages_table(spark, folder).select("page_id", H.markup_only(F.col("html")).alias("m"))
    return cut.select(
        "page_id",
        H.text_by_tag(F.col("m"), "title").alias("title"),
        H.text_by_tag(F.col("m"), "h1").alias("heading"),
        H.text_by_class(F.col("m"), "ad").alias("ad"),
    )


@query(
    MARKUP
    + f"""
SELECT page_id, {_text("regexp_extract(m, '(?is)<footer>(.*?)</footer>', 1)")}
       .replace('&copy;', chr(169)).replace('&middot;', chr(183)) AS footer
FROM cut
"""
)
def page_footers(spark: SparkSession, folder: str) -> DataFrame:
    """Footer text with every named entity decoded."""
    cut = pages_table(spark, folder).select("page_id", H.markup_only(F.col("html")).alias("m"))
    return cut.select("page_id", H.text_by_tag(F.col("m"), "footer").alias("footer"))


@query(MARKUP + _links("m"))
def page_hrefs(spark: SparkSession, folder: str) -> DataFrame:
    """All links of a page, made absolute; those without ``https://`` dropped."""
    return page_links(pages_table(spark, folder), "page_id", "url")


@query(MARKUP + _links("regexp_extract(m, '(?is)<nav>(.*?)</nav>', 1)"))
def nav_links(spark: SparkSession, folder: str) -> DataFrame:
    """The links inside the navigation element."""
    return region_links(pages_table(spark, folder), "page_id", "url", tag="nav")


@query(
    MARKUP
    + f"""
SELECT DISTINCT href AS topic_urls, category AS basic_topic_category
FROM (SELECT regexp_extract(url, '/(en|fr|de|es)/', 1) AS category, l.*
      FROM ({_links("m")}) l)
WHERE contains(href, '.net/')
"""
)
def topic_link_table(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct links under a prefix with the category of the page they are on."""
    pages = pages_table(spark, folder).withColumn(
        "category", F.regexp_extract("url", "/(en|fr|de|es)/", 1)
    )
    return topic_links(pages, ".net/")


@query(
    MARKUP + f"SELECT href AS round_table_topic_url FROM ({_links('m')}) WHERE contains(href, '.org/')"
)
def roundtable_link_table(spark: SparkSession, folder: str) -> DataFrame:
    """Links under a prefix as they occur."""
    return roundtable_links(pages_table(spark, folder), ".org/")


@query(
    MARKUP
    + f"SELECT url AS topic_url, count(DISTINCT href) AS links FROM ({_links('m')}) GROUP BY url"
)
def topic_unique_links(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct links per page URL."""
    links = page_links(pages_table(spark, folder), "url").withColumnRenamed("url", "topic_url")
    return distinct_count_by(links, ["topic_url"], "href", "links")
