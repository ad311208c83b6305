"""URL allow and block lists as a trie over reversed host labels and path segments.

A rule is ``host/path``: it fits the host and its subdomains where the URL's path starts with the
rule's path. The longest fitting rule wins, host and path together; of equally long ones the one with the longer
host; of a rule given both ways, ``block`` wins. The trie travels to the executors as a broadcast value, so
the rules are counted first: more than ``MAX_RULES`` go through a join of the URL's own host
suffixes with the rules instead, which has the same result.

Rows in, rows out. A null URL, or one without ``://``, has an empty host and path and fits no
rule. Host labels may be empty (``a..b``); they are labels like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmill.llm.common import ascii_lower

MAX_RULES = 200_000

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class HostTrie:
    """Nodes by reversed host label; each holds a trie of whole path segments with prefix leaves."""

    def __init__(self, rules: list[Rule]):
        self.root: dict = {}
        for rule, verdict in rules:
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            segments = (slash + path).split("/")
            place = node.setdefault(None, {})
            for segment in segments[:-1]:
                place = place.setdefault(segment, {})
            leaves = place.setdefault(None, {})
            if leaves.get(segments[-1], (rule, "allow"))[1] != "block":
                leaves[segments[-1]] = (rule, verdict)

    def match(self, host: str, path: str) -> Rule | None:
        found, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            paths = node.get(None)
            fits = paths and self._path(paths, path)
            if fits and (found is None or len(fits[0]) >= len(found[0])):
                found = fits
        return found

    @staticmethod
    def _path(place: dict, path: str) -> Rule | None:
        found = None
        for segment in path.split("/"):
            leaves = place.get(None, {})
            for end in range(len(segment), -1, -1) if leaves else ():
                if segment[:end] in leaves:
                    found = leaves[segment[:end]]
                    break
            place = place.get(segment)
            if place is None:
                break
        return found


def judge(
    urls: DataFrame,
    rules: DataFrame | list[Rule],
    url: str = "url",
    default: str = "allow",
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null where none fits) and ``verdict`` to the rows of ``urls``.

    ``rules`` are (rule, verdict) pairs, or a frame of such columns. An empty list leaves every
    URL with the default verdict. Columns of these names in ``urls`` are replaced.
    """
    spark = urls.sparkSession
    place = urls.withColumns({"host": host_of(urls[url]), "path": path_of(urls[url])}).drop("rule", "verdict")
    if isinstance(rules, list):
        few = rules if len(rules) <= max_rules else None
        frame = None if few is not None else spark.createDataFrame(rules, "rule string, verdict string")
    else:
        frame = rules.select("rule", "verdict").where("rule is not null")
        head = frame.take(max_rules + 1)
        few = [tuple(row) for row in head] if len(head) <= max_rules else None
    if few is None:
        return _judge_by_join(place, frame, default)
    trie = spark.sparkContext.broadcast(HostTrie(few))

    @F.pandas_udf("struct<rule string, verdict string>")
    def look_up(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        match = trie.value.match
        for hosts, paths in parts:
            found = [match(h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    return place.withColumn("judged", look_up("host", "path")).select(
        *place.columns, F.col("judged.rule").alias("rule"), F.col("judged.verdict").alias("verdict")
    )


def _judge_by_join(place: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same by an equality join: each distinct host meets the rules of its suffixes."""
    rules = rules.groupBy("rule").agg(F.max("verdict").alias("verdict")).select(
        F.substring_index("rule", "/", 1).alias("suffix"),
        F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("start"),
        "rule",
        "verdict",
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n)),
    )
    pairs = place.select("host", "path").distinct()
    best = (
        pairs.withColumn("suffix", F.explode(suffixes))
        .join(rules, "suffix")
        .where(F.col("path").startswith(F.col("start")))
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct("rule", "verdict"),
                F.struct(F.length("rule"), F.length("suffix")),
            ).alias("found")
        )
        .select("host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("verdict"))
    )
    return place.join(best, ["host", "path"], "left").select(
        *place.columns, "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
