"""Benchmark passages in documents within an edit distance, by the pigeonhole principle.

A test item of m characters with an error budget of e is cut into e + 1 pieces. Where an item stands in
a text with at most e edits, at least one piece stands there unchanged, so an exact search for
the pieces loses no match. The hashes of all character runs as long as the shortest piece, up to
``GRAM``, are looked up in a table of the pieces' beginnings, in numpy for a whole text at once;
where one is found the piece itself is compared. Hits on nearby diagonals of an item are
verified together by Myers' bit-parallel edit distance over the stretch they allow. Before that the
item's distinct runs of ``SHORT`` characters are counted in the stretch: an edit spoils at most
``SHORT`` of them, so a stretch that lacks more than ``SHORT`` times the budget holds no match.

Texts and items are compared in lower case with runs of white space as one blank; places are counted
there. The budget is ``RATE`` of the item's characters, rounded down. Items of fewer than
``LEAST`` characters are not searched, since they stand in clean texts by chance ("yes", a year); ``unsearched`` lists them,
so that none is passed over in silence. Null texts are empty; rows
without item_id or with the same one are separate items.

The items are the query set: they are read in blocks of about ``BLOCK`` characters, each broadcast
and held against all documents, so no task needs all of a large benchmark at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmill.llm.common import id_and_text, marked_ids, unmarked_ids

RATE, LEAST, BLOCK, GRAM, SLOTS, SHORT = 0.1, 24, 2_000_000, 12, 22, 5


def folded_text(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, rate: float = RATE) -> tuple[int, list[tuple[int, str]]]:
    """The error budget, and budget + 1 pieces with their offsets."""
    budget = int(len(item) * rate)
    cuts = [len(item) * n // (budget + 1) for n in range(budget + 2)]
    return budget, [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def masks(item: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for place, char in enumerate(item):
        found[char] = found.get(char, 0) | 1 << place
    return found


def nearest(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(distance, end): the least edit distance of the item to a stretch of the text, first end."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for place, char in enumerate(text, 1):
        eq = peq.get(char, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus) & full
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        down = down << 1 & full
        plus = down | ~(xv | up) & full
        minus = up & xv
        if score < best:
            best, end = score, place
    return best, end


def run_hashes(text: str, size: int) -> np.ndarray:
    """A 32-bit hash of the ``size`` characters from each place; runs double, so few passes are made."""
    total = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") * np.uint32(0x9E3779B1)
    held, done, found = total, 0, None
    width = 1
    while True:
        if size & width:
            found = held if found is None else found[: len(held) - done] * np.uint32(0x85EBCA6B) ^ held[done:]
            done += width
        if done >= size:
            return found[: max(0, len(text) - size + 1)]
        held = (held[:-width] * np.uint32(0xC2B2AE35)) ^ (held[width:] + (held[width:] >> np.uint32(15)))
        width *= 2


class Matcher:
    """Finds all items of a block in a text."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.items, owners = [], {}
        for item_id, text in items:
            text = folded_text(text)
            if len(text) < LEAST:
                continue
            budget, parts = pieces(text, rate)
            number = len(self.items)
            self.items.append((item_id, text, budget))
            for offset, part in parts:
                owners.setdefault(part, []).append((number, offset))
        self.size = min([GRAM, *map(len, owners)])
        self.starts: dict[int, list] = {}
        for part, where in owners.items():
            self.starts.setdefault(int(run_hashes(part[: self.size], self.size)[0]), []).append((part, where))
        self.table = np.zeros(1 << SLOTS, bool)
        self.table[np.fromiter(self.starts, np.uint32, len(self.starts)) >> np.uint32(32 - SLOTS)] = True
        self.known = np.sort(np.fromiter(self.starts, np.uint32, len(self.starts)))
        self.searches = bool(owners)
        self.masks: dict[int, tuple[dict, dict]] = {}
        self.short: dict[int, set[int]] = {}

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, stop) of each item's best place in the text, if in budget."""
        if not self.searches:
            return []
        text = folded_text(text)
        hits: dict[int, set[int]] = {}
        hashes = run_hashes(text, self.size) if len(text) >= self.size else np.zeros(0, np.uint32)
        places = np.flatnonzero(self.table[hashes >> np.uint32(32 - SLOTS)])
        nearby = np.minimum(np.searchsorted(self.known, hashes[places]), len(self.known) - 1)
        places = places[self.known[nearby] == hashes[places]]
        for place, key in zip(places.tolist(), hashes[places].tolist(), strict=True):
            for part, where in self.starts[key]:
                if text.startswith(part, place):
                    for number, offset in where:
                        hits.setdefault(number, set()).add(place - offset)
        found = []
        runs = run_hashes(text, SHORT) if hits else hashes
        for number, starts in sorted(hits.items()):
            item_id, item, budget = self.items[number]
            short = self._short(number)
            best = None
            for low, high in self._stretches(sorted(starts), len(item), budget):
                low = max(0, low)
                if len(short.difference(runs[low : max(low, high - SHORT + 1)].tolist())) > SHORT * budget:
                    continue
                distance, stop = nearest(self._masks(number)[0], len(item), text[low:high])
                if distance <= budget and (best is None or distance < best[0]):
                    best = (distance, low, low + stop)
                    if not distance:
                        break
            if best:
                distance, low, stop = best
                _, back = nearest(self._masks(number)[1], len(item), text[low:stop][::-1])
                found.append((item_id, distance, stop - back, stop))
        return found

    @staticmethod
    def _stretches(starts: list[int], m: int, budget: int) -> list[tuple[int, int]]:
        """The stretches of text in which the hits allow a match; overlapping ones are one."""
        joined: list[list[int]] = []
        for start in starts:
            low, high = start - budget, start + m + budget
            if joined and low - joined[-1][0] <= 2 * budget and high >= joined[-1][1]:
                joined[-1][1] = high
            else:
                joined.append([low, high])
        return [(low, high) for low, high in joined]

    def _short(self, number: int) -> set[int]:
        if number not in self.short:
            self.short[number] = set(run_hashes(self.items[number][1], SHORT).tolist())
        return self.short[number]

    def _masks(self, number: int) -> tuple[dict, dict]:
        if number not in self.masks:
            item = self.items[number][1]
            self.masks[number] = masks(item), masks(item[::-1])
        return self.masks[number]


def unsearched(benchmark: DataFrame) -> DataFrame:
    """The items too short to be searched: item_id, text, and ``n_chars`` of the folded text."""

    def short(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            size = frame["text"].map(lambda text: len(folded_text(text)))
            yield frame.assign(n_chars=size)[size < LEAST]

    items = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), benchmark["text"].alias("text"))
    found = items.mapInPandas(short, "item_id string, text string, n_chars long")
    return found.withColumn("item_id", F.col("item_id").cast("long"))


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block: int = BLOCK) -> DataFrame:
    """One row for each document and item that stands in it: doc_id, item_id, distance, start, stop."""
    spark = docs.sparkSession
    texts = id_and_text(docs)
    items = benchmark.select(
        benchmark["item_id"].cast("long").alias("item_id"), F.coalesce(benchmark["text"], F.lit("")).alias("text")
    )
    total = items.agg(F.sum(F.length("text"))).head()[0] or 0
    blocks = -(-total // block) or 1
    schema = "doc_id long, item_id long, distance int, start long, stop long"
    found = None
    for number in range(blocks):
        held = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        shared = spark.sparkContext.broadcast([(r.item_id, r.text) for r in held])
        part = unmarked_ids(marked_ids(texts).mapInPandas(_search(shared, rate), schema))
        found = part if found is None else found.unionByName(part)
    return found


def _search(shared, rate: float):
    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(shared.value, rate)
        for frame in frames:
            rows = [
                (doc_id, *hit)
                for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True)
                for hit in matcher.find(text)
            ]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "start", "stop"]).astype({"item_id": "Int64"})

    return search
