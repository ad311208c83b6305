"""Hard-negative mining by matrix products in a residue number system.

Vectors are integers: every component x becomes ``floor(scale * x)``. Scores are their exact inner products.
A float32 product is exact only below 2**24, so components are taken modulo several small primes, as
residues around 0: a product over ``INNER`` of them stays exact in float32 whatever the order of additions. Each
prime has its own matrix product, and Chinese remaindering puts the signed score together. How many primes
are needed follows from the largest squared length of a vector, which bounds all scores.

The anchors meet all rows in tiles: rows and anchors are dealt into blocks by a hash, each row goes to every
block of anchors and each anchor to every block of rows, and a tile holds at most about ``VALUES`` components of
either. First, a tile gives each anchor its best ``positives`` rows of the same label, and a window over the tiles
keeps the best of all. Then, with the positives' scores known, a tile gives for each anchor and positive the
best rows of other labels whose score lies between ``low`` and ``high`` percent of the positive's, and a window
merges them. A tile passes on no more than it may keep, so what is shuffled after the products is bounded
by anchors and tiles, and a hot label is spread like any other.

Rows with a null label, a null vector, or a null or non-finite component take no part. Vectors of different
lengths are multiplied over their common length. Higher scores come first, ties by smaller id; a null id
comes last and is returned as null, as the largest long would be. Rows that repeat an id are rows of their own: an anchor
passes over itself alone. Empty tables give no rows, a positive without negatives no row. Where
an inner product could reach 2**62 an ``OverflowError`` says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from askmill.llm.common import saved

#: Primes below 1024: 64 products of residues of at most 510 stay under 2**24.
PRIMES, INNER = (1021, 1019, 1013, 1009, 997, 991, 983), 64
#: Components of a tile on either side, and scores held at once.
VALUES, SCORES = 1 << 23, 1 << 21
LAST = np.iinfo(np.int64).max
_NONE = np.iinfo(np.int64).min


def enough_primes(bound: int) -> tuple[int, ...]:
    """The first primes whose product exceeds all differences of two scores of at most ``bound``."""
    product = 1
    for count, prime in enumerate(PRIMES, 1):
        product *= prime
        if product > 2 * bound:
            return PRIMES[:count]
    raise OverflowError(f"inner products may reach {bound}, beyond what a long holds exactly")


def residues(values: np.ndarray, prime: int) -> np.ndarray:
    found = values % prime
    return np.where(found > prime // 2, found - prime, found).astype(np.float32)


def scores(left: np.ndarray, right: list[np.ndarray], primes: tuple[int, ...], bound: int) -> np.ndarray:
    """Exact inner products of integer rows; ``right`` holds the residues of the other side by prime."""
    total, product = None, 1
    for prime, other in zip(primes, right, strict=True):
        mine = residues(left, prime)
        width = min(mine.shape[1], other.shape[1])
        part = np.full((len(mine), len(other)), bound % prime, np.int64)
        for start in range(0, width, INNER):
            stop = min(start + INNER, width)
            part += (mine[:, start:stop] @ other[:, start:stop].T).astype(np.int64)
        if total is None:
            total = part % prime
        else:
            # Garner's step: the next mixed-radix digit of score + bound, which is never negative.
            total += (part - total) % prime * pow(product, -1, prime) % prime * product
        product *= prime
    return total - bound


def _matrix(vectors: pd.Series) -> np.ndarray:
    rows = vectors.tolist()
    width = max(map(len, rows), default=0)
    found = np.zeros((len(rows), width), np.int64)
    for place, row in enumerate(rows):
        found[place, : len(row)] = row
    return found


def _first_of_groups(group: np.ndarray, most: int) -> np.ndarray:
    """Which entries are among the first ``most`` of their group; groups stand together."""
    if not len(group):
        return np.zeros(0, bool)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    place = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
    return place < most


def _parts(count: int, width: int) -> Iterator[slice]:
    step = max(1, SCORES // max(width, 1))
    for start in range(0, count, step):
        yield slice(start, start + step)


def _best_positives(primes: tuple[int, ...], bound: int, most: int):
    def tile(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, np.int64),) * 3]
        groups = dict(list(rows.sort_values(["id", "uid"]).groupby("label")))
        for label, asking in anchors.groupby("label"):
            if label not in groups or not len(asking):
                continue
            mine = groups[label]
            ids, uids, matrix = mine["id"].to_numpy(), mine["uid"].to_numpy(), _matrix(mine["vector"])
            others = [residues(matrix, p) for p in primes]
            itself = pd.Index(uids).get_indexer(asking["uid"])
            left, known = _matrix(asking["vector"]), asking["uid"].to_numpy()
            for part in _parts(len(left), len(ids)):
                score = scores(left[part], others, primes, bound)
                own = itself[part]
                score[np.flatnonzero(own >= 0), own[own >= 0]] = _NONE
                least = np.partition(score, -most, axis=1)[:, -most] if len(ids) > most else np.full(len(score), _NONE)
                a, r = np.nonzero((score >= least[:, None]) & (score != _NONE))
                order = np.lexsort((r, -score[a, r], a))
                a, r = a[order], r[order]
                keep = _first_of_groups(a, most)
                a, r = a[keep], r[keep]
                found.append((known[part][a], ids[r], score[a, r]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)]
        return pd.DataFrame(dict(zip(["anchor", "id", "score"], columns, strict=True)))

    return tile


def _best_negatives(primes: tuple[int, ...], bound: int, most: int, low: int, high: int):
    def edge(score: int, percent: int, up: bool) -> int:
        return -((-score * percent) // 100) if up else score * percent // 100

    def tile(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, np.int64),) * 4]
        if len(rows) and len(anchors):
            rows = rows.sort_values(["id", "uid"])
            ids, labels, matrix = rows["id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["vector"])
            others = [residues(matrix, p) for p in primes]
            left, known = _matrix(anchors["vector"]), anchors["uid"].to_numpy()
            own, wanted = anchors["label"].to_numpy(), anchors["positive_scores"].tolist()
            width = max(map(len, wanted))
            # Places without a positive have an empty window.
            lows, highs = np.full((len(left), width), LAST), np.full((len(left), width), _NONE)
            for place, values in enumerate(wanted):
                lows[place, : len(values)] = [edge(int(v), low, True) for v in values]
                highs[place, : len(values)] = [edge(int(v), high, False) for v in values]
            for part in _parts(len(left), len(ids)):
                score = scores(left[part], others, primes, bound)
                floor, ceiling = lows[part].min(axis=1)[:, None], highs[part].max(axis=1)[:, None]
                a, r = np.nonzero((score >= floor) & (score <= ceiling) & (labels[None, :] != own[part][:, None]))
                order = np.lexsort((r, -score[a, r], a))
                a, r = a[order], r[order]
                s = score[a, r]
                for place in range(width):
                    inside = (s >= lows[part][a, place]) & (s <= highs[part][a, place])
                    at = a[inside]
                    keep = _first_of_groups(at, most)
                    at = at[keep]
                    found.append((known[part][at], np.full(len(at), place), ids[r[inside][keep]], s[inside][keep]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)]
        return pd.DataFrame(dict(zip(["anchor", "place", "id", "score"], columns, strict=True)))

    return tile


def _block(blocks: int, salt: int) -> Column:
    return F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(blocks)).cast("int")


def _tiles(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int):
    """Rows and anchors side by side, grouped by every pair of their blocks."""
    every_anchor = F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("anchor_block")
    every_row = F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("row_block")
    left = rows.select("*", _block(row_blocks, 1).alias("row_block"), every_anchor)
    # New names for columns: both sides may come from one table.
    right = anchors.select(*[F.col(c).alias(c) for c in anchors.columns], _block(anchor_blocks, 2).alias("anchor_block"), every_row)
    keys = ["row_block", "anchor_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def quantised(vectors: DataFrame, key: str, vector: str, label: str, anchors: Column, scale: int) -> DataFrame:
    """The rows that take part: uid, id, label, anchor, and the vector as whole numbers in doubles."""
    parts = vectors.select(
        F.coalesce(vectors[key].cast("long"), F.lit(int(LAST))).alias("id"),
        vectors[label].cast("long").alias("label"),
        F.transform(vectors[vector], lambda x: x.cast("double")).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    unfit = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    parts = parts.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~unfit)
    whole = F.transform("vector", lambda x: F.floor(x * scale).cast("double"))
    return parts.select(F.monotonically_increasing_id().alias("uid"), "id", "label", "anchor", whole.alias("vector"))


def mine(
    vectors: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on the columns of ``vectors``.
    """
    spark = vectors.sparkSession
    seen = Observation()
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    observed = quantised(vectors, key, vector, label, anchors, scale).observe(
        seen,
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.col("anchor").cast("long")), F.lit(0)).alias("anchors"),
        F.coalesce(F.max(length), F.lit(0.0)).alias("length"),
        F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width"),
    )
    rows = saved(observed, "quantised")
    size = seen.get
    if size["length"] >= 2.0**62:
        raise OverflowError(f"inner products may reach {size['length']}, beyond what a long holds exactly")
    bound = int(size["length"] * (1 + 1e-9)) + 1
    primes = enough_primes(bound)
    kind = "smallint" if bound < 1 << 30 else "bigint"
    # Blocks of bounded size, and at least a tile for each partition of a shuffle.
    block = max(1, VALUES // max(size["width"], 1))
    anchor_blocks = max(1, -(-size["anchors"] // block))
    tiles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(1, -(-size["rows"] // block), -(-tiles // anchor_blocks))

    whole = rows.select("uid", "id", "label", "anchor", F.col("vector").cast(f"array<{kind}>").alias("vector"))
    asking = whole.where("anchor").drop("anchor")
    whole = whole.drop("anchor")

    def first(found: DataFrame, by: list[str], most: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    near = _tiles(whole, asking, row_blocks, anchor_blocks).applyInPandas(
        _best_positives(primes, bound, positives), "anchor long, id long, score long"
    )
    near = saved(first(near, ["anchor"], positives), "positives")
    listed = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("known"))
    asked = asking.join(listed, asking["uid"] == listed["anchor"]).select(
        "uid", "label", "vector", F.col("known.score").alias("positive_scores")
    )
    hard = _tiles(whole, asked, row_blocks, anchor_blocks).applyInPandas(
        _best_negatives(primes, bound, negatives, low, high), "anchor long, place int, id long, score long"
    )
    hard = first(hard, ["anchor", "place"], negatives)
    positive = near.select(
        "anchor", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive"), F.col("score").alias("positive_score")
    )
    named = asking.select(F.col("uid").alias("anchor"), F.col("id").alias("named"))
    joined = hard.join(positive, ["anchor", "place"]).join(named, "anchor")

    def unmarked(name: str, alias: str) -> Column:
        return F.when(F.col(name) != int(LAST), F.col(name)).alias(alias)

    return joined.select(
        unmarked("named", "anchor_id"),
        unmarked("positive", "positive_id"),
        F.col("rank").cast("int").alias("rank"),
        unmarked("id", "negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
