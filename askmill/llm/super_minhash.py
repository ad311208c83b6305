"""Near-duplicate documents by SuperMinHash signatures, banding, verification and grouping.

SuperMinHash draws for every shingle a random permutation of the signature's places and adds its
rank there to a uniform number; a place keeps the least sum. The ranks of one shingle are correlated
(each place gets another one), which lowers the variance below that of independent hashes, and once
every place of a signature has a sum below j + 1, no later rank can change it: most texts stop
after one or two of the ``PLACES`` steps. The steps run in numpy over all shingles of a batch.

Grouping loses no link that shares a band:

1. Texts with the same shingle set are one class; its node is the smallest doc_id.
2. In every bucket (band and its hash) the member whose buckets are largest in sum is linked
   with the others: a group of copies then meets its centre, not every other copy.
3. Candidates whose signatures agree in less than ``AGREE`` places are dropped (at a similarity of
   0.8 about one in thirty thousand falls below), the others are confirmed on their full sets.
4. Components of the confirmed links. A bucket that still holds several components is compared
   once more on full sets, in pairs of blocks of ``BLOCK`` members, for pairs across components
   whose signatures agree. Products of 0/1 matrices count what their sets share; a block returns a spanning forest of its links, and the components follow.

Words are runs without ASCII white space, A-Z lower-cased; the set of a text is its distinct
five-word shingles, the whole sequence where it has fewer words, and empty without words. Empty
sets link with nothing. Null text is empty. Rows that repeat a doc_id give a row each; a row without
doc_id has no component (null) and is not kept for being one.

With bands of 4 places, 16 of them, two sets of similarity 0.85 miss each other with a chance of
7 in a million, and of 0.8 with 2 in ten thousand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmill.llm.common import by_characters, id_and_text, marked_ids, saved, unmarked_ids
from askmill.llm.components import components

WORDS, PLACES, ROWS, AGREE, BLOCK, BLOCK_SHINGLES = 5, 64, 4, 38, 256, 1 << 20
BANDS = PLACES // ROWS
CHARACTERS = 1 << 21

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word; bytes are split at the six ASCII white space characters only."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolled(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hashes of all runs of ``size`` words, or of the whole sequence if it is shorter."""
    size = min(size, len(words))
    if not size:
        return words
    total = np.full(len(words) - size + 1, np.uint64(size), np.uint64)
    for place in range(size):
        total = mixed(total * np.uint64(0xD6E8FEB86659FD93) + words[place : len(words) - size + 1 + place])
    return total


def shingle_set(text: str, size: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(rolled(word_hashes(text), size))


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """A row of ``places`` sums for each set; infinite for an empty set."""
    found = np.full(len(sets) * places, np.inf)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    state = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    permutation = None
    for step in range(places):
        if not len(state):
            break
        bits = mixed(state + np.uint64(int(_GOLDEN) * (step + 1) % (1 << 64)))
        uniform = (bits >> np.uint64(11)) * 2.0**-53
        place = step + (mixed(bits) % np.uint64(places - step)).astype(np.int64)
        if permutation is None:
            slot = place
        else:
            every = np.arange(len(state))
            slot = permutation[every, place].astype(np.int64)
            permutation[every, place] = permutation[every, step]
            permutation[every, step] = slot
        np.minimum.at(found, owner * places + slot, uniform + step)
        unfinished = found.reshape(-1, places).max(axis=1) >= step + 1
        going = unfinished[owner]
        if permutation is None:
            state, owner, place = state[going], owner[going], place[going]
            permutation = np.tile(np.arange(places, dtype=np.uint8), (len(state), 1))
            every = np.arange(len(state))
            permutation[every, 0], permutation[every, place] = place, 0
        else:
            state, owner, permutation = state[going], owner[going], permutation[going]
    return found.reshape(-1, places)


def _sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = frame["text"].tolist()
        for start, stop in by_characters(texts, CHARACTERS):
            sets = [shingle_set(t) for t in texts[start:stop]]
            whole = mixed(signatures(sets).view(np.uint64))
            bands = np.zeros((len(sets), BANDS), np.uint64)
            for row in range(ROWS):
                bands = mixed(bands * _GOLDEN + whole[:, row::ROWS] + np.arange(BANDS, dtype=np.uint64))
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].iloc[start:stop].to_numpy(),
                    "n_shingles": [len(s) for s in sets],
                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                    "bands": list(bands.view(np.int64)),
                    "marks": [m.tobytes() for m in (whole & np.uint64(0xFF)).astype(np.uint8)],
                }
            )


_SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, marks binary"


def _agreeing(a: str, b: str):
    @F.pandas_udf("int")
    def count(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="int32")
        left = np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1)
        right = np.frombuffer(b"".join(y), np.uint8).reshape(len(y), -1)
        return pd.Series((left == right).sum(axis=1).astype("int32"))

    return count(a, b)


def _alike_in_size(percent: int):
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) of nodes whose full sets are similar enough."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, None
        for frame in frames:
            keep = []
            for text_a, text_b in zip(frame["text_a"], frame["text_b"], strict=True):
                if text_a != last:
                    last, held = text_a, shingle_set(text_a)
                other = shingle_set(text_b)
                both = len(np.intersect1d(held, other, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(held) + len(other) - both))
            yield frame.loc[keep, ["a", "b"]]

    found = pairs.select("a", "b").join(left, "a").join(right, "b").mapInPandas(compare, "a long, b long")
    return saved(found, "confirmed-links")


def group(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept.

    Documents are linked where 100 * intersection >= ``percent`` * union of their sets.
    """
    texts = id_and_text(docs)
    signed = saved(unmarked_ids(marked_ids(texts).mapInPandas(_sign, _SIGNED)), "signatures")
    classes = saved(
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("marks").alias("marks"),
        ),
        "classes",
    )
    keyed = classes.select("node", F.posexplode("bands").alias("band", "hash")).select(
        "node", F.xxhash64("band", "hash").alias("key")
    )
    crowded = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = saved(keyed.join(crowded, "key"), "bucket-members")
    central = members.groupBy("node").agg(F.sum("size").alias("weight"))
    leaders = (
        members.join(central, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("leader"))
    )
    facts = classes.select("node", "n", "marks").dropDuplicates(["node"])
    star = members.join(leaders.select("key", F.col("leader.node").alias("a")), "key")
    star = star.where("a != node").select("a", F.col("node").alias("b")).distinct()
    star = (
        star.join(facts.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("marks").alias("marks_a")), "a")
        .join(facts.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("marks").alias("marks_b")), "b")
        .where(_alike_in_size(percent))
        .where(_agreeing("marks_a", "marks_b") >= AGREE)
    )
    links = _confirmed(star, texts, percent)
    named = components(links)
    more = _across(members, named, classes, texts, percent)
    if not more.isEmpty():
        named = components(links.union(more))
    nodes = classes.select("digest", "node").join(named, "node", "left")
    nodes = nodes.select("digest", F.coalesce("component_id", "node").alias("component_id"))
    return (
        signed.select("doc_id", "n_shingles", "digest")
        .join(nodes, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _across(members: DataFrame, named: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Confirmed links across components within a bucket, compared block by block on full sets.

    A block holds about ``BLOCK`` members or ``BLOCK_SHINGLES`` shingles, whichever is less. Of the links
    found in a pair of blocks only a spanning forest is returned. A pair that shares several
    buckets is compared in the first of its bands only.
    """
    # The one pair of a bucket of two was among the stars.
    named = members.where("size > 2").select("key", "node", "size").join(named, "node", "left")
    named = named.withColumn("name", F.coalesce("component_id", "node"))
    facts = classes.select("node", "n", "bands", "marks").dropDuplicates(["node"])
    named = named.join(facts, "node")
    mixed_up = (
        named.groupBy("key")
        .agg(F.min("name").alias("low"), F.max("name").alias("high"), F.sum("n").alias("total"))
        .where("low != high")
    )
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int")
    held = (
        named.join(mixed_up.select("key", "total"), "key")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
            "block", "node", "name", "n", "bands", "marks",
        )
        .join(texts.select(F.col("doc_id").alias("node"), "text"), "node")
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        # Rows that repeat a doc_id with another text are no members of the class.
        frame = frame.sort_values(["node", "n"]).reset_index(drop=True)
        blocks, names, nodes, sizes = (frame[c].to_numpy() for c in ("block", "name", "node", "n"))
        marks = np.frombuffer(b"".join(frame["marks"]), np.uint8).reshape(len(frame), -1)
        bands = np.array(frame["bands"].tolist(), dtype=np.int64)
        shared_first = _shared_band(bands)
        one, two = frame["one"].iloc[0], frame["two"].iloc[0]
        near = np.zeros((len(frame), len(frame)), bool)
        for n in np.flatnonzero(blocks == one):
            row = (blocks == two) & (names != names[n]) & ((marks == marks[n]).sum(axis=1) >= AGREE)
            row &= 100 * np.minimum(sizes, sizes[n]) >= percent * np.maximum(sizes, sizes[n])
            row &= (bands[:, :shared_first] != bands[n, :shared_first]).all(axis=1)
            if one == two:
                row[: n + 1] = False
            near[n] = row
        rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        used = np.union1d(rows, columns)
        sets = {n: shingle_set(frame["text"].iat[n]) for n in used.tolist()}
        both = _shared_counts([sets[n] for n in rows.tolist()], [sets[n] for n in columns.tolist()])
        lengths = np.zeros(len(frame), np.int64)
        lengths[used] = [len(sets[n]) for n in used.tolist()]
        either = lengths[rows][:, None] + lengths[columns][None, :] - both
        linked = near[np.ix_(rows, columns)] & (both > 0) & (100 * both >= percent * either)

        root = {name: name for name in names.tolist()}

        def top(name: int) -> int:
            while root[name] != name:
                root[name] = name = root[root[name]]
            return name

        found = []
        for n, m in zip(*(part.tolist() for part in np.nonzero(linked)), strict=True):
            n, m = rows[n], columns[m]
            a, b = top(int(names[n])), top(int(names[m]))
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((nodes[n], nodes[m]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return saved(held.groupBy("key", "one", "two").applyInPandas(compare, "a long, b long"), "further-links")


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, as products of 0/1 matrices.

    Only shingles that both lists hold can count; ``width`` of them are multiplied at a time.
    """
    counts = np.zeros((len(left), len(right)), np.int64)
    if not left or not right:
        return counts
    values = [np.concatenate(side) for side in (left, right)]
    owners = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    common = np.intersect1d(*values)
    placed = []
    for value, owner in zip(values, owners, strict=True):
        place = np.searchsorted(common, value)
        hit = common.take(place, mode="clip") == value if len(common) else np.zeros(len(value), bool)
        order = np.argsort(place[hit], kind="stable")
        placed.append((place[hit][order], owner[hit][order]))
    for start in range(0, len(common), width):
        parts = []
        for (place, owner), side in zip(placed, (left, right), strict=True):
            low, high = np.searchsorted(place, [start, start + width])
            part = np.zeros((len(side), width), np.float32)
            part[owner[low:high], place[low:high] - start] = 1
            parts.append(part)
        counts += np.rint(parts[0] @ parts[1].T).astype(np.int64)
    return counts


def _shared_band(bands: np.ndarray) -> int:
    """The band of a bucket: the first in which all its members agree."""
    same = (bands == bands[0]).all(axis=0)
    return int(same.argmax()) if same.any() else 0
