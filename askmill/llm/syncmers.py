"""Document fingerprints from closed syncmers.

A text is read as units: words in lower case (runs outside the ASCII marks), and of words longer than
``LONG`` the pieces of ``UNIT`` characters from the word's start. A k-mer of ``K`` units
is a closed syncmer where the least of its inner s-mers (``S`` units, ordered by hash) is the first
or the last one. Whether a k-mer is chosen depends on its own units alone, so an edit elsewhere
moves no anchor: anchors are (position, hash) pairs that equal passages share at any offset.

The fingerprint is the sorted ``SIZE`` smallest distinct 32-bit anchor hashes as hexadecimal text,
a bottom-k sketch of bounded size. Texts of fewer than ``K`` units have each unit as an anchor;
texts without units have an empty fingerprint. Equal texts have equal fingerprints. The likeness
of two is the share of the smallest ``SIZE`` hashes of both that both hold, an estimate of the
Jaccard similarity of the anchor sets; if both are empty it is 1, if one is, 0.

All expressions run in the JVM and work on one row; nothing is shuffled here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askmill.llm.common import id_and_text, plain_words, saved

UNIT, K, S, SIZE = 8, 4, 2, 64
NO_ID = -(1 << 63)
LONG = 24


def units(frame: DataFrame, text: str, name: str) -> DataFrame:
    """Add the array of the text's units; words of more than ``LONG`` characters are cut by ``UNIT``."""
    frame = frame.withColumn(name, plain_words(F.lower(F.col(text))))

    def cut(word: Column) -> Column:
        pieces = F.transform(
            F.sequence(F.lit(0), F.floor((F.length(word) - 1) / UNIT).cast("int")), lambda n: F.substring(word, n * UNIT + 1, F.lit(UNIT))
        )
        return F.when(F.length(word) <= LONG, F.array(word)).otherwise(pieces)

    has_long = F.exists(name, lambda word: F.length(word) > LONG)
    return frame.withColumn(name, F.when(has_long, F.flatten(F.transform(name, cut))).otherwise(F.col(name)))


def _fingerprint(frame: DataFrame, text: str, name: str) -> DataFrame:
    """Add array columns for one text: unit hashes, then s-mer hashes, then anchors, then the sketch."""
    hashes, inner = f"_{name}_h", f"_{name}_s"
    frame = units(frame, text, hashes).withColumn(hashes, F.transform(hashes, lambda u: F.xxhash64(u)))
    # S = 2: an s-mer is a pair of neighbouring units.
    frame = frame.withColumn(
        inner, F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(F.col(hashes), i + 1)))
    )
    last = K - S

    def chosen(s: Column, i: Column) -> Column:
        """The anchor of the k-mer that begins at unit i, or null; s is its first s-mer's hash."""
        ends = F.get(F.col(inner), i + last)
        within = [F.get(F.col(inner), i + n) for n in range(1, last)]
        low = F.least(s, ends)
        is_edge = low <= F.least(*within) if len(within) > 1 else low <= within[0]
        return F.when(is_edge & (i <= F.size(hashes) - K), F.hash(s, ends))

    few = F.transform(hashes, lambda h: F.hash(h))
    anchors = F.when(F.size(hashes) < K, few).otherwise(F.transform(inner, chosen))
    return frame.withColumn(name, anchors).drop(hashes, inner)


def _sketch(anchors: Column, size: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(F.filter(anchors, lambda a: a.isNotNull()))), 1, size)


def anchors(docs: DataFrame) -> DataFrame:
    """doc_id, and the array of (position, hash) anchors of its text in order of position."""
    frame = _fingerprint(id_and_text(docs), "text", "found")
    placed = F.transform("found", lambda a, i: F.struct(i.alias("position"), a.alias("hash")))
    return frame.select("doc_id", F.filter(placed, lambda a: a["hash"].isNotNull()).alias("anchors"))


def with_sketch(frame: DataFrame, text: str, name: str, size: int = SIZE) -> DataFrame:
    """Add ``name``: the sorted array of the text's smallest anchor hashes."""
    return _fingerprint(frame, text, name).withColumn(name, _sketch(F.col(name), size))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0"))), "")


def likeness(a: Column, b: Column, size: int = SIZE) -> Column:
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), least))
    return F.when(F.size(least) == 0, 1.0).otherwise(shared / F.size(least))


def neighbours(docs: DataFrame) -> DataFrame:
    """For each doc_id, the ids before and after it in ascending order and the length before it.

    After the last comes the first. Ids are range-sorted and each partition looks in itself; its
    ends take their neighbours from a table of one row per partition.
    """
    ids = docs.groupBy("doc_id").agg(F.min(F.length("text")).alias("n"))
    dealt = saved(
        ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "document-order"
    )
    ends = dealt.groupBy("part").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.max_by("n", "doc_id").alias("last_n")
    )
    by_part, all_parts = Window.orderBy("part"), Window.partitionBy()
    ends = ends.select(
        "part",
        F.coalesce(F.lead("first_id").over(by_part), F.min("first_id").over(all_parts)).alias("first_after"),
        F.coalesce(F.lag("last_id").over(by_part), F.max("last_id").over(all_parts)).alias("last_before"),
        F.coalesce(F.lag("last_n").over(by_part), F.max_by("last_n", "part").over(all_parts)).alias("n_before"),
    )
    inside = Window.partitionBy("part").orderBy("doc_id")
    return (
        dealt.withColumns(
            {c: f.over(inside) for c, f in (("a", F.lead("doc_id")), ("b", F.lag("doc_id")), ("c", F.lag("n")))}
        )
        .join(ends, "part")
        .select(
            "doc_id",
            F.coalesce("a", "first_after").alias("next_id"),
            F.coalesce("b", "last_before").alias("before_id"),
            F.coalesce("c", "n_before").alias("before_n"),
        )
    )


def compare_edits(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Fingerprint every document and its edited text, and compare them and the next document.

    The edited text has the last floor(n_chars / 4) characters replaced by the first as many (or
    all) of the next document's. Rows that repeat a doc_id count as one document with the shortest,
    then least of their texts; a null doc_id is one document before all others. Texts are shuffled
    once by doc_id, their heads once to the document before; sketches are of bounded size.
    """
    texts = id_and_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    around = neighbours(texts)
    one = (
        texts.groupBy("doc_id")
        .agg(F.min(F.struct(F.length("text").alias("n"), "text")).alias("one"))
        .select("doc_id", "one.*")
    )
    heads = one.join(around, "doc_id").select(
        F.col("before_id").alias("doc_id"),
        F.col("doc_id").alias("next_id"),
        F.expr("left(text, cast(before_n div 4 as int))").alias("head"),
    )
    edited = one.join(heads, "doc_id").select(
        "doc_id",
        "next_id",
        F.col("n").cast("long").alias("n_chars"),
        "text",
        F.concat(F.expr("left(text, cast(n - n div 4 as int))"), "head").alias("edited"),
    )
    marked = with_sketch(with_sketch(edited, "text", "own", size), "edited", "other", size)
    marked = saved(
        marked.select(
            "doc_id", "next_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "own", "other"
        ),
        "fingerprints",
    )
    following = marked.select(F.col("doc_id").alias("next_id"), F.col("own").alias("following"))
    return marked.join(following, "next_id").select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), size).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), size).alias("near_next"),
    )
