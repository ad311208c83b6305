"""Licence notices by diagonal voting over rolling word k-gram hashes.

Word k-grams of all texts are hashed and joined with the k-gram positions of the licence templates;
those that begin with a word which begins no k-gram of a template cannot hit and are left out. A hit at text word p and template word t votes for the diagonal p - t; hits count only
where the grams themselves are equal, not just their hashes. Votes are summed by diagonal,
diagonals at most ``SLACK`` apart are merged (an inserted or lost word shifts the diagonal). A merged span is
verified by the template places it holds, each counted once however often it was hit, and by its length: with at
least ``COVERAGE`` of the template's grams, in no more words than the template has over ``COVERAGE`` (or ``SLACK``
more), it gives the template's label.
A diagonal with all grams of a template is an exact place of its words.

Words are runs outside the ASCII marks, A-Z lower-cased. Null text is empty: no words, no labels.
Rows that repeat a doc_id are scanned each on its own. The templates are a fixed list of a few
hundred positions, so Spark may broadcast them by its own size check. All expressions run in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from askmill.llm.common import folded, id_and_text, plain_words

GRAM = 3
#: Places of a template are held as the bits of a long.
MOST_GRAMS = 63
SLACK = 2
COVERAGE = 0.8

# The phrases that count as base places, with their labels.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Notices in common use, one or more for each label.
NOTICES = [
    ("agpl-3", "gnu affero general public license version 3"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("artistic-2", "the artistic license 2 0"),
    ("boost-1", "distributed under the boost software license version 1 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "dedicated to the public domain under the cc0 1 0 universal"),
    ("epl-2", "made available under the terms of the eclipse public license 2 0"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl-3", "gnu lesser general public license version 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def template_positions(spark: SparkSession, base=None, notices=None, gram: int = GRAM) -> DataFrame:
    """One row for each k-gram position of each template: its gram and hash."""
    rows = []
    known = [(True, *x) for x in (BASE if base is None else base)]
    known += [(False, *x) for x in (NOTICES if notices is None else notices)]
    for number, (is_base, label, text) in enumerate(known):
        words = text.split()
        if not gram <= len(words) < gram + MOST_GRAMS:
            raise ValueError(f"a template has fewer than {gram} words or more than {MOST_GRAMS} grams: {text}")
        for place in range(len(words) - gram + 1):
            rows.append((number, is_base, label, len(words) - gram + 1, place, " ".join(words[place : place + gram])))
    frame = spark.createDataFrame(
        rows, "template int, is_base boolean, label string, grams int, t_place int, t_gram string"
    )
    return frame.withColumn("gram_hash", F.xxhash64(*(F.get(F.split("t_gram", " "), F.lit(n)) for n in range(gram))))


def first_words(base=None, notices=None, gram: int = GRAM) -> list[str]:
    """The words that begin a k-gram of a template."""
    texts = [text.split() for _, text in (BASE if base is None else base) + (NOTICES if notices is None else notices)]
    return sorted({word for words in texts for word in words[: len(words) - gram + 1]})


def scan(docs: DataFrame, base=None, notices=None, gram: int = GRAM, coverage: float = COVERAGE) -> DataFrame:
    """One row per document: words, base places, labels and the best coverage of a template.

    Columns: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and
    spans, an array of (label, start, stop, coverage) of the spans that gave labels.
    """
    templates = template_positions(docs.sparkSession, base, notices, gram)
    known = first_words(base, notices, gram)
    words = id_and_text(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", plain_words(folded(F.col("text"))).alias("words")
    )

    def rolled(word: Column, i: Column) -> Column:
        """Where a k-gram can be a template's by its first word: its place, hash and words."""
        gram_words = [word, *(F.get(F.col("words"), i + n) for n in range(1, gram))]
        return F.when(
            word.isin(known),
            F.struct(i.alias("place"), F.xxhash64(*gram_words).alias("gram_hash"), F.concat_ws(" ", *gram_words).alias("gram")),
        )

    # The outer form: the plain one also filters on the array's size, which would roll it twice.
    grams = words.select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.explode_outer(F.filter(F.transform("words", rolled), lambda g: g.isNotNull())).alias("rolled"),
    ).select("row", "doc_id", "n_words", "rolled.*")
    hit = F.col("gram") == F.col("t_gram")
    votes = (
        grams.join(templates.select("gram_hash", "t_gram", "t_place", "template"), "gram_hash", "left")
        .groupBy(
            "row",
            F.when(hit, F.col("template")).alias("template"),
            F.when(hit, F.col("place") - F.col("t_place")).alias("diagonal"),
        )
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.count(F.when(hit, 1)).alias("votes"),
            F.bit_or(F.when(hit, F.expr("shiftleft(1L, t_place)"))).alias("held"),
            F.min(F.when(hit, F.col("place"))).alias("start"),
            F.max(F.when(hit, F.col("place") + gram)).alias("stop"),
        )
        .join(templates.select("template", "is_base", "label", "grams").distinct(), "template", "left")
    )
    ordered = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered) > SLACK, F.lit(True))
    bands = (
        votes.withColumn("band", F.sum(apart.cast("int")).over(ordered))
        .withColumn("whole", F.col("is_base") & (F.col("votes") == F.col("grams")))
        .groupBy("row", "template", "is_base", "label", "grams", "band")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.count(F.when(F.col("whole"), 1)).alias("places"),
            F.min(F.when(F.col("whole"), F.col("diagonal"))).alias("first"),
            F.max(F.when(F.col("whole"), F.col("diagonal"))).alias("last"),
            F.bit_count(F.bit_or("held")).alias("held"),
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
        )
        .withColumn("t_words", F.col("grams") + gram - 1)
        .withColumn("most", F.greatest(F.floor(F.col("t_words") / coverage), F.col("t_words") + SLACK))
        .withColumn(
            "covered",
            # A base phrase is short: only all of its words in a row count, never a merged part.
            F.when(F.col("is_base"), (F.col("places") > 0).cast("double")).when(
                F.col("template").isNotNull() & (F.col("stop") - F.col("start") <= F.col("most")),
                F.col("held") / F.col("grams"),
            ),
        )
        .withColumn("found", F.coalesce(F.col("covered") >= coverage, F.lit(False)))
    )

    def joined(keep: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(keep, F.col("label")))), ",")

    return (
        bands.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.coalesce(F.sum("places"), F.lit(0)).cast("long").alias("n_base"),
            F.min("first").cast("long").alias("first_word"),
            F.max("last").cast("long").alias("last_word"),
            joined(F.col("places") > 0).alias("base_labels"),
            joined(F.col("found")).alias("labels"),
            F.coalesce(F.max("covered"), F.lit(0.0)).alias("score"),
            F.array_sort(
                F.collect_list(F.when(F.col("found"), F.struct("label", "start", "stop", "covered")))
            ).alias("spans"),
        )
        .drop("row")
    )
