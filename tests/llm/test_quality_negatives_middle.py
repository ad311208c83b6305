"""Quality trees, hard negatives and fill-in-middle against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from askmill.llm import fill_middle, quality_trees, queries, residue_gemm
from pyspark.sql import functions as F

ROWS = "doc_id long, text string"
LONG = "word " * 30_000 + "x" * 200_000 + " end \n"
ODD = [
    (None, None),
    (None, "a b c"),
    (1, None),
    (2, ""),
    (3, " \n "),
    (4, "a b"),
    (4, "a b"),
    (4, "another text of the same id"),
    (5, LONG),
    (6, "ÉK漢字 ß😀 x\x1cy\x85z"),
    (-7, "holds <S> itself"),
    (8, "<"),
    (9, "P> < S> <P"),
]


def frame(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


def clashing(spark):
    """The odd rows between columns named like the operators' own."""
    names = ["text_hash", "part", "place", "chunk", "form", "n", "score", "kept", "features", "back"]
    return frame(spark, ODD).withColumns({name: F.lit(name) for name in names})


# 13: fill-in-middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[n : n + 8], 16) for n in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    output = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return n, form, len(p), len(m), output


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def many_texts():
    rng = random.Random(5)
    marks = ["a", "bc", "é", "漢字", "<", "P>", "<M", " ", "  ", "\n", "\t", " ", "😀"]
    return ODD + [(n, "".join(rng.choices(marks, k=rng.randrange(60)))) for n in range(100, 400)]


@pytest.mark.parametrize("units", [fill_middle.UNITS, 3])
def test_middles_equal_brute_force(spark, monkeypatch, units):
    monkeypatch.setattr(fill_middle, "UNITS", units)
    rows = many_texts()
    want = Counter()
    for doc_id, text in rows:
        n, form, prefix, middle, output = by_hand(doc_id, text)
        want[doc_id, n, form, prefix, middle, sha(output), sha(text)] += 1
    found = fill_middle.digests(frame(spark, rows).repartition(5))
    assert Counter(map(tuple, found.collect())) == want
    assert {form for _, _, form, *_ in want} == {"plain", "spm", "psm"}


def test_outputs_are_whole_and_restore(spark):
    rows = many_texts()
    found = fill_middle.outputs(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.form, r.output) for r in found) == Counter(
        (doc_id, by_hand(doc_id, text)[1], by_hand(doc_id, text)[4]) for doc_id, text in rows
    )
    assert Counter((r.doc_id, fill_middle.restore(r.output, r.form)) for r in found) == Counter(
        (doc_id, text or "") for doc_id, text in rows
    )


def test_middle_pieces_are_bounded_and_shuffled_once(spark):
    cut = fill_middle.pieces(frame(spark, [(n, LONG) for n in range(8)]))
    assert cut.agg(F.max(F.octet_length("chunk"))).head()[0] <= fill_middle.BYTES
    plan = fill_middle.digests(frame(spark, ODD))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and plan.count("Sort ") == 2


def test_middles_of_empty_and_clashing_tables(spark):
    assert fill_middle.digests(frame(spark, [])).count() == 0
    assert fill_middle.outputs(frame(spark, [])).count() == 0
    assert fill_middle.digests(clashing(spark)).count() == len(ODD)


# 12: hard negatives

VECTORS = "vec_id long, embedding array<double>, label int"


def mined_by_hand(rows, positives=5, negatives=5):
    fit = [
        (n, k if k is not None else 1 << 63, [int(np.floor(256 * x)) for x in v], l)
        for n, (k, v, l) in enumerate(rows)
        if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    found = Counter()
    for n, k, v, l in fit:
        if k == 1 << 63 or k % 100:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), other, m, label) for m, other, w, label in fit if m != n
        )
        for score, positive, _, _ in [s for s in scored if s[3] == l][:positives]:
            held = [s for s in scored if s[3] != l and 80 * -score <= 100 * -s[0] <= 100 * -score][:negatives]
            for rank, (other, negative, _, _) in enumerate(held, 1):
                positive_id, negative_id = (x if x < 1 << 63 else None for x in (positive, negative))
                found[k, positive_id, rank, negative_id, -score, -other] += 1
    return found


def mined(spark, rows, schema=VECTORS):
    return Counter(map(tuple, residue_gemm.mine(frame(spark, rows, schema), F.col("vec_id") % 100 == 0).collect()))


def random_rows(seed, count, width, spread):
    rng = np.random.default_rng(seed)
    return [(n * 10, (rng.normal(size=width) * spread).tolist(), int(rng.integers(3))) for n in range(count)]


@pytest.mark.parametrize("width, spread", [(4, 1.0), (70, 1.0), (8, 3000.0), (3, 1e6)])
def test_negatives_equal_brute_force(spark, width, spread):
    rows = random_rows(width, 150, width, spread)
    assert mined(spark, rows) == mined_by_hand(rows)


def test_negatives_with_ties_repeats_and_odd_rows(spark):
    rows = random_rows(1, 40, 3, 1.0)
    rows += [(1000 + n, [0.5, 0.25, 0.125], n % 2) for n in range(60)] + [(1000, [0.5, 0.25, 0.125], 0)] * 2
    rows += [
        (None, [0.5, 0.25, 0.125], 1),
        (2000, None, 1),
        (2100, [0.5, 0.25, 0.125], None),
        (2200, [0.5, None, 0.125], 1),
        (2300, [0.5, float("nan"), 0.125], 1),
        (2400, [0.5, float("inf"), 0.125], 1),
        (2500, [], 1),
        (2600, [0.5], 0),
        (-100, [0.4, 0.3, 0.1], 0),
    ]
    assert mined(spark, rows) == mined_by_hand(rows)


def test_negatives_over_many_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(residue_gemm, "VALUES", 64)
    rows = random_rows(2, 120, 4, 1.0)
    assert mined(spark, rows) == mined_by_hand(rows)


def test_negatives_of_empty_clashing_and_huge_tables(spark):
    assert not mined(spark, [])
    rows = random_rows(3, 60, 4, 1.0)
    wide = frame(spark, rows, VECTORS).withColumns({name: F.lit(1) for name in ("uid", "anchor", "rank", "score", "id", "vector")})
    assert Counter(map(tuple, residue_gemm.mine(wide, F.col("vec_id") % 100 == 0).collect())) == mined_by_hand(rows)
    with pytest.raises(OverflowError):
        residue_gemm.mine(frame(spark, [(100, [1e18, 1.0], 1)], VECTORS), F.col("vec_id") % 100 == 0)


def test_scores_are_exact_to_the_last_bit():
    rng = np.random.default_rng(4)
    for limit in (1, 300, 1 << 20, 1 << 29):
        left, right = (rng.integers(-limit, limit + 1, (20, 9)) for _ in range(2))
        bound = 9 * limit * limit
        primes = residue_gemm.enough_primes(bound)
        others = [residue_gemm.residues(right, p) for p in primes]
        want = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in right] for x in left]
        assert residue_gemm.scores(left, others, primes, bound).tolist() == want
    assert residue_gemm.INNER * (max(residue_gemm.PRIMES) // 2) ** 2 < 1 << 24


# 11: quality rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[n : n + 5]) for n in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {n + k for n, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def quality_rows():
    rng = random.Random(7)
    rows = list(ODD)
    for n in range(100, 300):
        words = rng.choices(["a", "b|", "cé#", "d\n", "e \t", "f\x0b", "g\r\n", "漢", " "], k=rng.randrange(80))
        rows.append((n, " ".join(words) + ("\n" + " ".join(words)) * (n % 3)))
    return rows


def test_quality_counts_equal_brute_force(spark):
    rows = quality_rows()
    trees = quality_trees.fit(np.zeros((0, len(quality_trees.FEATURES))), np.zeros(0))
    found = quality_trees.judge(frame(spark, rows), trees).collect()
    assert Counter((r.doc_id, *(r[name] for name in quality_trees.COUNTS)) for r in found) == Counter(
        (doc_id, *counts_by_hand(text)) for doc_id, text in rows
    )
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)  # untaught trees keep every text


def test_repeated_words_of_texts_with_many_words():
    rng = random.Random(8)
    words = [str(rng.randrange(40_000)) for _ in range(60_000)]
    words[50_000:50_040] = words[100:140]
    text = " ".join(words)
    assert quality_trees.repeated_words(text.encode().split()) == counts_by_hand(text)[4] == 80


def test_trees_learn_and_obey_the_direction():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 3))
    # The label rises with the first feature, although the score may only fall with it.
    good = (x[:, 0] + (x[:, 1] * x[:, 2] > 0) * 2 + rng.normal(size=4000) * 0.3 > 1).astype(float)
    free, bound = quality_trees.fit(x, good), quality_trees.fit(x, good, falling=(0,))
    assert ((free.score(x) >= 0.5) == good).mean() > 0.93
    for other in x[:50]:
        line = np.tile(other, (200, 1))
        line[:, 0] = np.linspace(-4, 4, 200)
        assert (np.diff(bound.score(line)) <= 1e-12).all()
    falling = quality_trees.fit(np.column_stack([-x[:, 0], x[:, 1:]]), good, falling=(0,))
    assert ((falling.score(np.column_stack([-x[:, 0], x[:, 1:]])) >= 0.5) == good).mean() > 0.93


def test_flat_trees_equal_a_walk_over_nodes():
    rng = np.random.default_rng(10)
    x = rng.normal(size=(500, 4))
    trees = quality_trees.fit(x, (x[:, 0] > x[:, 1]).astype(float), trees=20)

    def walk(row):
        total = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x), [walk(row) for row in x])


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    trees = quality_trees.train(docs, labels, queries.held_out())
    found = quality_trees.judge(docs, trees).join(labels, "doc_id").where(queries.held_out()).collect()
    right = sum(r.kept == bool(r.quality) for r in found)
    assert len(found) > 50 and right / len(found) >= 0.9


def test_quality_of_odd_empty_and_clashing_tables(spark):
    labels = frame(spark, [(4, 1), (4, 0), (5, 1), (6, 0), (77, 1), (None, 1), (2, None)], "doc_id long, quality int")
    trees = quality_trees.train(clashing(spark), labels)
    assert quality_trees.judge(clashing(spark), trees).count() == len(ODD)
    empty = frame(spark, [])
    assert quality_trees.judge(empty, quality_trees.train(empty, labels)).count() == 0
    untaught = quality_trees.train(frame(spark, ODD), frame(spark, [], "doc_id long, quality int"))
    assert quality_trees.judge(frame(spark, ODD), untaught).count() == len(ODD)
