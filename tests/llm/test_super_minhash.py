from __future__ import annotations

import random

import numpy as np

from askmill.llm import super_minhash as s
from askmill.llm.components import components

ROWS = "doc_id long, text string"


def brute(rows, percent=85):
    """(n_shingles, component) by doc_id, from all pairs of shingle sets."""

    def shingles(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in words.translate({n: 32 for n in (9, 10, 11, 12, 13)}).split(" ") if w]
        if not words:
            return set()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    sets = [(i, shingles(t)) for i, t in rows]
    name = {i: i for i, _ in sets}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                name[y] = x
    return {i: (len(a), root(i)) for i, a in sets}


def found(spark, rows, percent=85):
    frame = s.group(spark.createDataFrame(rows, ROWS), percent)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def near_copies(rng, start, count, words=120, edits=3):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for n in range(count):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append((start + n, " ".join(text)))
    return out


def test_groups_equal_brute_force(spark):
    rng = random.Random(4)
    rows = near_copies(rng, 0, 60) + near_copies(rng, 100, 40, words=60, edits=2) + near_copies(rng, 200, 8, words=400, edits=12)
    rows += [(300 + n, f"one two three {n % 3}") for n in range(6)]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_a_chain_is_one_component(spark):
    words = [f"w{n}" for n in range(400)]
    rows = [(n, " ".join(words[n * 10 : n * 10 + 200])) for n in range(20)]
    assert found(spark, rows) == brute(rows)
    assert {c for _, c in found(spark, rows).values()} == {0}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "A b"), (5, "a B"), (6, "É x"), (7, "é x"), (8, "a b"), (9, "a b")]
    assert found(spark, rows) == brute(rows)
    repeated = s.group(spark.createDataFrame([(1, "a b c d e f")] * 3 + [(None, "a b c d e f")], ROWS)).collect()
    assert [r.component_id for r in repeated if r.doc_id == 1] == [1, 1, 1]
    assert [r.component_id for r in repeated if r.doc_id is None] == [None]
    assert s.group(spark.createDataFrame([], ROWS)).count() == 0


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 2**63, 170, dtype=np.uint64)
    agree = []
    for _ in range(40):
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 2**63, 15, dtype=np.uint64)])) for _ in range(2))
        x = s.signatures([a, b])
        agree.append((x[0] == x[1]).mean())
    assert abs(np.mean(agree) - 0.85) < 0.03
    tiny = s.signatures([np.array([7], np.uint64), np.array([], np.uint64)])
    assert np.isfinite(tiny[0]).all() and np.isinf(tiny[1]).all()
    assert sorted(np.floor(tiny[0]).astype(int)) == list(range(64))  # one element's ranks are a permutation


def test_components_of_paths_and_stars(spark):
    links = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 130)] + [(200, 201), (201, 200)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component_id for r in rows} == (
        {n: 0 for n in range(41)} | {n: 100 for n in range(100, 130)} | {200: 200, 201: 200}
    )
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
