"""Each operator against brute force, and on odd rows: null, empty, long, repeated, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from askmill.llm import (
    compact_windows,
    edit_pigeonhole,
    jump_shards,
    license_scan,
    piece_codec,
    queries,
    syncmers,
    token_files,
    toxicity,
    url_trie,
)
from pyspark.sql import functions as F

ROWS = "doc_id long, text string"
ODD = [(None, None), (1, None), (2, ""), (3, " \n "), (4, "a"), (4, "a"), (5, "x " * 3000), (6, "É\u212a漢字 ß😀"), (-7, "z")]


def frame(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


# 1: toxicity

def test_toxicity_learns_and_scores_all_rows(spark):
    rng = random.Random(1)
    rows, marks = [], []
    for n in range(400):
        words = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(30)]
        toxic = n % 8 == 0
        rows.append((n, " ".join(words + ["vile"] * toxic)))
        if n % 2 == 0:
            marks.append((n, int(toxic)))
    docs = frame(spark, rows)
    model = toxicity.train(docs, frame(spark, marks, "doc_id long, toxic int"), queries.held_out())
    scored = {r.doc_id: r.score for r in toxicity.with_score(docs, model).collect()}
    assert len(scored) == 400
    assert all((scored[n] >= 0.3) == (n % 8 == 0) for n in scored)
    odd = toxicity.with_score(frame(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)


def test_toxicity_without_positives(spark):
    model = toxicity.train(frame(spark, ODD), frame(spark, [], "doc_id long, toxic int"))
    assert model.weights == {} and model.score("x") < 0.01


# 2: licences

def places(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = []
    for label, phrase in license_scan.BASE:
        parts = phrase.split()
        found += [(n, label) for n in range(len(words)) if words[n : n + len(parts)] == parts]
    starts = [n for n, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})))


def test_license_base_places_equal_brute_force(spark):
    rng = random.Random(2)
    pool = "under the mit license apache version 2 cc by nc MIT Licen\u212ae gnu general public 3".split()
    rows = ODD + [(100 + n, " ".join(rng.choice(pool) for _ in range(60))) for n in range(60)]
    rows += [(300, "CC BY-NC, cc by nc. Under the MIT License! Apache License, Version 2.0")]
    docs = frame(spark, [(*r, "clash", 9) for r in rows], ROWS + ", words string, row int")
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan.scan(docs).collect())
    want = sorted((str(i), *places(t)) for i, t in rows)
    assert [tuple(map(str, x)) for x in got] == [tuple(map(str, x)) for x in want]


def test_license_diagonals_bridge_an_inserted_word(spark):
    text = "intro permission is hereby granted free of any charge to any person obtaining a copy of this software and associated documentation files end"
    row = license_scan.scan(frame(spark, [(1, text), (2, "gnu general public license version 3")])).orderBy("doc_id").collect()
    assert [r.labels for r in row] == ["mit", "gpl-3"] and 0.8 <= row[0].score < 1 and row[0].n_base == 0
    assert license_scan.scan(frame(spark, [])).count() == 0


def test_license_spans_hold_distinct_places_in_order(spark):
    stutter = "the gnu affero gnu affero general affero general public general public license public license version license version 3"
    texts = [
        (1, stutter),
        (2, "gnu affero general public license version 3"),
        (3, "gnu affero general public big license version 3"),
        (4, "gnu affero general gnu affero general gnu affero general gnu affero general gnu affero general"),
    ]
    found = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(frame(spark, texts)).collect()}
    assert found[1][0] == "" and found[2] == ("agpl-3", 1.0) and found[4][0] == "" and found[4][1] < 0.5
    with pytest.raises(ValueError, match="grams"):
        license_scan.template_positions(spark, [], [("x", "word " * 80)])


# 3: token files

def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("word_bpe_49k.json")
    rows = ODD + [(50 + n, f"Don't stop {n} naïve ÉÈ <|endoftext|> Σ-x²") for n in range(20)]
    manifest = token_files.write(frame(spark, rows), str(tmp_path / "ids"), path, 2)
    got = token_files.read(manifest).collect()
    library = Tokenizer.from_file(path)
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    assert len(got) == len(rows)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        ids = np.frombuffer(r.tokens, "<u4").tolist()
        assert r.start == start and r.n_tokens == len(ids) and ids in want[r.doc_id]
        start += len(ids)
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert token_files.read(token_files.write(frame(spark, []), str(tmp_path / "none"), path, 2)).count() == 0


# 4: shards

def jump(key, shards):
    key, b, j = key % (1 << 64), -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_shards_equal_the_published_loop(spark):
    rng = random.Random(3)
    keys = [0, 1, -1, 2**63 - 1, -(2**63)] + [rng.randrange(-(2**63), 2**63) for _ in range(300)] + [5] * 200
    dealt = jump_shards.shard(frame(spark, [(k, "x") for k in keys] + [(None, None)]), 40)
    rows = jump_shards.number_slots(dealt, ["doc_id", "text"]).collect()
    for r in rows:
        assert (r.shard, r.grown_shard) == (jump(r.doc_id or 0, 40), jump(r.doc_id or 0, 41))
        assert r.grown_shard in (r.shard, 40)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


# 6: syncmers

def test_syncmer_edits_and_odd_rows(spark):
    rng = random.Random(5)
    rows = [(n * 3, " ".join(f"w{rng.randrange(5000)}" for _ in range(80))) for n in range(30)]
    rows += [(200, None), (201, ""), (202, "漢字" * 40), (203, rows[0][1]), (204, "short one")]
    got = {r.doc_id: r for r in syncmers.compare_edits(frame(spark, rows)).collect()}
    order = sorted(rows)
    for (i, t), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        t, following = t or "", following or ""
        n = len(t) // 4
        edited = t[: len(t) - n] + following[:n]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert got[203].fingerprint == got[0].fingerprint
    prose = [got[n * 3] for n in range(29)]
    assert all(r.near_edited > 0.3 > r.near_next for r in prose)
    assert syncmers.compare_edits(frame(spark, ODD)).count() == 8  # one row for each doc_id
    assert syncmers.compare_edits(frame(spark, [])).count() == 0


def test_syncmer_anchors_do_not_depend_on_what_surrounds_them(spark):
    rng = random.Random(6)
    core = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    rows = [(1, core), (2, "other words before " + core + " and after")]
    one, two = (dict((a.hash, a.position) for a in r.anchors) for r in syncmers.anchors(frame(spark, rows)).orderBy("doc_id").collect())
    assert one and all(two[h] == p + 3 for h, p in one.items())


# 7: compact windows

def test_windows_hold_every_stretch_once():
    rng = np.random.default_rng(1)
    for size in (5, 40, 200):
        hashes = rng.integers(0, 60, size, dtype=np.uint64)
        nodes = compact_windows.compact_windows(hashes, 5)
        for i in range(size):
            for j in range(i + 5, size + 1):
                own = [(c, l, r) for c, l, r in nodes if l <= i <= c < j <= r]
                assert len(own) == 1 and hashes[own[0][0]] == hashes[i:j].min()


def test_repeated_passages_are_found_and_cut(spark):
    rng = random.Random(7)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared, bent = words(60), words(120)
    changed = bent[:50] + ["new"] + bent[51:]
    rows = [(n, " ".join(words(40) + shared + words(30))) for n in range(12)]
    rows += [(20, " ".join(words(20) + bent + words(20))), (21, " ".join(changed)), (22, " ".join(words(10) + shared[:30] + words(200)))]
    docs = frame(spark, rows)
    found = compact_windows.repeated(docs).collect()
    assert {(r.doc_id, r.start, r.stop) for r in found if r.doc_id < 20} == {(n, 40, 100) for n in range(1, 12)}
    assert {r.doc_id for r in found if r.source_id == 0 and r.doc_id < 20} == set(range(1, 12))
    assert [(r.source_id, r.start, r.stop) for r in found if r.doc_id == 21] == [(20, 0, 120)]
    assert not [r for r in found if r.doc_id in (0, 20, 22)]
    cut = {r.doc_id: r.text.split() for r in compact_windows.without_passages(docs, compact_windows.repeated(docs)).collect()}
    assert len(cut[0]) == 130 and len(cut[5]) == 70 and cut[21] == [] and len(cut[22]) == 240
    assert compact_windows.repeated(frame(spark, ODD)).count() == 0
    assert compact_windows.without_passages(frame(spark, ODD), compact_windows.repeated(frame(spark, ODD))).count() == len(ODD)
    assert compact_windows.repeated(frame(spark, [])).count() == 0


def test_texts_of_one_doc_id_are_cut_apart_and_names_may_clash(spark):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared = words(70)
    rows = [(1, " ".join(shared)), (2, " ".join(words(300) + shared)), (2, "short"), (2, " ".join(shared + words(5))), (2, None)]
    docs = frame(spark, rows).withColumns({name: F.lit("x") for name in ("_spans", "_doc_id", "_text_hash", "key", "a")})
    found = compact_windows.repeated(docs)
    assert {(r.doc_id, r.start, r.stop) for r in found.collect()} == {(2, 300, 370), (2, 0, 70)}
    cut = compact_windows.without_passages(docs, found)
    assert cut.columns == docs.columns
    left = sorted(len((r.text or "").split()) for r in cut.collect())
    assert left == [0, 1, 5, 70, 300]


def test_copies_are_combined_before_the_shuffle(spark):
    """Windows of many copies leave their task as one window and narrow rows that go by document."""
    rng = random.Random(9)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(400))
    docs = frame(spark, [(n, text) for n in range(50)] + [(99, "a b c")]).coalesce(1)
    names = "key long, doc_id long, place long, head_id long, head_place long, around binary"
    rows = docs.mapInArrow(compact_windows._windows, names).collect()
    whole = [r for r in rows if r.around]
    assert whole and {r.doc_id for r in whole} == {0} and len(rows) == 50 * len(whole)
    assert all(r.head_id == 0 and r.place == r.head_place for r in rows if not r.around)
    found = compact_windows.repeated(docs).collect()
    assert {(r.doc_id, r.source_id, r.start, r.stop) for r in found} == {(n, 0, 0, 400) for n in range(1, 50)}


def test_many_classes_of_one_shingle_without_a_shared_stretch():
    rng = np.random.default_rng(3)
    marks = rng.integers(1, 256, (200, 2 * compact_windows.SIDE)).astype(np.uint8)
    assert compact_windows._by_ends(np.arange(200), marks).shape == (0, 2)
    # The same stretch in many classes: each has a partner before it, whichever the surroundings.
    marks[:, 20:80] = marks[0, 20:80]
    found = compact_windows._by_ends(np.arange(200), marks)
    assert set(found[:, 1]) == set(range(1, 200)) and (found[:, 0] < found[:, 1]).all()


def met_and_verified(texts):
    """(a, b) of the texts whose windows meet and hold a passage."""
    rows, arounds = [], []
    for n, text in enumerate(texts):
        key, place, around = compact_windows.window_rows(text)
        rows.append(np.stack([key, np.full(len(key), n), place], axis=1))
        arounds.append(around)
    rows, around = np.concatenate(rows), np.concatenate(arounds)
    order = np.lexsort(rows.T[::-1])
    rows, around = rows[order], around[order]
    met = {}
    for a, b in compact_windows.partners(rows, around):
        met.setdefault((rows[a, 1], rows[b, 1]), set()).add(int(rows[b, 2] - rows[a, 2]))
    sets = [compact_windows.rolled(compact_windows.word_hashes(t)) for t in texts]
    return {(a, b) for (a, b), lines in met.items() if compact_windows.passages(sets[a], sets[b], lines)}


def test_later_holders_behind_a_hot_line_or_variants_meet(spark):
    rng = random.Random(17)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    join = lambda *parts: " ".join(sum(parts, []))
    rows, pairs = [], set()
    for size in (50, 52, 56):
        for before in range(0, size - 47):
            line = words(48)
            whole = words(before) + line + words(size - 48 - before)
            texts = [join(words(40), line, words(40)) for _ in range(30)]
            texts += [join(words(20), whole, words(40)), join(words(40), whole, words(20))]
            assert met_and_verified(texts) == {(30, 31)}
            pairs.add((len(rows) + 30, len(rows) + 31))
            rows += [(len(rows) + n, text) for n, text in enumerate(texts)]
    assert {(r.source_id, r.doc_id) for r in compact_windows.repeated(frame(spark, rows)).collect()} == pairs
    for _ in range(10):
        whole, texts = words(52), []
        for _ in range(60):
            variant = list(whole)
            for place in rng.sample(range(52), 3):
                variant[place] = f"q{rng.randrange(10**6)}"
            texts.append(join(words(40), variant, words(40)))
        changed = whole[:26] + ["new"] + whole[27:]
        texts += [join(words(20), whole, words(40)), join(words(40), changed, words(20))]
        assert 61 in {b for _, b in met_and_verified(texts)}


def test_short_passages_with_one_change_are_found_as_by_brute_force():
    rng = random.Random(27)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    missed, held = [], 0
    for size in (50, 51, 52, 55, 60):
        for n in range(60):
            whole = words(size)
            place = size // 2 + rng.randrange(-4, 5)
            changed = whole[:place] + ["new"][: n % 3 != 1] + whole[place + (n % 3 > 0) :]
            texts = [" ".join(words(40) + whole + words(30)), " ".join(words(17) + changed + words(50))]
            a, b = (compact_windows.rolled(compact_windows.word_hashes(t)) for t in texts)
            if compact_windows.passages(a, b, range(-len(a), len(b))):
                held += 1
                missed += [(size, n)] * (met_and_verified(texts) != {(0, 1)})
    assert held >= 280 and not missed


def test_every_link_between_some_variants_of_a_passage_is_found():
    rng = random.Random(31)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    whole, texts = words(60), []
    for n in range(24):
        changed = list(whole)
        changed[n % 3] = changed[-1 - n % 5] = f"q{n}"
        texts.append(" ".join(words(40) + changed + words(40)))
    sets = [compact_windows.rolled(compact_windows.word_hashes(t)) for t in texts]
    every = {(a, b) for b in range(24) for a in range(b) if compact_windows.passages(sets[a], sets[b], [0])}
    assert len(every) > 200 and met_and_verified(texts) == every


def variants(rng, count):
    """Texts that hold a passage with two changes each, and what brute force finds in them."""
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    whole, line, texts = words(60), words(26), []
    for n in range(count):
        changed = list(whole)
        changed[n % 3] = changed[-1 - n % 5] = f"q{n}"
        texts.append(" ".join(words(40) + changed + words(40) + line + words(30)))
    sets = [compact_windows.rolled(compact_windows.word_hashes(t)) for t in texts]
    return texts, {(a, b) for b in range(count) for a in range(b) if compact_windows.passages(sets[a], sets[b], [0])}


def test_every_link_between_many_variants_of_a_passage_is_found(spark):
    texts, every = variants(random.Random(32), 120)
    assert len(every) > 5000 and met_and_verified(texts) == every
    found = compact_windows.repeated(frame(spark, list(enumerate(texts)))).collect()
    assert {(r.source_id, r.doc_id) for r in found} == every


def test_all_fitting_pairs_of_many_classes_as_one_by_one():
    rng = np.random.default_rng(4)
    marks = rng.integers(0, 256, (300, 2 * compact_windows.SIDE)).astype(np.uint8)
    docs = np.sort(rng.integers(0, 200, 300))
    for n in range(1, 300):
        start, stop = rng.integers(0, 60), rng.integers(60, 92)
        marks[n, start:stop] = np.roll(marks[rng.integers(0, n)], rng.integers(-2, 3))[start:stop]
    late, early = np.tril_indices(300, -1)
    same = marks[early] == marks[late]
    for n in (1, 2):
        same[:, n:] |= marks[early][:, :-n] == marks[late][:, n:]
        same[:, :-n] |= marks[early][:, n:] == marks[late][:, :-n]
    same &= marks[late] != 0
    most = np.max([same[:, s : s + compact_windows.LEAST].sum(axis=1) for s in range(1, compact_windows.SIDE + 1)], axis=0)
    fits = (most >= compact_windows.AGREE) & (docs[early] != docs[late])
    assert fits.sum() > 300
    assert sorted(map(tuple, compact_windows._by_ends(docs, marks).tolist())) == sorted(zip(early[fits].tolist(), late[fits].tolist()))


def test_classes_of_a_common_shingle_are_dealt_in_blocks(monkeypatch):
    """Blocks compared by other tasks give the pairs that one task gives, with the copies a document holds itself."""
    rng = random.Random(33)
    texts, _ = variants(rng, 100)
    texts += [f"{texts[3]} {texts[3]}", f"{texts[70]} {texts[70]}", texts[5]]
    table = compact_windows.pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    # Not combined: copies are met as in different tasks.
    windows = compact_windows.pa.Table.from_batches(
        batch for n in range(len(texts)) for batch in compact_windows._windows([table.slice(n, 1)])
    ).sort_by([("key", "ascending"), ("doc_id", "ascending"), ("place", "ascending")])
    batches = windows.combine_chunks().to_batches(max_chunksize=77)

    def triples(rows):
        found = set()
        for row in rows:
            a, b, diagonal = (x.view(np.int64) for x in compact_windows._unpacked(row["data"]))
            a, b = np.cumsum(a), np.cumsum(b)
            assert set(row["docs"]) == set(a.tolist()) | set(b.tolist())
            found |= set(zip(a.tolist(), b.tolist(), diagonal.tolist()))
        return found

    as_rows = lambda found: [row for batch in found for row in batch.to_pylist()]
    whole = as_rows(compact_windows._meet(iter(batches), 3))
    assert all(row["part"] >= 0 for row in whole)
    monkeypatch.setattr(compact_windows, "BLOCK", 16)
    monkeypatch.setattr(compact_windows, "TOGETHER", 100)
    met = as_rows(compact_windows._meet(iter(batches), 3))
    dealt = [row for row in met if row["part"] < 0]
    assert len(dealt) > 20
    batch = compact_windows.pa.RecordBatch.from_pylist(dealt, schema=compact_windows._MET)
    met = [row for row in met if row["part"] >= 0] + as_rows(compact_windows._compare(iter([batch]), 3))
    assert triples(met) == triples(whole)


def test_passages_of_many_pairs_are_those_of_each():
    rng = random.Random(34)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    whole, texts = words(70), []
    for n in range(30):
        changed = list(whole)
        for _ in range(n % 4):
            changed[rng.randrange(70)] = f"q{n}"
        more = ["of"] * rng.randrange(40, 90) + words(5) + ["is", "on"] * 30
        texts.append((n // 2 if n < 10 else n, n, " ".join(words(n % 7) + changed + more[: 50 * (n % 5)])))
    texts += [(7, 7, "short"), (8, 8, "")]
    met = sorted({(a, b, d) for b in range(30) for a in range(b) for d in (rng.randrange(-9, 9), rng.randrange(-99, 99))})
    met = sorted({*met, *((a, b, d) for a in (1, 12, 13) for b in (14, 18, 19, 24) for d in range(-80, 80, rng.choice((3, 7))))})
    ids = {t[0] for t in texts}
    a, b, diagonal = np.array([m for m in met if m[0] in ids and m[1] in ids]).T
    found = [tuple(row.values()) for batch in compact_windows._Texts(texts).verified(a, b, diagonal) for row in batch.to_pylist()]
    want = set()
    hashes = lambda text: compact_windows.rolled(compact_windows.word_hashes(text))
    for one, two in {(x, y) for x, y, _ in met if x in ids and y in ids}:
        lines = [d for x, y, d in met if (x, y) == (one, two)]
        for _, _, text in (t for t in texts if t[0] == one):
            for _, text_hash, other in (t for t in texts if t[0] == two):
                want |= {(two, text_hash, one, *p) for p in compact_windows.passages(hashes(text), hashes(other), lines)}
    assert len(found) == len(set(found)) > 100 and set(found) == want
    same = [(n, n, "of " * 500) for n in (1, 2)]
    a, b, diagonal = np.array([(1, 2, d) for d in range(-99, 99)]).T
    found = [row for batch in compact_windows._Texts(same).verified(a, b, diagonal) for row in batch.to_pylist()]
    text = hashes(same[0][2])
    assert [(r["start"], r["stop"], r["source_start"], r["source_stop"], r["similarity"]) for r in found] == compact_windows.passages(text, text, range(-99, 99))


# 8: pieces

def test_pieces_equal_sentencepiece_on_whole_texts(spark):
    import sentencepiece

    path = queries.tokenizer_file("piece_bpe_32k.model")
    peer = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = ODD + [(20, "  a  b "), (21, "\n\tx\x00"), (22, "▁ a▁b"), (23, "<s> <unk> <0x0A>"), (24, " "), (25, "e\u0301")]
    for r in piece_codec.encode(frame(spark, rows), path).collect():
        texts = [t or "" for i, t in rows if i == r.doc_id]
        assert np.frombuffer(r.tokens, "<u4").tolist() in peer.encode(texts)
        assert r.parity and r.decoded in peer.decode(peer.encode(texts))
    assert piece_codec.encode(frame(spark, []), path).count() == 0


def test_joined_bytes_decode_like_the_library():
    codec = piece_codec.codec(queries.tokenizer_file("piece_bpe_32k.model"))
    rng = np.random.default_rng(5)
    lists = [rng.integers(0, len(codec.spelled), n % 9).tolist() for n in range(600)]
    lists += [rng.integers(3, 259, n % 7).tolist() for n in range(600)]
    assert codec.decode(lists) == codec.tokenizer.decode_batch(lists, skip_special_tokens=False)


def test_chunks_are_encoded_some_at_a_time():
    codec = piece_codec.codec(queries.tokenizer_file("piece_bpe_32k.model"))
    tokenizer, met = codec.tokenizer, []

    class Counted:
        def encode_batch_fast(self, chunks, **options):
            met.append(len(chunks))
            return tokenizer.encode_batch_fast(chunks, **options)

    codec.tokenizer = Counted()
    text = " ".join(f"w{n}x{n * 7919 % 10007}" for n in range(9000))
    tokens, parity = codec.encode([text, "", text])
    assert sum(met) == 9000 and max(met) <= 2048
    assert np.frombuffer(tokens[0], "<u4").tolist() == codec.peer.encode(text) and tokens[::2] == [tokens[0]] * 2
    assert tokens[1] == b"" and parity == [True] * 3


def test_a_worker_keeps_no_codec_for_other_tasks(spark):
    path = queries.tokenizer_file("piece_bpe_32k.model")

    def held(frames):
        import gc

        gc.collect()
        for rows in frames:
            yield rows.assign(id=sum(type(x).__name__ == "Codec" for x in gc.get_objects()))

    rows = frame(spark, [(n, f"some words {n}") for n in range(64)]).repartition(16)
    assert piece_codec.encode(rows, path).where("parity").count() == 64
    assert spark.range(0, 16, 1, 16).mapInPandas(held, "id long").agg(F.sum("id")).head()[0] == 0


# 9: URLs

def test_trie_equals_plain_rules_and_the_join(spark):
    rng = random.Random(9)
    hosts = ["com", "example.com", "www.example.com", "a.www.example.com", "xexample.com", "b.net", ".net", "a..net", "org", ""]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/", "/english", "/fr/a?q", "#x"]
    urls = [(n, f"http://{h.upper() if rng.random() < 0.3 else h}{p}") for n, (h, p) in enumerate((h, p) for h in hosts for p in paths)]
    urls += [(900, None), (901, ""), (902, "no-scheme"), (903, "x://a://com/en/")]
    rules = queries.URL_RULES + [("net/", "allow"), ("example.com/e", "allow"), ("org/", "block"), ("org/", "allow")]
    docs = frame(spark, [(i, u, "old") for i, u in urls], "page_id long, url string, verdict string")
    verdicts = {r: v for r, v in rules if (r, "block") not in rules or v == "block"}

    def plain(host, path):
        fits = [r for r in verdicts if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        best = max(fits, key=lambda r: (r.split("/")[0].count("."), len(r)), default=None)
        return best, verdicts.get(best, "allow")

    for most in (100, 1):
        rows = url_trie.judge(docs, rules, max_rules=most).collect()
        assert len(rows) == len(urls)
        for r in rows:
            assert (r.rule, r.verdict) == plain(r.host, r.path), r
    assert {r.verdict for r in url_trie.judge(docs, []).collect()} == {"allow"}


# 10: benchmark

def test_edit_matches_equal_brute_force(spark):
    rng = random.Random(10)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    items = [(n, text(60 + 20 * n)) for n in range(8)] + [(8, None), (9, ""), (None, text(90)), (11, "short")]
    rows = list(ODD)
    for n in range(60):
        item = edit_pigeonhole.folded_text(items[n % 8][1])
        chars = list(item)
        for _ in range(rng.randrange(0, 12)):
            at = rng.randrange(len(chars))
            chars[at : at + 1] = rng.choice([[], ["z"], [chars[at], "y"]])
        rows.append((100 + n, text(200) + " " + "".join(chars).upper() + "\n\n" + text(100)))
    got = {(r.doc_id, r.item_id): r.distance for r in edit_pigeonhole.matches(frame(spark, rows), frame(spark, items, "item_id long, text string"), block=300).collect()}
    want = {}
    for i, t in rows:
        for k, q in items:
            q = edit_pigeonhole.folded_text(q)
            if len(q) >= edit_pigeonhole.LEAST:
                distance = plain_distance(q, edit_pigeonhole.folded_text(t)[:2000])
                if distance <= int(len(q) * edit_pigeonhole.RATE):
                    want[i, k] = distance
    assert got == want and len(want) > 20
    assert edit_pigeonhole.matches(frame(spark, ODD), frame(spark, [], "item_id long, text string")).count() == 0


def test_short_items_are_reported(spark):
    items = frame(spark, [(1, "What is the capital?"), (2, "  A  text of\n more characters than that "), (3, None), (None, "yes")], "item_id long, text string")
    found = {(r.item_id, r.n_chars) for r in edit_pigeonhole.unsearched(items).collect()}
    assert found == {(1, 20), (3, 0), (None, 3)}
    assert edit_pigeonhole.unsearched(items.limit(0)).count() == 0


def test_the_longest_rule_wins_in_trie_and_join(spark):
    rules = [("a.com/very/long/path", "block"), ("x.a.com/", "allow"), ("b.com/12", "block"), ("x.b.com/", "allow")]
    urls = frame(spark, [(1, "http://x.a.com/very/long/path/1"), (2, "http://x.a.com/very"), (3, "http://x.b.com/123"), (4, None)], "page_id long, url string")
    want = [(1, "a.com/very/long/path", "block"), (2, "x.a.com/", "allow"), (3, "x.b.com/", "allow"), (4, None, "allow")]
    for most in (100, 0):
        found = url_trie.judge(urls, rules, max_rules=most).select("page_id", "rule", "verdict")
        assert sorted(map(tuple, found.collect())) == want


def plain_distance(item, text):
    row = np.arange(len(item) + 1)
    codes = np.array([ord(c) for c in item])
    best = row[-1]
    for char in text:
        new = np.minimum(row[1:] + 1, row[:-1] + (codes != ord(char)))
        new = np.concatenate([[0], new])
        new = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
        row = new
        best = min(best, row[-1])
    return int(best)


# The queries and the pipeline

@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries_run(spark, folder, name):
    result = queries.QUERIES[name](spark, folder)
    assert "doc_id" in result.columns or "page_id" in result.columns
    if name in queries.ORACLE:
        from oracle import connect, difference

        assert difference(spark, connect(folder), name, queries.QUERIES[name], queries.ORACLE[name], folder) is None
    else:
        assert result.count() >= 0


def test_shard_query_has_the_digests(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.QUERIES["op4_jump_shards"](spark, folder).collect():
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))


def test_pipeline_keeps_columns_and_drops_what_it_should(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    words = lambda n: " ".join(word() for _ in range(n))
    item, passage, copy = words(30), words(60), words(80)
    rows = [(n, words(50)) for n in [*range(60), *range(1000, 1300)]] + [(n, words(20) + " vile") for n in range(100, 140)]
    rows += [(200, words(30) + " " + item), (201, words(10) + " " + passage), (202, passage + " " + words(10))]
    rows += [(210, copy), (211, copy), (212, copy + " more"), (220, None), (221, "")]
    docs = frame(spark, [(i, t, "en", "s", len(t or "")) for i, t in rows], ROWS + ", lang string, source string, n_chars long")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    frame(spark, [(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    marks = [(i, 0, int(100 <= i < 140)) for i in [*range(60), *range(1000, 1300), *range(100, 140)]]
    frame(spark, marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    last = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        last = stage(spark, last, folder)
        assert last.columns == docs.columns, name
    left = {r.doc_id: r for r in last.collect()}
    assert set(left) == {*range(60), *range(1000, 1300), 201, 202, 210, 220, 221}
    assert left[201].text.endswith(passage) and len(left[202].text.split()) == 10
    assert left[202].n_chars == len(left[202].text)
    result = corpus_pipeline.run(spark, folder)
    assert result.where(F.col("parity")).count() == len(left)
