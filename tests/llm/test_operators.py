"""Every operator against brute force, and on awkward input: nulls, empty and long texts, ties, repeated rows, empty tables
and clashing column names."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter
from datetime import datetime
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from casewright.llm import (components, decontamination, exact_dedup, fm_index, html_extract, language_id, mixing, pieces,
                            simhash, substring_dedup, suffix_dedup, url_filter, warc, words)
from casewright.llm.common import text_bytes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, fp long, bucket int, name string"


def table(spark, rows):
    """(doc_id, text, lang, source) rows with extra columns whose names the operators use inside."""
    full = [(*r, *[None] * (4 - len(r)))[:4] for r in rows]
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "x") for r in full], SCHEMA)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}"
                    for _ in range(n))


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(5)
    shared = [sentence(rng, 40) for _ in range(3)]
    rows = []
    for i in range(60):
        text = sentence(rng, rng.randrange(1, 120))
        if i % 3 == 0:
            text += "\n" + shared[i % 2] + "  " + sentence(rng, 5)
        if i % 10 == 0:
            text = shared[2] + "\t" + text
        rows.append((i, text, "en", f"s{i % 4}"))
    rows += [(100, None, None, None), (101, "", "en", "s1"), (102, "  \n ", None, None), (103, shared[0], "en", None),
             (104, shared[0].upper(), "en", "s1"), (105, "aaaa " * 60, "en", "s2"), (106, "aaaa " * 60, "en", "s2"),
             (106, "aaaa " * 60, "en", "s2"), (106, "other words", "en", "s2"), (None, shared[1], "en", "s3"),
             (None, shared[1], "en", "s3"), (107, sentence(rng, 30000, 20000), "en", "s0"), (108, "one", "en", "s0"),
             (109, "one", "en", "s0")]
    return rows


# -- exact duplicates ------------------------------------------------------------------------------------------------


def low(text):
    return (text or "").encode().lower()


def test_exact_duplicates(spark, awkward):
    got = exact_dedup.exact_duplicates(table(spark, awkward)).collect()
    groups = {}
    for doc_id, text in {(r[0], low(r[1])) for r in awkward}:
        groups.setdefault(text, []).append(doc_id)
    want = set()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want |= {(i, keep, len(ids), i == keep, hashlib.sha256(text).hexdigest()) for i in ids}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_chunks_are_cut_by_content():
    rng = np.random.default_rng(1)
    body = rng.integers(0, 255, 200_000, dtype=np.uint8).tobytes()
    cut = lambda data: {data[a:b] for a, b in zip([0, *exact_dedup.chunk_ends(data)], exact_dedup.chunk_ends(data))}  # noqa: E731, B905
    assert len(cut(body) & cut(b"shifted" + body)) > len(cut(body)) - 3
    assert exact_dedup.chunk_ends(b"a" * 200_000)[-1] == 200_000
    assert max(np.diff(exact_dedup.chunk_ends(b"a" * 200_000))) <= exact_dedup.LONGEST_CHUNK


def test_names_in_doubt_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.xxhash, "xxh3_64_intdigest", lambda data: 1 << 63)
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string").coalesce(1)
    # The fake runs on the driver only, so look at the recipes of rows made here.
    made = [r for b in [exact_dedup.pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in ((1, "a"), (2, "b"))])]
            for r in exact_dedup._recipes(b)]
    assert made[0]["chunks"][0]["name"] == made[1]["chunks"][0]["name"]
    assert made[0]["chunks"][0]["check"] != made[1]["chunks"][0]["check"]
    assert rows.count() == 3


# -- repeated substrings ---------------------------------------------------------------------------------------------


def removed(rows, split, window):
    """For every row the tokens covered by a window that also starts in a row with a smaller id."""
    tokens = [split(r[1]) for r in rows]
    ids = [r[0] if r[0] is not None else np.inf for r in rows]
    first = {}
    for own, listed in zip(ids, tokens, strict=True):
        for i in range(len(listed) - window + 1):
            key = tuple(listed[i: i + window])
            first[key] = min(own, first.get(key, own))
    out = []
    for own, listed in zip(ids, tokens, strict=True):
        gone = np.zeros(len(listed), bool)
        for i in range(len(listed) - window + 1):
            if first[tuple(listed[i: i + window])] < own:
                gone[i: i + window] = True
        out.append((listed, gone))
    return out


def test_suffix_dedup(spark, awkward):
    rows = [r for r in awkward if r[0] != 107]
    got = sorted((tuple(r) for r in suffix_dedup.without_repeats(table(spark, rows)).collect()), key=str)
    want = []
    for r, (data, gone) in zip(rows, removed(rows, lambda t: list((t or "").encode()), 50), strict=True):
        runs = int(np.sum(gone & ~np.r_[False, gone[:-1]])) if len(gone) else 0
        want.append((r[0], len(data), int(gone.sum()), runs, bytearray(np.array(data, np.uint8)[~gone].tobytes())))
    assert got == sorted(want, key=str)


def test_substring_dedup(spark, awkward):
    got = sorted((tuple(r) for r in substring_dedup.without_repeats(table(spark, awkward)).collect()), key=str)
    want = []
    for r, (listed, gone) in zip(awkward, removed(awkward, lambda t: (t or "").encode().split(), 13), strict=True):
        want.append((r[0], len(listed), int(gone.sum()),
                     b" ".join(w for w, g in zip(listed, gone, strict=True) if not g).decode()))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("often", [False, True])
def test_frequent_anchors_give_the_same_result(spark, monkeypatch, often):
    rng = random.Random(9)
    passage = sentence(rng, 30)
    rows = [(i, f"{sentence(rng, 20)} {passage} {sentence(rng, 20)}") for i in range(40)]
    real = pieces.routes

    def routed(docs, tokens, size, n):
        found = real(docs, tokens, size, n)
        if often:
            data = np.frombuffer(passage.encode(), np.uint8)
            _, bounds, gram, _ = tokens.read(data, np.array([0, len(data)]))
            found.frequent = np.unique(gram)
        return found

    monkeypatch.setattr(pieces, "routes", routed)
    got = {r.doc_id: r.n_removed for r in suffix_dedup.without_repeats(table(spark, rows)).collect()}
    want = {r[0]: int(g.sum()) for r, (_, g) in zip(rows, removed(rows, lambda t: list(t.encode()), 50), strict=True)}
    assert got == want
    got = {r.doc_id: r.n_removed for r in substring_dedup.without_repeats(table(spark, rows)).collect()}
    want = {r[0]: int(g.sum()) for r, (_, g) in zip(rows, removed(rows, lambda t: t.encode().split(), 13), strict=True)}
    assert got == want


@pytest.mark.parametrize("window", [20, 40])
def test_windows_beyond_the_usual_depth(spark, awkward, window):
    """Texts that agree in their first words only: a match of 16 words is none of 20."""
    rng = random.Random(3)
    base = [sentence(rng, 60, 30) for _ in range(3)]
    rows = [(i, base[i % 3] if i < 6 else " ".join([*base[i % 3].split()[:18], sentence(rng, 40, 3)]), "en", "s") for i in range(30)]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.without_repeats(table(spark, rows), window).collect()}
    want = {r[0]: (len(listed), int(gone.sum())) for r, (listed, gone) in zip(
        rows, removed(rows, lambda t: (t or "").encode().split(), window), strict=True)}
    assert got == want and any(n for _, n in want.values())
    with pytest.raises(ValueError):
        substring_dedup.without_repeats(table(spark, rows), 300)


@pytest.mark.parametrize("several_flushes", [False, True])
def test_repeats_that_stand_twice_in_a_document(spark, monkeypatch, several_flushes):
    """A line that a document repeats is a repeat at each of its places: found whole or in part, in the same task or another."""
    if several_flushes:
        monkeypatch.setattr(pieces, "FLUSH_BYTES", 1)
    rng = random.Random(4)
    line, other = sentence(rng, 24), sentence(rng, 24)
    part = " ".join(line.split()[4:20])
    twice = " ".join([line, sentence(rng, 9), line, line, other])
    rows = [(1, f"{sentence(rng, 8)} {part} {sentence(rng, 8)}"), (2, f"{other} {other}"), (3, twice), (4, twice), (5, f"{twice} {twice}"),
            (5, f"{line} {line} {line} {other}"), (6, "short")]
    judges = ((suffix_dedup.Bytes(), suffix_dedup.judged, lambda t: list(t.encode()), 50),
              (substring_dedup.WordTokens(), substring_dedup.judged, lambda t: t.encode().split(), 13))
    for tokens, judge, split, window in judges:
        held = SimpleNamespace(value=pieces.Routes(5, np.zeros(0, np.uint64), np.zeros(0, "S16")))
        batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array(range(len(rows)))],
                                           ["doc_id", "text", "text_hash"])
        sent = pa.Table.from_batches(pieces._sender(tokens, held)(iter([batch.slice(i, 1) for i in range(len(rows))])))
        got = {}
        for found in pieces._judge(judge)(iter(sent.sort_by("bucket").to_batches())):
            for row in found.to_pylist():
                got.setdefault(row["text_hash"], []).append(row["spans"])
        for i, (listed, gone) in enumerate(removed(rows, split, window)):
            marked = np.zeros(len(listed), bool)
            for start, end in zip(*suffix_dedup.merged(got.get(i)), strict=True):
                marked[start:end] = True
            assert marked.tolist() == gone.tolist(), (i, window)
    if not several_flushes:
        got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.without_repeats(table(spark, rows)).collect())
        assert got == sorted((r[0], len(d), int(g.sum())) for r, (d, g) in zip(
            rows, removed(rows, lambda t: list(t.encode()), 50), strict=True))
        got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.without_repeats(table(spark, rows)).collect())
        assert got == sorted((r[0], len(d), int(g.sum())) for r, (d, g) in zip(
            rows, removed(rows, lambda t: t.encode().split(), 13), strict=True))


def test_copies_are_combined_before_they_are_split():
    """Windows of frequent anchors are dealt out one by one, but not those of every copy."""
    rng = random.Random(8)
    passage, line = sentence(rng, 60), sentence(rng, 20)
    rows = [(i // 2, f"{passage} {line} {sentence(rng, i % 3)} {line}") for i in range(60)]
    for tokens, judge, split, window in ((suffix_dedup.Bytes(), suffix_dedup.judged, lambda t: list(t.encode()), 50),
                                         (substring_dedup.WordTokens(), substring_dedup.judged, lambda t: t.encode().split(), 13)):
        data, offsets = text_bytes(pa.array([t for _, t in rows]))
        gram = tokens.read(data, offsets)[2]
        routes = pieces.Routes(5, np.unique(gram), np.zeros(0, "S16"))
        cut = pieces._cut(tokens, routes, data, offsets, 0)
        assert 2 * len(cut["starts"]) < int(cut["windows"].sum())
        batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array(range(len(rows)))],
                                           ["doc_id", "text", "text_hash"])
        sent = pa.Table.from_batches(pieces._sender(tokens, SimpleNamespace(value=routes))(iter([batch])))
        assert {r["bucket"] for r in sent.to_pylist()} == {pieces.HITS, *range(5)}
        got = {}
        for found in pieces._judge(judge)(iter(sent.sort_by("bucket").to_batches())):
            for row in found.to_pylist():
                got.setdefault(row["text_hash"], []).append(row["spans"])
        for i, (listed, gone) in enumerate(removed(rows, split, window)):
            marked = np.zeros(len(listed), bool)
            for start, end in zip(*suffix_dedup.merged(got.get(i)), strict=True):
                marked[start:end] = True
            assert marked.tolist() == gone.tolist(), (i, window)


@pytest.mark.parametrize("operator", [suffix_dedup, substring_dedup])
def test_texts_below_a_window_only(spark, operator):
    rows = [(1, "short"), (2, None), (3, "short")]
    assert [r.n_removed for r in operator.without_repeats(table(spark, rows)).collect()] == [0, 0, 0]


def test_fm_index_counts():
    rng = np.random.default_rng(2)
    text = np.r_[rng.integers(1, 7, 3000), 0]
    index = fm_index.FMIndex(text, 7)
    queries = rng.integers(1, 7, 200)
    length, low_, high = index.matching(queries, np.arange(6, 200), 6, least=1)
    flat = "".join(map(str, text))
    for end, n, a, b in zip(range(6, 200), length, low_, high, strict=True):
        best = max(k for k in range(7) if k == 0 or "".join(map(str, queries[end - k:end])) in flat)
        assert n == best
        if n:
            pattern = "".join(map(str, queries[end - n:end]))
            assert b - a == sum(flat.startswith(pattern, i) for i in range(len(flat)))


def test_pieces_survive_packing():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 900, dtype=np.uint8)
    batch = pieces.Batch(data, np.array([300, 600]), np.array([3, 4]), np.array([5, 6]), np.array([7, 2]),
                         np.array([1, 0]), np.array([50, 60, 70]), np.array([-1, -2, -3]))
    back = pieces.unpacked([pieces.packed(batch), pieces.packed(batch)])
    assert back.data.tolist() == data.tolist() * 2 and back.first.tolist() == [7, 2, 7, 2]
    assert back.doc_ids[back.doc].tolist() == [60, 50, 60, 50]


# -- near duplicates -------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    found = low(text).split()
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i:i + 4]), 42) for i in range(max(1, len(found) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reached(values, near):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    listed = list(values)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if near(a, b):
                parent[root(a)] = root(b)
    return root


def test_simhash(spark, awkward):
    rng = random.Random(8)
    base = sentence(rng, 300).split()
    rows = [(d, t) for d, t, *_ in awkward]
    for i in range(30):
        edited = list(base)
        edited[rng.randrange(300)] = "edit"
        rows.append((200 + i, " ".join(edited)))
    got = simhash.near_duplicates(table(spark, rows)).select("doc_id", "fingerprint", "component_id").collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    root = reached(set(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {}
    for (doc_id, _), fp in zip(rows, fps, strict=True):
        if doc_id is not None:
            smallest[root(fp)] = min(doc_id, smallest.get(root(fp), doc_id))
    want = [(d, f"{fp:016x}", smallest.get(root(fp))) for (d, _), fp in zip(rows, fps, strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("compared", [2, 1000])
def test_links_of_crowded_buckets(spark, monkeypatch, compared):
    monkeypatch.setattr(simhash, "COMPARED", compared)
    rng = random.Random(4)
    fps = set()
    for _ in range(8):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for _ in range(25)}
    rows = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    found = components.components(simhash.links(rows)).collect()
    mine = {r.node % (1 << 64): r.root for r in found}
    root = reached(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    for a in fps:
        for b in fps:
            same = a == b or (a in mine and b in mine and mine[a] == mine[b])
            assert same == (root(a) == root(b))


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7, 7)]
    rng = random.Random(1)
    rng.shuffle(edges)
    found = components.components(spark.createDataFrame([(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges], "a long, b long"))
    assert {(r.node, r.root) for r in found.collect()} == {(i, 0) for i in range(51)} | {(1000 + i, 1000) for i in range(60)}


# -- decontamination -------------------------------------------------------------------------------------------------


def test_decontamination(spark, awkward):
    rng = random.Random(6)
    items = [(i, sentence(rng, n)) for i, n in enumerate((3, 5, 6, 20, 40, 200))] + [(7, None), (8, ""), (9, sentence(rng, 30))]
    texts = dict(items)
    rows = [(d, t) for d, t, *_ in awkward]
    rows += [(300, f"{sentence(rng, 2000)} {texts[3].replace("w", "W")} {sentence(rng, 2000)}"), (301, texts[4][: len(texts[4]) // 2]),
             (302, " ".join([*texts[5].split()[:190], *sentence(rng, 30).split()])), (303, texts[0]), (304, texts[0] + " more words after it")]
    got = decontamination.contained_items(
        table(spark, rows), spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string"))
    want = set()
    for d, t in rows:
        own = decontamination.shingles(t)
        for item, text in items:
            wanted = decontamination.shingles(text)
            if wanted and len(wanted & own) >= 0.8 * len(wanted):
                want.add((d, item, len(wanted & own), len(wanted)))
    found = {(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in got.collect()}
    assert found == want and {(300, 3), (302, 5), (303, 0)} <= {x[:2] for x in found}
    small = decontamination.contained_items(table(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_words=100)
    assert {(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in small.collect()} == want


def test_words_and_shingles():
    texts = [b"a b  c", b"", b"d", b"e\tf", b" x" * 3, bytes(range(256))]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    found = words.words_of(data, offsets)
    assert [data[a:b].tobytes() for a, b in zip(found.starts, found.ends, strict=True)] == [w for t in texts for w in t.split()]
    assert found.rows.tolist() == [i for i, t in enumerate(texts) for _ in t.split()]
    by = {}
    for h, a, b in zip(found.hashes, found.starts, found.ends, strict=True):
        by.setdefault(int(h), set()).add(data[a:b].tobytes())
    assert all(len(v) == 1 for v in by.values())


# -- mixing ----------------------------------------------------------------------------------------------------------


def test_mixing(spark, awkward):
    docs = table(spark, awkward)
    got = mixing.taken_words(docs).collect()
    assert len(got) == len(awkward)
    size = {}
    for _, text, _, source in awkward:
        size[source] = size.get(source, 0) + len((text or "").encode().split())
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    target, full = {}, set()
    while True:  # share by weight, fix those above three times their size, reshare
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        free = sum(weight[s] for s in size if s not in full)
        target = {s: 3.0 * size[s] if s in full else rest * weight[s] / free for s in size}
        above = {s for s in size if target[s] > 3 * size[s]}
        if not above:
            break
        full |= above
    sources = {}
    for r in got:
        sources.setdefault(r.target, [r.source_size, 0])
        sources[r.target][1] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    assert sorted(sources) == pytest.approx(sorted(set(target.values())))
    for wanted, (_, taken) in sources.items():
        same = sum(abs(t - wanted) < 1e-6 for t in target.values())
        assert abs(taken - wanted * same) <= same
    again = mixing.taken_words(docs.repartition(7)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    finish = [r.finish for r in mixing.schedule(docs).collect()]
    assert finish == sorted(finish)


# -- language --------------------------------------------------------------------------------------------------------


def test_language_id(spark):
    rng = random.Random(3)
    syllables = {"aa": "ba be bi bo bu da de di".split(), "bb": "xor zeq wyk plu gna".split()}
    make = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(n))
    rows = [(i, make(lang, 30), lang, "s") for i in range(80) for lang in ("aa", "bb")]
    rows += [(900, None, "aa", None), (901, "", "aa", None), (902, "12 !?", None, None), (903, make("aa", 5), None, None)]
    model = language_id.train(table(spark, rows[:120]))
    got = {(r.doc_id, r.lang_pred, r.rejected) for r in language_id.predict(table(spark, rows[120:]), model).collect()}
    assert got == {(r[0], r[2], False) for r in rows[120:160]} | {
        (900, "und", True), (901, "und", True), (902, "und", True), (903, "aa", False)}
    odd = language_id.predict(table(spark, [(1, "QQQ JJJ ЖЖЖ ЩЩЩ ЮЮЮ " * 40)]), model).first()
    assert odd.rejected and 0 <= odd.score <= 1
    empty = language_id.train(table(spark, []).limit(0))
    assert language_id.predict(table(spark, rows[:2]), empty).first().lang_pred == "und"


def test_kneser_ney_sums_to_one(spark):
    texts = [(i, t, "aa") for i, t in enumerate(("abab abba", "baba bab abab", "abba ab"))]
    model = language_id.train(table(spark, texts), order=3)
    chars = sorted({*"ab ", "c", "q"})
    for context in ("ab", "ba", " a", "qq"):
        chance = {c: float(np.exp(model.scores(
            np.array([ord(x) for x in context + c], np.uint32), np.zeros(3, np.int64), np.array([2]))[1][0, 0]))
            for c in [*chars, "z"]}  # z stands for all unseen code points
        assert sum(chance[c] for c in chars) + chance["z"] * (0x110000 - len(chars)) == pytest.approx(1.0, abs=1e-4)


def test_every_ngram_is_kept(spark):
    # 70,000 different letters of one language: more single n-grams than the cap of 60,000 there was.
    wide = [chr(c) for c in range(0x3400, 0x20000 + 42_000) if chr(c).isalpha() and chr(c).lower() == chr(c)][:70_000]
    texts = [(i, "".join(wide[i * 500: i * 500 + 500]), "aa") for i in range(140)]
    known = language_id.train(table(spark, texts), order=2, block_entries=50_000)

    def kept(grams, n):
        keys = language_id.entry_keys(language_id.gram_keys(pa.array(grams), 2), n, False)
        return sum(np.isin(keys, block.value.keys) for block in known.blocks)

    assert len(wide) == 70_000 and len(known.blocks) > 3 and (kept(wide, 1) == 1).all()
    assert (kept([r[1][k: k + 2] for r in texts for k in range(499)], 2) == 1).all()


def plain_kneser_ney(rows, order):
    """The log probability of a character after the ones before it, written out with dictionaries."""
    levels = {lang: {order: Counter()} for _, _, lang in rows}
    for _, text, lang in rows:
        norm = plain_norm(text)
        levels[lang][order].update(norm[i: i + order] for i in range(len(norm) - order + 1))
    share, back = {}, {}
    for lang, level in levels.items():
        for n in range(order, 0, -1):
            if n < order:
                level[n] = Counter(g[1:] for g in level[n + 1])
            times = Counter(level[n].values())
            d = times[1] / (times[1] + 2 * times[2]) if times[1] + times[2] else 0.5
            d = min(max(d, language_id.DISCOUNT_FLOOR), language_id.DISCOUNT_CEILING)
            total = Counter()
            for gram, m in level[n].items():
                total[gram[:-1]] += m
            used = Counter()
            for gram, m in level[n].items():
                share[lang, gram] = (m - d) / total[gram[:-1]]
                used[gram[:-1]] += share[lang, gram]
            back.update({(lang, context): max(1 - x, 1e-6) for context, x in used.items()})

    def chance(lang, gram):
        if not gram:
            return 1 / 0x110000
        return share.get((lang, gram), 0) + back.get((lang, gram[:-1]), 1) * chance(lang, gram[1:])

    return lambda lang, text: [np.log(chance(lang, text[max(0, i - order + 1): i + 1])) for i in range(1, len(text))]


def plain_norm(text):
    letters = " " + "".join(c.lower() if c.isalpha() else " " for c in text)
    return re.sub(" +", " ", letters)


def test_scores_equal_plain_kneser_ney(spark, monkeypatch):
    rng = random.Random(12)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(i, make("abcde  .", 60), "aa") for i in range(12)] + [(50 + i, make("cdefÄß й", 60), "bb") for i in range(9)]
    rows += [(90, make("xyz ", 300), "cc"), (91, "", "cc"), (92, "b", "cc")]
    texts = [make("abcdefxyzÄß й1.", n) for n in (0, 1, 2, 3, 4, 5, 70, 4000)] + [" ", "  7a", "9" * 500 + "ab c" + "-" * 300 + "d" * 200, "é"]
    plain = plain_kneser_ney(rows, 4)
    for size, entries in ((1 << 18, 4_000_000), (64, 200), (7, 100)):
        # Long texts are cut into pieces and the model into blocks: the scores stay.
        monkeypatch.setattr(language_id, "CHUNK", size)
        model = language_id.train(table(spark, rows), block_entries=entries)
        assert len(model.blocks) == 1 if entries > 1000 else len(model.blocks) > 2
        got, length = model.cross_entropies(*text_bytes(pa.array(texts)))
        for text, found, n in zip(texts, got, length, strict=True):
            norm = plain_norm(text)
            assert n == (len(norm) - 1 if norm.strip() else 0)
            if n:
                assert found.tolist() == pytest.approx([-np.mean(plain(lang, norm)) for lang in ("aa", "bb", "cc")], abs=1e-4)


def test_many_languages_and_an_empty_table(spark):
    # More languages than the 200 that there once were at most.
    rows = [(i, (chr(0x4E00 + i) + chr(0x4E00 + i + 1)) * 20, f"l{i:03}") for i in range(230)]
    model = language_id.train(table(spark, rows))
    got = {r.doc_id: r.lang_pred for r in language_id.predict(table(spark, rows), model).collect()}
    assert got == {r[0]: r[2] for r in rows}
    assert language_id.predict(table(spark, rows).limit(0), model).count() == 0


def test_long_text_needs_bounded_memory(spark):
    rows = [(i, "the cat sat on a mat and ran " * 9, "aa") for i in range(4)]
    model = language_id.train(table(spark, rows))
    data, offsets = text_bytes(pa.array(["the cat sat on a mat and ran " * 600_000, "cat"]))
    short, _ = model.cross_entropies(*text_bytes(pa.array(["the cat sat on a mat and ran " * 6_000, "cat"])))
    tracemalloc.start()
    got, length = model.cross_entropies(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(data) > 17_000_000 and peak < 150_000_000 and length.tolist() == [29 * 600_000, 3]
    assert got == pytest.approx(short, abs=1e-3)


def test_rejection_holds_for_rare_languages(spark):
    rng = random.Random(8)
    make = lambda listed, n: " ".join("".join(rng.choice(listed) for _ in range(3)) for _ in range(n))
    rows = [(i, make("ba be bi bo bu da de di".split(), 30), "aa") for i in range(60)]
    rows += [(100 + i, make("xor zeq wyk plu gna".split(), 30), "bb") for i in range(4)]
    model = language_id.train(table(spark, rows))
    assert np.isfinite(model.usual).all() and model.usual[0][1] > 0
    junk = language_id.predict(table(spark, [(1, "xqz ЖЖЖ ЩЩЩ ЮЮЮ zqx " * 40)]), model).first()
    assert junk.rejected


# -- pages -----------------------------------------------------------------------------------------------------------

PAGE = """<html><head><title>x</title></head><body class="page content"><header><h1>Site</h1></header>
<div id="sidebar"><p>side</p></div><div class="cookie-notice">We use</div><article><h1>Title &amp; more</h1><p>One
 two<br>three &nbsp; four</p><p>Five <b>{0}</p><ul><li>a<li>b</ul><div class=comments><p>c1</p></div><form><p>f</p></form>
</article><!-- <p>no</p> --><footer>c</footer><script>if(a<b){{"</p>"}}</script>"""


def test_html_extract(spark):
    schema = "page_id long, url string, html string, host string, text string"
    plain = "<body><div class=menu>m</div><div>Same notice</div><div><h2>T{0}</h2>text {0} &lt;x&gt;<p>more {0}</div><p><a href=x>link {0}</a></p>"
    rows = [(i, f"http://a.example/{i}", PAGE.format(i), "h", "t") for i in range(5)]
    rows += [(10 + i, f"http://B.example/{i}", plain.format(i), "h", "t") for i in range(5)]
    rows += [(20, None, None, "h", "t"), (21, "http://a.example/x", "", "h", "t"), (22, "nourl", "just < text &amp; no tags", "h", "t"),
             (23, "http://c.example/", "<article>cut off <p>here <!-- never closed", "h", "t"), (0, "http://a.example/0", PAGE.format(0), "h", "t")]
    got = {(r.page_id, r.text) for r in html_extract.extracted(spark.createDataFrame(rows, schema)).collect()}
    want = {(i, f"Title & more\nOne two three four\nFive {i}\na\nb") for i in range(5)}
    want |= {(10 + i, f"T{i}\ntext {i} <x>\nmore {i}") for i in range(5)}
    want |= {(20, ""), (21, ""), (22, "just < text & no tags"), (23, "cut off\nhere")}
    assert got == want
    assert html_extract.extracted(spark.createDataFrame([], schema)).count() == 0


def test_wrapper_is_a_union_free_expression():
    pages = [f"<div><ul>{'<li>x' + str(n) * 2 * n}</ul>{'<p>a' + str(n) if n else ''}</div>" for n in range(3)]
    nodes, _ = html_extract.inferred(["<div><ul><li>a</li><li>b</li></ul></div>", "<div><ul><li>c</li><li>d</li><li>e</li></ul><hr></div>"])
    assert " ".join(n.pattern() for n in nodes) == "div ul (li #TEXT /li)+ /ul (hr)? /div"
    assert html_extract.inferred(pages)[0]


def test_pages_are_matched_against_the_expression(spark):
    page = "<body><article><h1>T{0}</h1><p>text {0}</p><div class=x>Write to us</div>{1}</article></body>"
    rows = [(i, f"http://a.example/{i}", page.format(i, "<p>more</p><div class=y>Sign up</div>" if i % 2 else "")) for i in range(30)]
    rows += [(100 + i, f"http://b.example/{i}", page.format(7, "")) for i in range(30)]
    got = {r.page_id: r.text for r in html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # What every page with the slot says behind all that varies is the template's own, also in an article; one article
    # many times is not.
    assert all(got[i] == f"T{i}\ntext {i}" for i in range(30))
    assert not any("Sign up" in t for t in got.values())
    assert all(got[100 + i] == "T7\ntext 7\nWrite to us" for i in range(30))


@pytest.mark.parametrize("pages", [5, 12, 300])
def test_texts_that_articles_repeat_stay(spark, pages):
    """Headings and refrains between varying blocks, at any number of pages."""
    page = ("<article><h1>Recipe {0}</h1><h2>Ingredients</h2><p>flour {0}</p><p>Mix well.</p><h2>Method</h2><p>stir {0} times</p>"
            "<h2>Notes</h2></article>")
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(pages)]
    got = html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {f"Recipe {i}\nIngredients\nflour {i}\nMix well.\nMethod\nstir {i} times\nNotes" for i in range(pages)}


def test_names_of_paragraphs_and_parts():
    inside = ("<article><p class=alert>a</p><div class='related-work'><p>b</p></div><div class='side-effects'>c</div><p class='search-party'>d</p>"
              "<h2 class=page-header>e</h2><div class='ad wide'>f</div><div hidden>g</div><p aria-hidden=true>h</p></article>")
    assert html_extract.main_text(inside) == "a\nb\nc\nd\ne"
    assert html_extract.main_text("<div class=text>teaser</div><div><p>a long real paragraph of the page</p></div>") == (
        "teaser\na long real paragraph of the page")
    assert html_extract.main_text("<div>short</div><div class=content><p>a long real paragraph of the page</p></div>") == (
        "a long real paragraph of the page")


def test_repeated_rows_of_a_page_are_sampled_once(spark):
    page = "<body><article><h1>T{0}</h1><p>text {0}</p></article></body>"
    rows = [(1, "http://a.example/1", page.format(1))] * 400 + [(i, f"http://a.example/{i}", page.format(i)) for i in range(2, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html_extract.wrappers(html_extract.shaped(pages)).count() == 1
    got = html_extract.extracted(pages).collect()
    assert len(got) == 403 and {r.text for r in got} == {f"T{i}\ntext {i}" for i in range(1, 5)}


def test_whole_pages_and_all_layouts_confirm_template_texts(spark):
    rng = random.Random(4)
    long = "".join(f"<{rng.choice(('b', 'i', 'u', 'em'))}>word{n}</b> " for n in range(4000))
    one, other = "<body><div>{1}text {0}</div><div class=z>Closing words</div>", "<body><table><tr><td>text {0}</table><div>Other closing</div>"
    # The long page is sampled, the second layout is a tenth of the host.
    rows = [(i, f"http://a.example/{i}", one.format(i, long if i < 4 else "")) for i in range(4)]
    rows += [(i, f"http://a.example/{i}", (other if i % 10 == 0 else one).format(i, "")) for i in range(10, 110)]
    got = {r.page_id: r.text for r in html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(t.endswith(f"text {i}") for i, t in got.items()) and len(got) == 104


def test_alignment_in_halves_is_as_long(monkeypatch):
    rng = random.Random(6)

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0, *(0 for _ in b)] if not b else [0, *_next(row, x, b)]
        return row[-1]

    def _next(row, x, b):
        last = 0
        for j, y in enumerate(b):
            last = row[j] + 1 if x == y else max(last, row[j + 1])
            yield last

    for held in (1 << 26, 8):
        monkeypatch.setattr(html_extract, "HELD_BITS", held)
        for _ in range(150):
            a, b = ([rng.choice("abcd") for _ in range(rng.randrange(14))] for _ in range(2))
            found = html_extract.common(a, b)
            assert all(a[i] == b[j] for i, j in found) and len(found) == longest(a, b)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))  # noqa: B905


def test_url_filter(spark):
    cases = {
        "https://www.Example.com/en/5": ("www.example.com/en/", "allow"), "http://m.x.example.com/en/1?q": ("example.com/en/", "block"),
        "http://m.example.com/de/1#t": ("com/", "allow"), "http://a.example.net/es/3": ("net/es/", "block"),
        "http://a.example.net/es": (None, "allow"), "http://anet/es/": (None, "allow"), "http://net/fr/x": ("net/fr/", "block"),
        "http://example.org": (None, "allow"), "nothing": (None, "allow"), None: (None, "allow"), "http://a.com": (None, "allow"),
        "x://a.com?/en/": (None, "allow"), "": (None, "allow")}
    rows = [(i, u, "html", "h") for i, u in enumerate(cases)]
    schema = "page_id long, url string, html string, host string"
    got = url_filter.judged(spark.createDataFrame(rows, schema)).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in got} == {i: v for i, v in enumerate(cases.values())}
    assert {(r.host, r.path) for r in got} >= {("www.example.com", "/en/5"), ("example.org", ""), ("", ""), ("a.com", "")}
    assert url_filter.judged(spark.createDataFrame([], schema)).count() == 0


def test_templates_learn_from_labels(spark):
    rows = [(i, f"http://h.org/spam/{i}") for i in range(20)] + [(100 + i, f"http://h.org/news/{i}") for i in range(20)]
    rows += [(200 + i, f"http://h.org/u/name{chr(97 + i % 26)}{chr(97 + i // 26)}/x") for i in range(100)]
    labels = [(i, True) for i in range(12)] + [(100 + i, False) for i in range(12)] + [(200 + i, True) for i in range(10)]
    got = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string"), (),
                            spark.createDataFrame(labels, "page_id long, blocked boolean")).collect()
    verdict = {r.page_id: r.verdict for r in got}
    assert all(verdict[i] == "block" for i in range(20)) and all(verdict[100 + i] == "allow" for i in range(20))
    assert {r.template for r in got if r.page_id >= 200} == {"/u/*/x"} and verdict[299] == "block"


def test_templates_of_deep_paths(spark):
    """Branches below many shared segments are told apart, and very long paths end."""
    low = "/".join("abcdefghijklmnop")
    rows = [(i, f"http://h.org/{low}/spam/{i}/x") for i in range(20)] + [(100 + i, f"http://h.org/{low}/news/{i}/x") for i in range(60)]
    rows += [(500, "http://h.org/" + "s/" * 3000), (501, "http://h.org/" + "s/" * 3000), (502, f"http://h.org/{low}")]
    labels = [(i, True) for i in range(20)] + [(100 + i, False) for i in range(60)]
    got = {r.page_id: r for r in url_filter.judged(
        spark.createDataFrame(rows, "page_id long, url string"), (), spark.createDataFrame(labels, "page_id long, blocked boolean")).collect()}
    assert all(got[i].verdict == "block" for i in range(20)) and all(got[100 + i].verdict == "allow" for i in range(60))
    assert got[0].template == f"/{low}/spam/#/x" and got[500].template == "/s" * 3000 + "/" and got[502].template == f"/{low}"


def plain_templates(paths, most=url_filter.MOST_BRANCHES, uses=url_filter.URLS_A_BRANCH):
    """The template of each path of one host, segment by segment."""
    out = {p: "" for p in paths}
    for at in range(1, max(p.count("/") for p in paths) + 1):
        nodes = {}
        for p in paths:
            parts = p.split("/")
            if len(parts) > at:
                nodes.setdefault(out[p], []).append((p, parts[at]))
        for node, found in nodes.items():
            branches = {s for _, s in found}
            wild = len(branches) > most and len(found) < len(branches) * uses
            for p, s in found:
                out[p] = f"{node}/{'*' if wild else s}"
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_templates_equal_a_plain_tree(spark, seed):
    rng = random.Random(seed)
    word = lambda n: "w" + "abcdefghijklmnopqrstuvwxyz"[rng.randrange(n)]
    paths = sorted({"".join("/" + word(rng.choice([2, 3, 26])) for _ in range(rng.randrange(1, 12))) + rng.choice(["", "/"]) for _ in range(150)})
    urls = spark.createDataFrame([("h", p, None) for p in paths], "host string, path string, blocked boolean")
    assert {r.shape: r.template for r in url_filter.templates(urls).collect()} == plain_templates(paths)


def test_repeated_records(spark):
    at = lambda day: datetime(2024, 1, day)
    full = (1, "http://a.com/x", at(1), "response", 200, {"etag": "1"}, "one")
    asked = (2, "http://a.com/x", at(3), "revisit", 304, {"etag": "1"}, None)
    other = (2, "http://a.com/y", at(3), "revisit", 304, {"etag": "1"}, None)
    later = (7, "http://a.com/z", at(5), "response", 200, {"etag": "9"}, "new")
    rows = [full, full, full, asked, asked, other, (7, "http://a.com/z", at(2), "response", 200, {"etag": "1"}, "old"), later,
            (8, "http://a.com/z", at(6), "revisit", 304, {"etag": "9"}, None), (None, "http://a.com/n", at(1), "response", 200, None, "n"),
            (9, "http://a.com/n", at(2), "revisit", 304, None, None), (None, "http://a.com/x", at(4), "revisit", 304, {"etag": "1"}, None),
            (11, "http://a.com/l", at(1), "response", 200, {"etag": "l"}, "long " * 200_000), (12, "http://a.com/l", at(2), "revisit", 304, {"etag": "l"}, None)]
    got = [(r.record_id or 0, r.url_key, r.outcome, r.source, len(r.body or ""))
           for r in warc.resolve(spark.createDataFrame(rows, warc.RECORDS)).collect()]
    counted = {}
    for row in got:
        counted[row] = counted.get(row, 0) + 1
    assert counted == {(1, "a.com/x", "full", None, 3): 3, (2, "a.com/x", "resolved", 1, 3): 2, (2, "a.com/y", "orphan", None, 0): 1,
                       (7, "a.com/z", "full", None, 3): 2, (8, "a.com/z", "resolved", 7, 3): 1, (0, "a.com/n", "full", None, 1): 1,
                       (9, "a.com/n", "orphan", None, 0): 1, (0, "a.com/x", "resolved", 1, 3): 1,
                       (11, "a.com/l", "full", None, 1_000_000): 1, (12, "a.com/l", "resolved", 11, 1_000_000): 1}


def test_revisits(spark):
    at = lambda day: datetime(2024, 1, day)
    rows = [
        (1, "http://www.a.com/x/", at(1), "response", 200, {"etag": "1", "content-type": "t", "x": "old"}, "one"),
        (2, "https://a.com/x#f", at(3), "response", 200, {"etag": "2", "content-type": "t"}, "two"),
        (3, "http://a.com/x?utm_source=q", at(2), "revisit", 304, {"etag": "W/1", "content-type": "bad", "x": "new"}, None),
        (4, "http://a.com/x", at(4), "revisit", 304, {"etag": "1"}, None),
        (5, "http://a.com/x", at(1), "revisit", 304, {"etag": "1"}, None),
        (6, "http://a.com/other", at(9), "revisit", 304, None, None),
        (7, "http://a.com/x", at(5), "response", 404, None, "gone"),
        (8, "http://a.com/x", at(6), "revisit", 304, {"date": "d"}, None),
        (9, None, None, "revisit", 304, None, None), (10, None, None, None, None, None, None)]
    got = {r.record_id: r for r in warc.resolve(spark.createDataFrame(rows, warc.RECORDS)).collect()}
    assert {i: (r.outcome, r.source) for i, r in got.items()} == {
        1: ("full", None), 2: ("full", None), 3: ("resolved", 1), 4: ("mismatch", None), 5: ("orphan", None),
        6: ("orphan", None), 7: ("full", None), 8: ("unverified", None), 9: ("orphan", None)}
    assert got[3].headers == {"etag": "1", "content-type": "t", "x": "new"} and got[3].body == "one"
    assert warc.resolve(spark.createDataFrame([], warc.RECORDS)).count() == 0


def test_revisits_across_partitions(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        full = rng.random() < 0.05
        rows.append((i, f"http://h/{0 if rng.random() < 0.7 else rng.randrange(5)}", datetime(2024, 1, 1 + rng.randrange(28), rng.randrange(24)),
                     "response" if full else "revisit", 200 if full else 304, {"etag": "e"}, "b" if full else None))
    got = {r.record_id: r.source for r in warc.latest_full(spark.createDataFrame(rows, warc.RECORDS)).collect()}
    for i, url, when, kind, *_ in rows:
        if kind == "revisit":
            earlier = [(r[2], r[0]) for r in rows if r[3] == "response" and r[1] == url and r[2] < when]
            assert got[i] == (max(earlier)[1] if earlier else None)


# -- empty tables ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("operator", [
    exact_dedup.exact_duplicates, simhash.near_duplicates, suffix_dedup.without_repeats, substring_dedup.without_repeats,
    mixing.taken_words, mixing.schedule])
def test_empty_table(spark, operator):
    assert operator(table(spark, [])).count() == 0
