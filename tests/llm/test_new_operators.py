"""Chat formatting, the Merkle manifest and collocations against plain Python, and on awkward input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from casewright.llm import chat_format, collocations, merkle

LOG = "conv_id long, seq long, kind string, message string, role string, text string, turns int, part string, at int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, index long, first string, n long"


def log(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], LOG)


def plain_fold(rows):
    """The log read in order, one event after the other."""
    kinds = {k: i for i, k in enumerate(chat_format.KINDS)}
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted({r for r in rows if r[0] == conv and r[2] in kinds}, key=lambda r: (
            r[1] is not None, r[1] or 0, kinds[r[2]], r[3] or "", r[5] or ""))
        shown, opened = {}, {}
        for _, seq, kind, name, role, text in mine:
            at = (seq is not None, seq or 0)
            if kind == "message" and name not in opened:
                opened[name] = at
                shown[name] = [role or "", text or ""]
                continue
            if name not in opened:
                continue
            if kind == "regenerate":
                for other in [n for n in shown if opened[name] < opened[n] < at]:
                    del shown[other]
            if name in shown:
                shown[name][1] = (shown[name][1] if kind == "delta" else "") + (text or "")
        if opened and shown:
            out[conv] = [tuple(shown[n]) for n in sorted(shown, key=lambda n: (opened[n], n))]
    return out


@pytest.mark.parametrize("large", [chat_format.LARGE_BYTES, 0])
def test_fold_equals_reading_the_log_in_order(spark, large, monkeypatch):
    monkeypatch.setattr(chat_format, "MOST_LARGE", 10 if large == 0 else 10_000)
    monkeypatch.setattr(chat_format, "LARGE_PARTS", 3)
    rng = random.Random(3)
    rows = []
    for conv in range(25):
        seq, names = 0, []
        for _ in range(rng.randrange(1, 30) if conv else 300):  # conversation 0 holds most rows
            seq += 1
            kind = rng.choice(["message", "message", "delta", "delta", "edit", "regenerate"])
            if kind == "message" or not names:
                names.append(f"m{len(names):04d}")
                rows.append((conv, seq, "message", names[-1], rng.choice(["user", "assistant"]), rng.choice(["", None, f"t{seq}"])))
            else:
                rows.append((conv, seq, kind, rng.choice(names[-4:]), None, f" {kind[0]}{seq}" if kind != "regenerate" else None))
    rows += rows[:40] + [(30, 1, "delta", "never", "user", "x"), (31, None, "message", "a", None, None), (31, 5, "odd", "a", "user", "x"),
                         (31, 2, "delta", "a", None, "é<|says|>"), (None, 1, "message", None, "user", "of nobody"), (None, 2, "delta", None, None, "!")]
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat_format.fold(log(spark, rows), large).collect()}
    assert got == plain_fold(rows)
    assert chat_format.fold(log(spark, [])).count() == 0


def test_rendered_turns_are_read_back(spark):
    t = chat_format.Template()
    hard = ["", "\\", "\\e", "\\c<", *t.controls, "<|turn|><|turn|>", "<</s>", "[[INST]", "a\\" + t.end, "<\\c/s>", "<<s>", "𝄞é</s>", "x" * 300_000]
    rows = [(i, [("user", a), ("assistant", b), (c, a), ("assistant", c)]) for i, (a, b, c) in enumerate(zip(hard, hard[1:] + hard[:1], hard[3:] + hard[:3]))]
    told = spark.createDataFrame(rows, "conv_id long, turns array<struct<role: string, text: string>>")
    for template in (t, chat_format.Template(start="[a", middle="]b", end="(c", others=("</s>",), escape="~", trained_roles=("user", "assistant"))):
        shown = chat_format.render(told, template)
        for r in chat_format.read_back(shown, template).collect():
            want = rows[r.conv_id][1]
            assert [(x.role, x.text) for x in r.turns] == want
            assert r.trained == [text for role, text in want if role in template.trained_roles]
            at, under = 0, []
            for m in r.mask:  # the mask by itself
                at += m.skipped
                under += [r.formatted[at: at + m.chars]] if m.loss else []
                at += m.chars
            assert at + len(template.end) == len(r.formatted)
            undone = [u.replace(f"{template.escape}c", "").replace(f"{template.escape}e", template.escape) for u in under]
            assert undone == r.trained
            body = re.split("|".join(map(re.escape, (template.start, template.middle, template.end))), r.formatted)
            assert not any(c in part for c in template.controls for part in body)
    with pytest.raises(ValueError):
        chat_format.Template(start="<a", end="x<ab")
    broken = chat_format.render(told).selectExpr("conv_id", "formatted", "transform(mask, m -> struct(m.skipped, m.chars + 1 as chars, m.loss)) as mask")
    with pytest.raises(Exception, match="does not lie"):
        chat_format.read_back(broken).collect()


def test_finished_turns_come_back_from_their_log(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([None, "", "word " * rng.randrange(400)]))
            for c in range(30) for t in range(rng.randrange(1, 9))]
    rows += rows[:5] + [(3, 0, "assistant", "tied one"), (3, 0, "user", "tied two"), (None, None, "user", "of nobody")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat_format.fold(chat_format.log_of_turns(turns)).collect()}
    want = {}
    digest = lambda x: hashlib.md5((x or "").encode()).hexdigest()
    for c, t, role, text in sorted({(c, t, r or "", x or "") for c, t, r, x in rows}, key=lambda r: (r[1] or 0, r[2], digest(r[3]))):
        want.setdefault(c, []).append((role, text))
    assert got == want


# -- Merkle manifest ---------------------------------------------------------------------------------------------------


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4096, 4097, 70_000])
def test_positions_are_the_postorder(leaves):
    out = []

    def visit(level, index):
        if level:
            below = -(-leaves // 16 ** (level - 1))
            for child in range(index * 16, min(index * 16 + 16, below)):
                visit(level - 1, child)
        out.append((level, index))

    visit(merkle.height(leaves), 0)
    assert [merkle.position(leaves, *node) for node in out] == list(range(len(out)))


def plain_tree(digests):
    ways, nodes, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(nodes) > 1:
        for i, m in enumerate(at):
            a = m - m % 16
            ways[i].append(("".join(nodes[a:m]), "".join(nodes[m + 1: a + 16])))
        nodes, at = [H(nodes[a: a + 16]) for a in range(0, len(nodes), 16)], [m // 16 for m in at]
    return nodes[0], ways


def plain_proofs(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: H([field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(text)])
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    keys = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {k: (plain_tree([x[2] for x in sorted(trees[k], key=lambda x: x[:3])]), sorted(trees[k], key=lambda x: x[:3])) for k in keys}
    root, tops = plain_tree([built[k][0][0] for k in keys])
    out = []
    for k, top in zip(keys, tops):
        (subroot, ways), leaves = built[k]
        for (_, _, own, r), way in zip(leaves, ways):
            value = own
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                value = leaf(r, re.sub("[A-Z]+", lambda m: m[0].lower(), r[1]))
            for before, after in way + top:
                value = H([before, value, after])
            out.append((r[0], own, subroot, root, H([x for p in way + top for x in p]), value, value == root))
    return sorted(out, key=repr)


def docs(spark, rows):
    return spark.createDataFrame([(*r, "t", 5, "f", 6) for r in rows], DOCS)


def test_proofs_equal_plain_trees(spark):
    rng = random.Random(2)
    rows = [(i, f"Text {i} É", "en", "hot" if i % 3 else f"s{i % 20}", 3) for i in range(900)]
    rows += [(2000 + i, "A", None, "é" + chr(0x10000 + i), None) for i in range(20)] + [(5000, None, None, None, None), (5001, "", "", "", 0)]
    rows += [(None, "NULL id", "en", "hot", 1), (7, "Text 7 other", "en", "hot", 1), (7, "Text 7 other", "en", "hot", 1),
             (6000, "Long " * 200_000, "en", "s1", 1)]
    rng.shuffle(rows)
    got = sorted(map(tuple, merkle.verified(docs(spark, rows)).collect()), key=repr)
    assert got == plain_proofs(rows)
    assert {row[-1] for row in got} == {True, False}


def test_small_manifests(spark):
    for rows in ([(1, "one", "en", "s", 3)], [(5, "x", "en", None, 1), (6, "y", "en", "a", 1)], []):
        assert sorted(map(tuple, merkle.verified(docs(spark, rows)).collect()), key=repr) == (plain_proofs(rows) if rows else [])


def test_the_log_is_complete_and_in_order(spark):
    rows = [(i, f"t{i}", "en", "a" if i < 700 else "b", 1) for i in range(720)]
    log, top, placed, above = merkle.manifest(docs(spark, rows))
    for tree, leaves in (("a", 700), ("b", 20)):
        found = log.filter(log["tree"] == tree).orderBy("position").collect()
        assert [r.position for r in found] == list(range(len(found)))
        assert all(merkle.position(leaves, r.level, r["index"]) == r.position for r in found)
        assert found[-1].digest == above.filter(above["tree"] == tree).first()["top"]
    way = {r["index"]: r.way for r in merkle.ways_up(log, above).filter("tree = 'a'").collect()}
    digests = {r["index"]: r.digest for r in placed.filter("tree = 'a'").collect()}
    root = merkle.tops(top).first()["digest"]
    assert all(merkle.fold_up(digests[i], way[i]) == root for i in range(700))


# -- collocations ------------------------------------------------------------------------------------------------------


def plain_collocations(rows, least, first, absorbed=50):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i: i + k]) for i in range(len(words) - k + 1))
    out = []
    longer = [(key, a) for key, a in f.items() if len(key) == 4 and a >= least]
    inside = Counter()
    for (lang, x, y, z), a in longer:
        for part in ((lang, x, y), (lang, y, z)):
            inside[part] = max(inside[part], a)
    for (lang, *words), a in f.items():
        if len(words) < 2 or a < least or 100 * inside[(lang, *words)] >= absorbed * a and (lang, *words) in inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = f[(lang, *words[:k])], f[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.append((lang, " ".join(words), a, l, r, n[lang], score))
    found = []
    for lang in {row[0] for row in out}:
        mine = sorted((row for row in out if row[0] == lang), key=lambda row: (-row[6], -row[2], row[1].encode()))
        found += [(row[0], rank, *row[1:]) for rank, row in enumerate(mine[:first], 1)]
    return sorted(found)


@pytest.fixture(scope="module")
def phrases():
    rng = random.Random(8)
    rows = []
    for i in range(150):
        words = [rng.choice("the of THE a b c d é ß 𝄞 x-y".split()) for _ in range(rng.randrange(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "; "]) for w in words)
        rows.append((i, text, rng.choice(["en", "de", None]), "s", 1))
    rows += [(200, "hot pair here " * 500, "en", "s", 1)] * 3 + [(201, None, None, None, None), (202, "", "en", "s", 0), (203, " .,;", "en", "s", 0)]
    rows += [(204, "word", "fr", "s", 1), (205, "end", "fr", "s", 1), (206, "a" * 30_000 + " b", "en", "s", 1), (207, "x y " * 9, "und", "s", 1)]
    return rows


@pytest.mark.parametrize("suffixes", [collocations.GROUP_SUFFIXES, 40])
def test_collocations_equal_counting(spark, phrases, suffixes, monkeypatch):
    """Also with many small groups, whose frequent words and pairs are split, and with small slices."""
    monkeypatch.setattr(collocations, "LARGE_PART", 4 if suffixes > 100 else 1)
    for least, first in ((10, 2000), (2, 30)):
        got = collocations.collocations(docs(spark, phrases), least, first, group_suffixes=suffixes)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == plain_collocations(phrases, least, first)
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, [(1, None, "en", "s", 1)])).count() == 0


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_slices_see_every_suffix_once(phrases, size):
    batch = pa.record_batch([pa.array([r[2] for r in phrases[:40]]), pa.array([(r[1] or "")[:300] for r in phrases[:40]])], names=["lang", "text"])
    spelt, found = {}, Counter()
    for part in collocations.slices(batch, size=size):
        for i, (h, lang) in enumerate(zip(part.words[0].tolist(), part.langs)):
            spelt[h] = (lang, part.data[part.starts[i]: part.ends[i]].tobytes().decode())
        found.update(zip(*(w.tolist() for w in part.words)))
    want = Counter()
    for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]+", lambda m: m[0].lower(), text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            want.update((lang or "und", *(words[i: i + 3])) for i in range(len(words)))
    got = Counter()
    for suffix, times in found.items():
        got[(spelt[suffix[0]][0], *(spelt[h][1] for h in suffix if h))] += times
    assert got == want


def test_words_with_equal_hashes_are_told_apart():
    data, starts, ends = np.frombuffer(b"one two one", np.uint8), np.array([0, 4, 8]), np.array([3, 7, 11])
    langs = np.full(3, collocations.lang_key("en"), np.uint64)
    first = collocations._word_hashes(data, starts, ends, langs, frozenset())
    again = collocations._word_hashes(data, starts, ends, langs, frozenset({int(first[0])}))
    assert first[0] == first[2] and again[0] == again[2] != first[0] and again[1] == first[1] and all(again)
    other = collocations._word_hashes(data, starts, ends, np.full(3, collocations.lang_key("de"), np.uint64), frozenset())
    assert not set(first.tolist()) & set(other.tolist())
