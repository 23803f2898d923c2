"""Phrase collocation mining by vertical partitioning of the suffixes of all texts.

A suffix begins at a word of a piece and is cut after three words. Suffixes are dealt to groups by their prefix: the first word;
where that is too frequent for a group, the first two words; where these are, all three. Prefixes are ordered by hash and put
together until a group holds as many suffixes as the memory budget allows. Each group sorts its suffixes by itself, which is the suffix
subtree of its prefixes cut at depth three, and reads how often a phrase occurs from the totals of the leaves below its node. Only a
node whose leaves lie in several groups (a word pair that was split) is summed over groups.

Map tasks combine equal suffixes and pack those of a group into one binary value, with a dictionary of their words, so that
some bytes a suffix move. Inside, a word is 64 hash bits of (language, word); the dictionary of the corpus is checked for
words that share them, and these get other bits.

The list of split prefixes and the bounds of groups are at most a few entries a group; only they go to the driver.

Defined cases: a null text is empty; a null language is ``und``. Rows that repeat count as often as they stand there. Texts of
any length are cut into slices that overlap by two words. An empty table gives an empty result. Scores are exact: they are computed
with decimals of 38 digits. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm.common import settle, text_bytes
from casewright.llm.words import TO_LOWER, mixed, slice_hashes

LEAST_COUNT = 10
FIRST_ROWS = 2000
#: A longer phrase with at least so many hundredths of a phrase's occurrences replaces it.
ABSORBED = 50
SCALE = 1_000_000
#: Suffixes that one group may hold.
GROUP_SUFFIXES = 1_000_000
#: A prefix with more than this part of a group's suffixes is split.
LARGE_PART = 4
SLICE_BYTES = 4 << 20

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
INSIDE = ~BREAK
INSIDE[[0x20, 0x09]] = False
NONE = np.uint64(0)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang_keys: np.ndarray, alike: frozenset) -> np.ndarray:
    """Hash of (language, word), never 0. ``alike`` has the hashes that stand for several words, which are hashed again."""
    found = mixed(slice_hashes(data, starts, ends) ^ lang_keys) | np.uint64(1)
    if alike:
        for i in np.flatnonzero(np.isin(found, np.fromiter(alike, np.uint64))).tolist():
            word = data[starts[i]: ends[i]].tobytes()
            found[i] = xxhash.xxh64_intdigest(word + int(lang_keys[i]).to_bytes(8, "little"), 1) | 1
    return found


def lang_key(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 7)


class Slice:
    """The words of a part of a batch: place, hash, language and, for each, the next two words of its piece (0: none)."""

    def __init__(self, data, starts, ends, hashes, pieces, langs, stop):
        self.data, self.starts, self.ends, self.langs = data, starts[:stop], ends[:stop], langs[:stop]
        padded = np.r_[hashes, np.zeros(2, np.uint64)]
        piece = np.r_[pieces, -1, -2]
        n = stop
        second = np.where(piece[1: n + 1] == piece[:n], padded[1: n + 1], NONE)
        third = np.where((piece[2: n + 2] == piece[:n]) & (second != NONE), padded[2: n + 2], NONE)
        self.words = (hashes[:n], second, third)


def slices(batch: pa.RecordBatch, alike: frozenset = frozenset(), size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The words of a batch (lang, text) in slices of some ``size`` bytes, cut between words; a slice sees the two words that
    follow it."""
    langs = [x if x is not None else "und" for x in batch.column(0).to_pylist()]
    keys = np.array([lang_key(x) for x in langs], np.uint64)
    data, offsets = text_bytes(batch.column(1))
    at = 0
    while at < len(data):
        stop, after = _cut(data, at + size), 0
        if stop < len(data):  # two more words, wherever they end
            after = stop
            for _ in range(2):
                while after < len(data) and not INSIDE[data[after]]:
                    after += 1
                after = _cut(data, after)
        part = TO_LOWER[data[at: max(stop, after)]]
        inside = np.zeros(len(part) + 2, bool)
        inside[1:-1] = INSIDE[part]
        first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        joins = offsets[(offsets > at) & (offsets < at + len(part))] - at
        both = joins[inside[joins] & inside[joins + 1]]  # texts that touch without a blank
        first[both], last[both - 1] = True, True
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        rows = np.searchsorted(offsets, starts + at, side="right") - 1
        pieces = np.cumsum(BREAK[part])[starts] + rows
        hashes = _word_hashes(part, starts, ends, keys[rows], alike)
        n = int(np.searchsorted(starts, stop - at))
        if n:
            yield Slice(part, starts, ends, hashes, pieces, np.array(langs, object)[rows], n)
        at = stop


def _cut(data: np.ndarray, at: int) -> int:
    """The first place from ``at`` on that is not inside a word."""
    while at < len(data):
        out = np.flatnonzero(~INSIDE[data[at: at + 4096]])
        if len(out):
            return at + int(out[0])
        at += 4096
    return len(data)


def _combined(words: tuple[np.ndarray, ...]) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """The distinct suffixes in order of hash, and how often each occurs. The second and third words of the suffixes of
    a slice are first words of others, but for the last ones."""
    known = np.unique(np.r_[NONE, words[0], words[1][-1:], words[2][-2:]])
    keys, counts = _sorted_suffixes(*(np.searchsorted(known, w).astype(np.uint32) for w in words))
    return tuple(known[k] for k in keys), counts


def _sorted_suffixes(a: np.ndarray, b: np.ndarray, c: np.ndarray, times: np.ndarray | None = None):
    """Distinct (a, b, c) in order, with the sum of their ``times`` (1 each)."""
    if not len(a) or max(int(a.max()), int(b.max()), int(c.max())) < 1 << 21:
        bits, mask = np.uint64(21), np.uint64((1 << 21) - 1)
        packed = (a.astype(np.uint64) << bits | b) << bits | c
        if times is None:
            packed, sums = np.unique(packed, return_counts=True)
        else:
            order = np.argsort(packed)
            packed, times = packed[order], times[order]
            new = np.flatnonzero(np.r_[True, packed[1:] != packed[:-1]])
            packed, sums = packed[new], np.add.reduceat(times, new)
        return ((packed >> bits >> bits).astype(np.uint32), (packed >> bits & mask).astype(np.uint32), (packed & mask).astype(np.uint32)), sums
    order = np.lexsort((c, b, a))
    a, b, c = a[order], b[order], c[order]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
    sums = np.diff(np.r_[new, len(a)]) if times is None else np.add.reduceat(times[order], new)
    return (a[new], b[new], c[new]), sums


# -- words and frequent pairs ------------------------------------------------------------------------------------------

_WORDS = "lang string, word string, first long, second long, n long"
_WORDS_ARROW = pa.schema([("lang", pa.string()), ("word", pa.string()), ("first", pa.int64()), ("second", pa.int64()), ("n", pa.int64())])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _count_words(groups: int, alike: frozenset) -> Callable:
    """Words of each slice with their counts; and pairs, without a word, that occur often enough in the slice to be
    frequent in the corpus: a pair with more than 1 / (8 groups) of all words has that part of them in some slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, alike):
                found, at, counts = np.unique(part.words[0], return_index=True, return_counts=True)
                spelt = [part.data[part.starts[i]: part.ends[i]].tobytes().decode() for i in at.tolist()]
                yield pa.record_batch([pa.array(part.langs[at].tolist(), pa.string()), pa.array(spelt, pa.string()), _signed(found),
                                       pa.nulls(len(found), pa.int64()), pa.array(counts, pa.int64())], schema=_WORDS_ARROW)
                pairs, number = _combined((part.words[0], part.words[1], np.zeros(len(part.words[0]), np.uint64)))
                often = (pairs[1] != NONE) & (number > max(1, len(part.words[0]) // (8 * groups)))
                if often.any():
                    k = int(often.sum())
                    yield pa.record_batch([pa.nulls(k, pa.string()), pa.nulls(k, pa.string()), _signed(pairs[0][often]),
                                           _signed(pairs[1][often]), pa.array(number[often], pa.int64())], schema=_WORDS_ARROW)

    return run


def words_and_pairs(docs: DataFrame, groups: int) -> tuple[DataFrame, DataFrame, frozenset]:
    """(lang, word, first, n) for every word of every language; (first, second, n) for pairs that may be frequent, with n counted where
    they are; and the hashes that had to be told apart."""
    alike: frozenset = frozenset()
    while True:
        rows = docs.mapInArrow(_count_words(groups, alike), _WORDS)
        counted = settle("words", rows.groupBy("lang", "word", "first", "second").agg(F.sum("n").alias("n")))
        words = counted.filter("second is null").select("lang", "word", "first", "n")
        several = words.groupBy("first").count().filter("count > 1").select("first").limit(100_001).collect()
        if not several:
            return words, counted.filter("second is not null").select("first", "second", "n"), alike
        now = frozenset(r["first"] & (1 << 64) - 1 for r in several)
        if now <= alike or len(now) > 100_000:
            raise RuntimeError("words share their hashes more often than chance has it")
        alike |= now


# -- groups of prefixes ------------------------------------------------------------------------------------------------


class Groups:
    """Which group a suffix goes to: by the hash of its prefix among the bounds of the groups."""

    def __init__(self, bounds: np.ndarray, large_words: np.ndarray, large_pairs: np.ndarray):
        self.bounds, self.large_words, self.large_pairs = bounds, large_words, large_pairs

    def of(self, words: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(group, whether the pair at the suffix's start is split over groups)."""
        first, second, third = words
        prefix = _prefix_hash(first)
        large = np.isin(first, self.large_words)
        pair = _pair_hash(first, second)
        split = large & (second != NONE) & np.isin(pair, self.large_pairs)
        prefix[large] = _prefix_hash(pair[large])
        prefix[split] = _prefix_hash(pair[split] * np.uint64(3) ^ mixed(third[split]))
        return np.searchsorted(self.bounds, prefix, side="right").astype(np.int32), split


def _prefix_hash(values: np.ndarray) -> np.ndarray:
    return mixed(values + np.uint64(0x2545F4914F6CDD1D))


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) ^ second)


def group_prefixes(words: DataFrame, pairs: DataFrame, suffixes: int, groups: int) -> Groups:
    """Bounds between groups, so that each has about ``suffixes / groups`` suffixes.

    Words are put into bins by hash, more bins than groups, and neighbouring bins together until the budget is reached. What reaches the
    driver is the large words and pairs and the sums of the bins: some entries a group.
    """
    large = suffixes / groups / LARGE_PART
    unsigned = lambda rows, name: np.array([r[name] for r in rows], np.int64).view(np.uint64)
    large_words = np.sort(unsigned(words.filter(F.col("n") > large).select("first").collect(), "first"))
    found = pairs.groupBy("first", "second").agg(F.sum("n").alias("n")).filter(F.col("n") > large / 2).collect()
    large_pairs = np.sort(_pair_hash(unsigned(found, "first"), unsigned(found, "second")))
    bits = max(8, int(groups * 16).bit_length())

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << bits, np.int64)
        for batch in batches:
            first = batch.column(0).to_numpy().view(np.uint64)
            # A large word's suffixes are spread over all bins by their own prefixes; they do not count here.
            small = ~np.isin(first, large_words)
            np.add.at(sums, (_prefix_hash(first[small]) >> np.uint64(64 - bits)).astype(np.int64), batch.column(1).to_numpy()[small])
        at = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(at), pa.array(sums[at])], names=["bin", "n"])

    counted = words.select("first", "n").mapInArrow(bins, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    sums = np.zeros(1 << bits, np.float64)
    for row in counted:
        sums[row["bin"]] += row["n"]
    sums += (suffixes - sums.sum()) / len(sums)
    full = np.floor(np.cumsum(sums) / (suffixes / groups))
    ends = np.flatnonzero(np.diff(full) > 0) + 1
    return Groups(ends.astype(np.uint64) << np.uint64(64 - bits), large_words, large_pairs)


# -- subtrees ----------------------------------------------------------------------------------------------------------


def _pack(words: tuple[np.ndarray, ...], counts: np.ndarray) -> bytes:
    known, ids = np.unique(np.concatenate(words), return_inverse=True)
    wide = np.uint16 if len(known) < 1 << 16 else np.uint32
    head = np.array([len(known), len(counts), wide().itemsize], np.uint32)
    body = b"".join(part.tobytes() for part in (head, known, ids.astype(wide), counts.astype(np.uint32)))
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(dictionary, places in it as three rows, counts)."""
    body = zstandard.ZstdDecompressor().decompress(packed)
    n_known, n, wide = np.frombuffer(body, np.uint32, 3).tolist()
    ids = np.frombuffer(body, np.uint16 if wide == 2 else np.uint32, 3 * n, 12 + 8 * n_known)
    return np.frombuffer(body, np.uint64, n_known, 12), ids.reshape(3, n), np.frombuffer(body, np.uint32, n, len(body) - 4 * n)


def _one_dictionary(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(dictionary, places as three rows, counts) of several packed values together."""
    found = [_unpack(p) for p in packed]
    known = np.unique(np.concatenate([f[0] for f in found]))
    n = sum(len(f[2]) for f in found)
    ids, counts, at = np.empty((3, n), np.uint32), np.empty(n, np.int64), 0
    for own, places, times in found:
        ids[:, at: at + len(times)] = np.searchsorted(known, own).astype(np.uint32)[places]
        counts[at: at + len(times)] = times
        at += len(times)
    return known, ids, counts


_PACKED = pa.schema([("group", pa.int32()), ("split", pa.bool_()), ("packed", pa.binary())])


def _deal(groups: Groups, alike: frozenset) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, alike):
                words, counts = _combined(part.words)
                pair = words[1] != NONE  # a last word of its piece begins no phrase
                words, counts = tuple(w[pair] for w in words), counts[pair]
                if not len(counts):
                    continue
                group, split = groups.of(words)
                key = group.astype(np.int64) * 2 + split
                order = np.argsort(key, kind="stable")
                starts = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
                out = []
                for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
                    at = order[a:b]
                    out.append((int(group[at[0]]), bool(split[at[0]]), _pack(tuple(w[at] for w in words), counts[at])))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), _PACKED.types, strict=True)], schema=_PACKED)

    return run


_NODES = "first long, second long, third long, n long, split boolean"
_NODES_ARROW = pa.schema([("first", pa.int64()), ("second", pa.int64()), ("third", pa.int64()), ("n", pa.int64()), ("split", pa.bool_())])


def _subtree(least: int) -> Callable:
    """Nodes of a group's subtree with ``least`` occurrences; the pairs of split suffixes with any number, to be summed."""

    def run(block: pa.Table) -> pa.Table:
        tables = []
        for split in (False, True):
            packed = [p for p, s in zip(block["packed"].to_pylist(), block["split"].to_pylist(), strict=True) if s == split]
            if not packed:
                continue
            known, ids, counts = _one_dictionary(packed)
            del packed
            (first, second, third), leaf = _sorted_suffixes(*ids, counts)
            del ids, counts
            at = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
            node = np.add.reduceat(leaf, at)
            deep = (third != 0 if known[0] == NONE else np.full(len(third), True)) & (leaf >= least)
            wide = np.full(len(node), True) if split else node >= least
            b = at[wide]
            tables.append(pa.table([
                _signed(np.r_[known[first[deep]], known[first[b]]]), _signed(np.r_[known[second[deep]], known[second[b]]]),
                _signed(np.r_[known[third[deep]], np.zeros(len(b), np.uint64)]), pa.array(np.r_[leaf[deep], node[wide]]),
                pa.array(np.r_[np.zeros(int(deep.sum()), bool), np.full(len(b), split)])], schema=_NODES_ARROW))
        return pa.concat_tables(tables)

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST_COUNT, group_suffixes: int = GROUP_SUFFIXES) -> tuple[DataFrame, DataFrame]:
    """(lang, word, first, n) for every word, and (first, second, third, n) for every phrase of two (third 0) or three words with
    ``least`` occurrences."""
    read = docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(2 * partitions, size // (4 * group_suffixes))
    words, pairs, alike = words_and_pairs(read, groups)
    total = words.agg(F.sum("n")).first()[0] or 0
    if not total:
        return words, docs.sparkSession.createDataFrame([], _NODES).drop("split")
    dealt = read.mapInArrow(_deal(group_prefixes(words, pairs, total, groups), alike), "group int, split boolean, packed binary")
    nodes = settle("nodes", dealt.groupBy("group").applyInArrow(_subtree(least), _NODES))
    summed = nodes.filter("split").groupBy("first", "second", "third").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return words, nodes.filter("not split").drop("split").unionByName(summed)


# -- scores ------------------------------------------------------------------------------------------------------------


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact: a <= l and a <= r, so products stay below 10 ** 38 up to 10 ** 15 occurrences."""
    exact = lambda c: c.cast("decimal(15,0)")
    up = (exact(a) * exact(a)).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", up, exact(left) * exact(right)).cast("long")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, first_rows: int = FIRST_ROWS, absorbed: int = ABSORBED,
                 group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """The first ``first_rows`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Cutting a phrase after k words leaves a first part and a rest; the lowest-scoring cut counts, ties to the smallest k. Phrases
    within a longer candidate with ``absorbed`` percent of their occurrences are dropped.
    """
    words, counted = phrase_counts(docs, least, group_suffixes)
    frequent = settle("frequent-words", words.filter(F.col("n") >= least))
    found = settle("phrases", counted)
    pairs, triples = found.filter("third = 0"), found.filter("third <> 0")
    one = lambda name, at: frequent.select(F.col("first").alias(at), F.col("n").alias(name))
    two = lambda name, a, b: pairs.select(F.col("first").alias(a), F.col("second").alias(b), F.col("n").alias(name))
    cut = lambda k, left, right: F.struct(
        _score(F.col("a"), F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
    inside = triples.select("first", "second", "n").union(triples.select("second", "third", "n")).groupBy("first", "second").agg(
        F.max("n").alias("longer"))
    short = (
        pairs.withColumnRenamed("n", "a").join(inside, ["first", "second"], "left")
        .filter(F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("a"))).drop("longer")
        .join(one("l", "first"), "first").join(one("r", "second"), "second").withColumn("best", cut(1, "l", "r")))
    long = (
        triples.withColumnRenamed("n", "a")
        .join(one("f1", "first"), "first").join(two("f23", "second", "third"), ["second", "third"])
        .join(two("f12", "first", "second"), ["first", "second"]).join(one("f3", "third"), "third")
        .withColumn("best", F.least(cut(1, "f1", "f23"), cut(2, "f12", "f3"))))
    scored = short.select("first", "second", "third", "a", "best").union(long.select("first", "second", "third", "a", "best"))
    spelt = lambda name, at, *more: frequent.select(F.col("first").alias(at), F.col("word").alias(name), *more)
    phrase = F.concat_ws(" ", "w1", "w2", "w3")
    named = (
        scored.join(spelt("w1", "first", "lang"), "first").join(spelt("w2", "second"), "second")
        .join(spelt("w3", "third"), "third", "left").select("lang", phrase.alias("phrase"), "a", "best.l", "best.r", "best.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first_rows)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))  # one row per language, wherever Spark joins it
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
