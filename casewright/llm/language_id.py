"""Language identification by interpolated Kneser-Ney character models.

Training counts every character n-gram of the highest order of every labelled text, by language, in Spark; all lower
orders follow from those counts by joins and groups (Kneser-Ney uses continuation counts, the number of distinct
characters seen before an n-gram). The log probability of a character is a sum over the n-grams that end at it and over
their contexts::

    log p(d | abc) = start + sum of gain(n-gram) + sum of log back-off(context),   gain = log(1 + share / (back-off * p below))

where what a language has not seen adds nothing. So the model is one set of (n-gram hash, language, value) entries that can be
cut anywhere: it is made by joins, dealt to blocks of at most about ``BLOCK_ENTRIES`` entries, and each block becomes a sorted
array of hashes with the entries behind it. The driver passes on one block at a time, and a task that scores texts holds one at a
time. Texts are scored whole, by mean log probability a character (the negative cross-entropy), and the lowest cross-entropy
wins. The model has every n-gram of the training part and any number of languages; a very long text is read in pieces that
overlap by the characters that an n-gram reaches back.

Defined cases: a null text or one without a letter gives ``und`` with score 0, rejected. Ties go to the first language
by code point. Without any training row the model has no language: everything is ``und``, and only texts without a
letter are rejected. Rows that repeat are scored each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import settle, text_bytes

ORDER = 4
#: Entries of a block of the model: what the driver passes on, and a task holds, at once (some 70 MB).
BLOCK_ENTRIES = 4_000_000
DISCOUNT_FLOOR, DISCOUNT_CEILING = 0.1, 0.95
#: Rows that a language needs for a usual cross-entropy of its own; with fewer, that of all languages together holds.
CALIBRATION_ROWS = 8
#: A text is rejected when its cross-entropy is so many spreads above what its language shows for texts of its length, and
#: above the entropy of the language's single characters: then its order of characters says nothing of the language.
REJECTED_SPREADS = 12.0
UNKNOWN = "und"
#: Bytes of text that are scored at once; eight times as many where the blocks of the model take turns.
CHUNK = 1 << 18
#: log probability of any code point where nothing is known of a language.
FLOOR = float(np.log(1.0 / 0x110000))
MULTIPLIER = 0x9E3779B97F4A7C15

_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point the lower-cased letter, or a space. Built from Python's Unicode data when first used."""
    global _LETTERS
    if _LETTERS is None:
        fold = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                fold[c] = ord(low) if len(low) == 1 else c
        _LETTERS = fold
    return _LETTERS


def code_points(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(bytes(data).decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single spaces of all texts, each text starting with a space; and the row of each character."""
    starts = np.zeros(len(data) + 1, np.int64)
    starts[1:] = np.cumsum((data & 0xC0) != 0x80)
    bounds = starts[offsets]
    chars = letters()[code_points(data)]
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    # A space in front of each text.
    chars = np.insert(chars, bounds[:-1], 32)
    rows = np.insert(rows, bounds[:-1], np.arange(len(offsets) - 1))
    keep = np.ones(len(chars), bool)
    if len(chars) > 1:
        keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32) | (rows[1:] != rows[:-1])
    return chars[keep], rows[keep]


def grams(chars: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of 64 bits of the n-gram, valid) ending at each character; valid where it lies within one text."""
    key = np.zeros(len(chars), np.uint64)
    wide = chars.astype(np.uint64)
    valid = np.ones(len(chars), bool)
    for back in range(n - 1, -1, -1):
        key *= np.uint64(MULTIPLIER)
        key[back:] += wide[: len(wide) - back] + np.uint64(1)
    if n > 1:
        valid[: n - 1] = False
        valid[n - 1:] = rows[n - 1:] == rows[: len(rows) - n + 1]
    return key, valid


def gram_keys(texts: pa.Array, order: int) -> np.ndarray:
    """The hashes that ``grams`` gives, of n-grams of up to ``order`` characters."""
    points = np.array(texts.to_pylist(), f"<U{order}").view(np.uint32).reshape(-1, order).astype(np.uint64)
    length = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    key = np.zeros(len(points), np.uint64)
    for place in range(order):
        inside = place < length
        key[inside] = key[inside] * np.uint64(MULTIPLIER) + points[inside, place] + np.uint64(1)
    return key


def entry_keys(key: np.ndarray, n: int | np.ndarray, context: bool | np.ndarray) -> np.ndarray:
    """Hash of an entry: the n-gram's, told apart by its order and by whether it stands as an n-gram or as a context."""
    kind = np.atleast_1d(n).astype(np.uint64) * np.uint64(2) + np.atleast_1d(context).astype(np.uint64)
    tag = kind * np.uint64(0xD1B54A32D192ED03)
    return key ^ tag


def counts(train: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): occurrences of every n-gram of the highest order, over all rows of (text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            data, offsets = text_bytes(batch.column(1))
            names, code = np.unique(langs.astype(str), return_inverse=True)
            found: dict[tuple[int, str], int] = {}
            for chars, rows, fresh in pieces(data, offsets, order):
                key, valid = grams(chars, rows, order)
                at = np.flatnonzero(valid & fresh)
                mine = code[rows[at]]
                for lang in range(len(names)):
                    own = at[mine == lang]
                    _, example, n = np.unique(key[own], return_index=True, return_counts=True)
                    ends = own[example]
                    text = np.stack([chars[ends - order + 1 + i] for i in range(order)], axis=1)
                    listed = np.ascontiguousarray(text).view(f"<U{order}").ravel().tolist() if len(ends) else []
                    for gram, times in zip(listed, n.tolist(), strict=True):
                        found[lang, gram] = found.get((lang, gram), 0) + times
            yield pa.RecordBatch.from_arrays([
                pa.array([str(names[k[0]]) for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
                pa.array(list(found.values()), pa.int64())], ["lang", "gram", "n"])

    found = train.select("lang", "text").mapInArrow(run, "lang string, gram string, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def stretches(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``size`` bytes, at least one row each; a row of more than twice that stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="left"))
        last = min(max(last, first + 1), n)
        if last - first > 1 and offsets[last] - offsets[last - 1] > 2 * size:
            last -= 1
        yield first, last
        first = last


def pieces(data: np.ndarray, offsets: np.ndarray, order: int, size: int = CHUNK) -> Iterator[tuple[np.ndarray, ...]]:
    """(characters, row of each, whether it counts) of all texts, about ``size`` bytes at a time. The space in front of a text does
    not count, nor do the ``order`` - 1 characters that a piece of a long text repeats from the piece before."""
    for first, last in stretches(offsets, size):
        start, end = int(offsets[first]), int(offsets[last])
        if last - first > 1 or end - start <= 2 * size:
            chars, rows = normal(data[start:end], offsets[first: last + 1] - start)
            yield chars, rows + first, np.r_[False, rows[1:] == rows[:-1]]
            continue
        before = np.zeros(0, np.uint32)
        while start < end:
            cut = min(start + size, end)
            while cut < end and data[cut] & 0xC0 == 0x80:
                cut += 1
            chars, _ = normal(data[start:cut], np.array([0, cut - start]))
            if len(before):
                letter = letters()[code_points(data[start: min(start + 8, cut)])[0]] != 32
                chars = np.concatenate([before, chars[1:] if letter or before[-1] == 32 else chars])
            fresh = np.arange(len(chars)) >= max(len(before), 1)
            yield chars, np.full(len(chars), first), fresh
            before, start = chars[-max(order - 1, 1):], cut


def probabilities(top: DataFrame, order: int = ORDER) -> DataFrame:
    """(order, lang, gram, n, share, back) of the n-grams of every order.

    ``n`` counts occurrences at the highest order and distinct preceding characters below it. ``share`` is the
    discounted relative frequency (n - d) / n(context); ``back``, on the rows of a context, is what is left for the
    next lower order. The discount is n1 / (n1 + 2 n2) of the language and order.
    """
    levels, now = [], top.select("lang", "gram", "n")
    for n in range(order, 0, -1):
        levels.append(now.withColumn("order", F.lit(n)))
        if n > 1:
            now = now.groupBy("lang", F.expr(f"substring(gram, 2, {n - 1})").alias("gram")).agg(
                F.count(F.lit(1)).alias("n"))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    every = settle("ngrams", every.withColumn("context", F.expr("substring(gram, 1, length(gram) - 1)")))
    seen = every.groupBy("lang", "order").agg(
        F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("n") == 2, 1).otherwise(0)).alias("n2"))
    discount = seen.withColumn("d", F.least(F.lit(DISCOUNT_CEILING), F.greatest(
        F.lit(DISCOUNT_FLOOR), F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5)))))
    by_context = every.groupBy("lang", "order", "context").agg(F.sum("n").alias("total"))
    shares = (
        every.join(by_context, ["lang", "order", "context"]).join(discount, ["lang", "order"])
        .withColumn("share", (F.col("n") - F.col("d")) / F.col("total"))
    )
    left = shares.groupBy("lang", "order", "context").agg((1 - F.sum("share")).alias("back"))
    return shares.select("lang", "order", "gram", "context", "n", "share").join(
        left.withColumn("back", F.greatest("back", F.lit(1e-6))), ["lang", "order", "context"])


def entries(shares: DataFrame, languages: list[str], order: int) -> tuple[DataFrame, DataFrame]:
    """(key, l, value) of the whole model, and per language (lang, start, plain): the log probability of a character that it
    has not seen, and the entropy of its single characters."""
    below, found = None, []
    for n in range(1, order + 1):
        level = shares.filter(F.col("order") == n)
        if below is None:
            level = level.withColumn("below", F.lit(float(np.exp(FLOOR))))
        else:
            lower = below.select("lang", F.col("gram").alias("tail"), F.col("p").alias("below"))
            level = level.withColumn("tail", F.substring("gram", 2, n - 1)).join(lower, ["lang", "tail"])
        below = settle("level", level.select(
            "lang", "gram", "context", "back", F.expr("share + back * below").alias("p"),
            F.expr("log1p(share / (back * below))").alias("gain")))
        found.append(below.select("lang", "gram", F.lit(n).alias("n"), F.lit(False).alias("context"), F.col("gain").alias("value")))
        if n == 1:
            single = below.groupBy("lang").agg(
                (F.first("back")).alias("back"), (-F.sum(F.expr("p * ln(p)"))).alias("plain")).select(
                "lang", (F.lit(FLOOR) + F.ln("back")).alias("start"), "plain")
        else:
            found.append(below.groupBy("lang", "context").agg(F.first("back").alias("back")).select(
                "lang", F.col("context").alias("gram"), F.lit(n - 1).alias("n"), F.lit(True).alias("context"),
                F.ln("back").alias("value")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    names = pa.array(languages, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, gram, n, context, value = batch.columns
            key = entry_keys(gram_keys(gram, order), n.to_numpy(), context.to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([
                pa.array(key.view(np.int64)), pc.index_in(lang, value_set=names), value.cast(pa.float32(), safe=False)],
                ["key", "l", "value"])

    return every.mapInArrow(run, "key long, l int, value float"), single


@dataclass
class Block:
    """Sorted hashes, and behind each the languages that have it and what it adds to their log probability."""

    keys: np.ndarray
    bounds: np.ndarray
    langs: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(rows: pa.Table) -> Block:
        key = rows.column("key").to_numpy().view(np.uint64)
        lang = rows.column("l").to_numpy()
        by_key = np.lexsort((lang, key))
        keys, first = np.unique(key[by_key], return_index=True)
        return Block(keys, np.r_[first, len(key)].astype(np.int64), lang[by_key], rows.column("value").to_numpy()[by_key])

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``key``, language, value) of every entry of every one of ``key``."""
        # Repeated n-grams are searched once.
        distinct, back_to = np.unique(key, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        at[at == len(self.keys)] = 0
        there = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        here = np.flatnonzero(there[back_to])
        at = at[back_to[here]]
        first, many = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        entry = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        return np.repeat(here, many), self.langs[entry], self.values[entry]


@dataclass
class Model:
    """What is known by language, and the blocks of the n-gram entries as broadcast variables."""

    languages: list[str]
    order: int
    blocks: list[Broadcast] = field(default_factory=list)
    start: np.ndarray | None = None
    plain: np.ndarray | None = None
    sharpness: float = 1.0
    usual: np.ndarray | None = None

    def turns(self) -> Iterator[Block]:
        """The blocks in turn. Where there are several, the one before is let go first."""
        for block in self.blocks:
            yield block.value
            if len(self.blocks) > 1 and getattr(block, "_path", None):  # it can be read again from its file
                block.__dict__.pop("_value", None)

    def scores(self, chars: np.ndarray, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window of each character of ``at``, windows x languages log probabilities): characters with the same ones before
        them share a window."""
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        depth = np.minimum(np.arange(len(chars)) - np.repeat(first, np.diff(np.r_[first, len(chars)])) + 1, self.order)
        keys = {n: grams(chars, rows, n)[0] for n in range(1, self.order + 1)}
        whole = keys[self.order][at]
        short = np.flatnonzero(depth[at] < self.order)
        for n in range(1, self.order):
            mine = at[short[depth[at[short]] == n]]
            whole[short[depth[at[short]] == n]] = entry_keys(keys[n][mine], n, False)
        distinct, window = np.unique(whole, return_inverse=True)
        example = np.zeros(len(distinct), np.int64)
        example[window] = at
        wanted = []
        for n in range(1, self.order + 1):
            able = np.flatnonzero(depth[example] >= n)
            wanted.append((able, entry_keys(keys[n][example[able]], n, False)))
            if n > 1:
                wanted.append((able, entry_keys(keys[n - 1][example[able] - 1], n - 1, True)))
        which, wanted = np.concatenate([w for w, _ in wanted]), np.concatenate([k for _, k in wanted])
        out = np.tile(self.start, (len(distinct), 1))
        for block in self.turns():
            place, lang, value = block.find(wanted)
            out += np.bincount(which[place] * len(self.languages) + lang, value, out.size).reshape(out.shape)
        return window, out

    def cross_entropies(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows x languages) mean negative log probability a character, and the number of characters scored (0 without any
        letter)."""
        n_rows = len(offsets) - 1
        total, length = np.zeros((n_rows, len(self.languages))), np.zeros(n_rows, np.int64)
        lettered = np.zeros(n_rows, bool)
        for chars, rows, fresh in pieces(data, offsets, self.order, CHUNK if len(self.blocks) < 2 else 8 * CHUNK):
            at = np.flatnonzero(fresh)
            first, many = int(rows[0]), int(rows[-1] - rows[0]) + 1
            mine = rows[at] - first
            length[first: first + many] += np.bincount(mine, minlength=many)
            lettered[rows[chars != 32]] = True
            if len(at) and self.languages:
                window, out = self.scores(chars, rows, at)
                for lang in range(len(self.languages)):
                    total[first: first + many, lang] += np.bincount(mine, out[window, lang], many)
        length *= lettered
        return -total / np.maximum(length, 1)[:, None], length

    def judge(self, entropies: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number or -1, score, rejected) of each row."""
        if not self.languages or not len(length):
            return np.full(len(length), -1), np.zeros(len(length)), length == 0
        best = entropies.argmin(axis=1)
        lowest = entropies[np.arange(len(best)), best]
        odds = np.exp(-self.sharpness * np.sqrt(np.maximum(length, 1))[:, None] * (entropies - lowest[:, None]))
        score = 1 / odds.sum(axis=1)
        mean, spread, single = self.usual[best].T if self.usual is not None else (0, np.inf, 0)
        limit = mean + REJECTED_SPREADS * np.sqrt(spread ** 2 + single ** 2 / np.maximum(length, 1))
        limit = np.maximum(limit, self.plain[best])
        none = length == 0
        return np.where(none, -1, best), np.where(none, 0.0, score), none | (lowest > limit)


def train(rows: DataFrame, order: int = ORDER, block_entries: int = BLOCK_ENTRIES) -> Model:
    """A model from (text, lang) rows; rows without a language or text are left out."""
    usable = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    shares = settle("shares", probabilities(settle("counts", counts(usable, order)), order))
    names = [r["lang"] for r in shares.select("lang").distinct().collect()]
    model = Model(sorted(names), order)
    if not names:
        return model
    every, single = entries(shares, model.languages, order)
    known = {r["lang"]: r for r in single.collect()}
    model.start = np.array([known[lang]["start"] for lang in model.languages])
    model.plain = np.array([known[lang]["plain"] for lang in model.languages])
    every = settle("entries", every)
    blocks = -(-every.count() // block_entries)
    if blocks > 1:  # each block is read on its own, so its rows lie together
        every = every.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
        every = settle("blocks", every.repartition("block").sortWithinPartitions("block"))
    for block in range(blocks):
        mine = every.filter(F.col("block") == block).drop("block") if blocks > 1 else every
        model.blocks.append(rows.sparkSession.sparkContext.broadcast(Block.of(mine.toArrow())))
    _calibrate(model, usable)
    return model


def _calibrate(model: Model, usable: DataFrame) -> None:
    """Sharpness of the score and usual cross-entropies, from sums over all training rows."""
    grid = 2.0 ** np.arange(-4, 5)
    number = {lang: i for i, lang in enumerate(model.languages)}
    names = ["rows", "w", "wx", "wxx", *(f"loss{k}" for k in range(len(grid)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(number), len(names)))
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            entropies, length = model.cross_entropies(data, offsets)
            truth = np.array([number[lang] for lang in batch.column(0).to_pylist()], int)
            entropies, length, truth = entropies[length > 0], length[length > 0], truth[length > 0]
            if not len(truth):
                continue
            own = entropies[np.arange(len(truth)), truth]
            gaps = np.sqrt(length)[:, None] * (entropies - entropies.min(axis=1, keepdims=True))
            values = [np.ones(len(own)), length, length * own, length * own ** 2]
            for sharpness in grid:
                p = np.exp(-sharpness * gaps)
                values.append(-np.log(np.maximum(p[np.arange(len(p)), truth] / p.sum(axis=1), 1e-12)))
            np.add.at(sums, truth, np.stack(values, axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(list(number.values()), pa.int64()), *map(pa.array, sums.T)], ["l", *names])

    found = usable.select("lang", "text").mapInArrow(run, "l long, " + ", ".join(f"{n} double" for n in names)).groupBy(
        "l").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    sums = np.zeros((len(number), len(names)))
    sums[found["l"].to_numpy(int)] = found[names].to_numpy()
    pooled = sums.sum(axis=0)
    model.usual = np.tile([0.0, np.inf, 0.0], (len(model.languages), 1))
    if not pooled[0]:
        return
    model.sharpness = float(grid[int(np.argmin(pooled[4:]))])
    for lang, mine in enumerate(sums):
        rows, w, wx, wxx = (mine if mine[0] >= CALIBRATION_ROWS else pooled)[:4]
        if rows >= CALIBRATION_ROWS:
            around = max(wxx - wx * wx / w, 0.0)  # sum of weighted squares around the mean
            model.usual[lang] = wx / w, np.sqrt(around / w), np.sqrt(around / rows)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected for each row, from the text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            best, score, rejected = model.judge(*model.cross_entropies(data, offsets))
            names = np.array([*model.languages, UNKNOWN], object)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(names[best].tolist(), pa.string()), pa.array(score),
                pa.array(rejected), batch.column(2)], ["doc_id", "lang_pred", "score", "rejected", "text_hash"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean, text_hash long")


def held_out(doc_id) -> object:
    """Whether a row is kept out of training: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
