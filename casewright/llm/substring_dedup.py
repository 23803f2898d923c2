"""Repeated word sequences by FM-indexes over content shards.

The pieces of all texts (see ``pieces``) are dealt to shards by their anchor, so all copies of a window are in one
shard, and a document is streamed only through the shards that can know its windows. Each shard indexes its distinct
pieces; backward search over the wavelet matrix gives matching statistics of the streamed pieces, and the places that
reach a whole window are reported with the smallest document that the window starts in.

Defined cases: words are runs of characters other than space and 0x09-0x0D, unchanged. A null text has no words. Windows
do not cross documents. Rows without an id count as later than all others and not as repeats of each other; rows that share
an id are not repeats of each other, and get a row each. An empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casewright.llm.common import release, settle
from casewright.llm.fm_index import DEPTH, FMIndex
from casewright.llm.pieces import Batch, Routes, Tokens, _same, pairs, ragged, repeated_spans
from casewright.llm.suffix_dedup import merged, with_spans
from casewright.llm.words import mixed, words_of

WINDOW_WORDS = 13
ANCHOR_WORDS = 3


class WordTokens(Tokens):
    def __init__(self, window: int = WINDOW_WORDS, k: int = ANCHOR_WORDS) -> None:
        self.window, self.k = window, k

    def read(self, data, offsets):
        raw = data.tobytes()
        texts = [b" ".join(raw[a:b].split()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        data = np.frombuffer(b"".join(texts), np.uint8)
        found = words_of(data, np.cumsum([0, *map(len, texts)]))
        bounds = np.searchsorted(found.rows, np.arange(len(texts) + 1))
        gram = found.hashes.copy()
        for step in range(1, self.k):
            gram[: len(gram) - step] = mixed(gram[: len(gram) - step] * np.uint64(5) + found.hashes[step:])
        return data, bounds, gram, lambda a, b: (found.starts[a], found.ends[b - 1])

    def bucket(self, gram, data, at, routes: Routes):
        return (gram % np.uint64(routes.buckets)).astype(np.int64)


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """A number from 1 on for each word, equal for equal words only, and the count of numbers with 0."""
    values, example, number = np.unique(hashes, return_index=True, return_inverse=True)
    lengths = ends - starts
    model = example[number]
    right = lengths == lengths[model]
    right[right] = _same(data, starts[right], starts[model[right]], lengths[right])
    if not right.all():  # two words with one hash: number them by their bytes
        names: dict[bytes, int] = {}
        raw = data.tobytes()
        number = np.array([names.setdefault(raw[a:b], len(names)) for a, b in zip(
            starts.tolist(), ends.tolist(), strict=True)])
        return number + 1, len(names) + 1
    return number + 1, len(values) + 1


def judged(batch: Batch, window: int = WINDOW_WORDS, k: int = ANCHOR_WORDS) -> tuple[
        np.ndarray, np.ndarray, np.ndarray]:
    """(piece, start, end) in words of the repeats among the pieces of a shard, from the piece's first word on."""
    ids = batch.doc_ids[batch.doc]
    words = batch.windows + window - 1
    found = words_of(batch.data, np.concatenate([[0], np.cumsum(batch.lengths)]))
    first = np.cumsum(words) - words
    # Shapes of pieces by hash; only pieces whose anchor stands in several documents are looked at further.
    anchor = first + batch.left
    gram = found.hashes[anchor]
    for step in range(1, k):
        gram = mixed(gram * np.uint64(5) + found.hashes[anchor + step])
    order = np.lexsort((ids, gram))
    heads = np.flatnonzero(np.r_[True, gram[order][1:] != gram[order][:-1]])
    tails = np.r_[heads[1:], len(order)] - 1
    several = np.repeat(ids[order[heads]] != ids[order[tails]], tails - heads + 1)
    member = np.sort(order[several])
    if not len(member):
        return member, member, member
    # The distinct ones of these are the shard's text, a zero after each, with the smallest document of each.
    chosen = ragged(first[member], words[member])
    number, sigma = word_numbers(batch.data, found.starts[chosen], found.ends[chosen], found.hashes[chosen])
    lengths = words[member]
    begin = np.cumsum(lengths) - lengths
    piece, model = _distinct(number, begin, lengths, ids[member])
    text = np.zeros(int((lengths[piece] + 1).sum()), np.int64)
    at = np.cumsum(lengths[piece] + 1) - lengths[piece] - 1
    text[ragged(at, lengths[piece])] = number[ragged(begin[piece], lengths[piece])]
    lowest = ids[member][piece]
    out = [_whole(batch, member, model, ids, window)]
    index = FMIndex(text, sigma, max(DEPTH, window))
    owner = np.repeat(np.arange(len(piece)), lengths[piece] + 1)
    # Stream the pieces through the index, by the places where a window ends.
    windows = lengths[piece] - window + 1
    shift = ragged(np.zeros(len(windows), np.int64), windows)
    source = np.repeat(np.arange(len(piece)), windows)
    length, low, high = index.matching(text, at[source] + shift + window, window)
    full = np.flatnonzero(length == window)
    if len(full):
        keys, back = np.unique(low[full], return_inverse=True)
        top = np.zeros(len(keys), np.int64)
        top[back] = high[full]
        places = ragged(keys, top - keys)
        least = np.minimum.reduceat(lowest[owner[index.order[places]]], np.cumsum(top - keys) - (top - keys))
        hit = full[lowest[source[full]] > least[back]]
        # What is found in a stand-in holds for all equal pieces under its id.
        own = np.flatnonzero(ids[member] == ids[member[model]])
        found, at = pairs(piece[source[hit]], model[own])
        start = shift[hit[found]]
        out.append((member[own[at]], start, start + window))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _distinct(number: np.ndarray, begin: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> tuple[
        np.ndarray, np.ndarray]:
    """(pieces that stand for all equal ones, each with the smallest id; for every piece its stand-in)."""
    weight = np.uint64(0x9E3779B97F4A7C15) ** np.arange(int(lengths.max()), dtype=np.uint64)
    shift = ragged(np.zeros(len(lengths), np.int64), lengths)
    value = mixed(number.astype(np.uint64)) * weight[shift]
    code = mixed(np.add.reduceat(value, begin) + lengths.astype(np.uint64))
    order = np.lexsort((ids, code))
    head = np.r_[True, code[order][1:] != code[order][:-1]]
    stand = np.empty(len(order), np.int64)
    stand[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    same = lengths == lengths[stand]
    same[same] = _same(number, begin[same], begin[stand[same]], lengths[same])
    stand[~same] = np.flatnonzero(~same)  # equal hash, other words: stands for itself
    return np.unique(stand), stand


def _whole(batch: Batch, member: np.ndarray, model: np.ndarray, ids: np.ndarray, window: int) -> tuple[
        np.ndarray, np.ndarray, np.ndarray]:
    """Pieces equal to one of an earlier document are repeats from end to end."""
    later = member[ids[member] > ids[member[model]]]
    return later, np.zeros(len(later), np.int64), batch.windows[later] + window - 1


def removed_spans(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, text_hash and lists of packed word ranges to remove, for documents that have any."""
    return repeated_spans(docs, WordTokens(window), lambda batch: judged(batch, window))


def without_repeats(docs: DataFrame, window: int = WINDOW_WORDS, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, and ``kept``, the words left, joined by one space (with
    ``digest``, ``kept_sha256`` instead). Windows are of 3 to 200 words."""
    if not ANCHOR_WORDS <= window <= 200:  # a piece's counts are stored in a byte each
        raise ValueError(f"no window of {window} words")
    found = settle("word-spans", removed_spans(docs, window))
    release(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[], [], []]
            for text, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                starts, ends = merged(packed)
                keep, at = [], 0
                for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
                    keep.extend(words[at:start])
                    at = end
                keep.extend(words[at:])
                left = b" ".join(keep)
                for column, value in zip(rows, (len(words), len(words) - len(keep), (
                        hashlib.sha256(left).hexdigest() if digest else left.decode())), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(
                rows, (pa.int64(), pa.int64(), pa.string()), strict=True)]], names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "kept"]
    return with_spans(docs, found).mapInArrow(run, f"doc_id long, n_words long, n_removed long, {names[3]} string")
