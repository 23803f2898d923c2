"""Repeated byte strings by range-partitioned suffix sorting.

Suffixes are taken at anchors (see ``pieces``), range-partitioned by their leading bytes (the anchor) at splitters sampled from the
texts, and sorted inside each bucket by multikey quicksort over tokens of eight bytes: suffixes that share a token go
on to the next one, all others are done. Leading bytes that are equal never lie on both sides of a splitter, and every
string of 50 bytes is judged at its anchor, so no comparison across buckets is left over.

Defined cases: a null text is empty. Matches do not cross documents. Rows without an id count as later than all others
and not as repeats of each other; rows that share an id are not repeats of each other, and get a row each. A text under 50
bytes has nothing removed. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import release, settle
from casewright.llm.pieces import Batch, Routes, Tokens, ragged, repeated_spans, spans
from casewright.llm.words import mixed

WINDOW_BYTES = 50
#: From 9 to 16. Shorter anchors make fewer, longer pieces, and more of them meet by chance.
ANCHOR_BYTES = 12


def leading(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as one number whose order is that of the bytes; zeros follow the end."""
    out = np.zeros(len(data) + 8, np.uint64)
    out[: len(data)] = data
    for step in (1, 2, 4):
        out[:-step] = out[:-step] << np.uint64(8 * step) | out[step:]
        out[-step:] <<= np.uint64(8 * step)
    return out[: len(data)]


class Bytes(Tokens):
    def __init__(self, window: int = WINDOW_BYTES, k: int = ANCHOR_BYTES) -> None:
        self.window = window
        self.k = self.lead = k

    def read(self, data, offsets):
        first = leading(data)
        gram = first * np.uint64(0x9E3779B97F4A7C15)
        rest = self.k - 8
        if len(gram) > rest:
            gram[:-rest] ^= mixed(first[rest:])
        return data, offsets, mixed(gram), lambda a, b: (a, b)

    def bucket(self, gram, data, at, routes: Routes):
        if not len(routes.splitters) or not len(at):
            return np.zeros(len(at), np.int64)
        first = leading(data)
        split = np.frombuffer(routes.splitters.tobytes(), ">u8").reshape(-1, 2)[:, 0].astype(np.uint64)
        lead = first[at]
        low = np.searchsorted(split, lead, side="left")
        out = np.searchsorted(split, lead, side="right")
        tied = np.flatnonzero(low != out)  # the second eight bytes decide
        if len(tied):
            whole = np.array([data[i: i + self.k].tobytes() for i in at[tied].tolist()], "S16")
            out[tied] = np.searchsorted(routes.splitters, whole, side="right")
        return out.astype(np.int64)


def multikey_classes(first: np.ndarray, starts: np.ndarray, offsets: list[np.ndarray], classes: np.ndarray) -> tuple[
        np.ndarray, np.ndarray]:
    """Sort suffixes that are in the same class by the eight bytes at each of ``offsets`` in turn.

    Returns (members, class) of the suffixes that share all tokens with another one of their class; members of a class
    stand together. A class falls apart at the first token that differs, and members left alone are not looked at again.
    """
    member = np.argsort(classes, kind="stable")
    now = classes[member]
    member, now = _together(member, now)
    for offset in offsets:
        if not len(member):
            break
        token = first[starts[member] + offset[member]]
        order = np.lexsort((token, now))
        member, now, token = member[order], now[order], token[order]
        new = np.r_[True, (now[1:] != now[:-1]) | (token[1:] != token[:-1])]
        member, now = _together(member, np.cumsum(new))
    return member, now


def _together(member: np.ndarray, now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(member):
        return member, now
    same = now[1:] == now[:-1]
    several = np.r_[False, same] | np.r_[same, False]
    return member[several], now[several]


def _lowest(ids: np.ndarray, now: np.ndarray) -> np.ndarray:
    """The smallest id of each member's class; classes stand together."""
    heads = np.flatnonzero(np.r_[True, now[1:] != now[:-1]])
    return np.repeat(np.minimum.reduceat(ids, heads), np.diff(np.r_[heads, len(ids)]))


def judged(batch: Batch, window: int = WINDOW_BYTES, k: int = ANCHOR_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, start, end) of the repeats among the pieces of a bucket, from the piece's first byte on."""
    first = leading(batch.data)
    starts = np.cumsum(batch.lengths) - batch.lengths
    ids = batch.doc_ids[batch.doc]
    anchor = starts + batch.left
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    zero = np.zeros(len(batch), np.int64)
    # Suffixes at the anchors that share their leading tokens, in more than one document.
    member, group = multikey_classes(first, anchor, [zero, zero + k - 8], zero)
    if not len(member):
        return zero[:0], zero[:0], zero[:0]
    low, high = _lowest(ids[member], group), -_lowest(-ids[member], group)
    member, group = member[low != high], group[low != high]
    # Equal pieces: the smallest document stands for them, the others are repeats as a whole.
    at, lengths = starts[member], batch.lengths[member]
    whole = np.unique(np.stack([group, batch.left[member], lengths]), axis=1, return_inverse=True)[1].ravel()
    steps = [np.minimum(step, lengths - 8) for step in range(0, int(lengths.max(initial=8)), 8)]
    equal, named = multikey_classes(first, at, steps, whole)
    alone = np.ones(len(member), bool)
    if len(equal):
        own = ids[member[equal]]
        low = _lowest(own, named)
        later = member[equal[own > low]]
        found.append((later, np.zeros(len(later), np.int64), batch.windows[later] + window - 1))
        alone[equal[own > low]] = False
    member, group = member[alone], group[alone]
    # What is left differs somewhere: its strings are sorted one by one, among those with the same anchor and place.
    order, group = _together(np.argsort(group, kind="stable"), np.sort(group, kind="stable"))
    member = member[order]
    for part in _parts(batch.windows[member], group):
        windows = batch.windows[member[part]]
        piece = np.repeat(member[part], windows)
        shift = ragged(np.zeros(len(windows), np.int64), windows)
        place = np.repeat(group[part], windows) * 256 + (batch.left[piece] - shift)
        steps = [np.full(len(piece), s) for s in (*range(0, window - 8, 8), window - 8)]
        inside, named = multikey_classes(first, starts[piece] + shift, steps, place)
        if len(inside):
            own = ids[piece[inside]]
            hit = inside[own > _lowest(own, named)]
            found.append((piece[hit], shift[hit], shift[hit] + window))
    if not found:
        return zero[:0], zero[:0], zero[:0]
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _parts(windows: np.ndarray, group: np.ndarray, size: int = 1 << 18) -> Iterator[slice]:
    """Runs of whole groups with about ``size`` windows."""
    if not len(group):
        return
    heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    total = np.add.reduceat(windows, heads)
    chunk = (np.cumsum(total) - total) // size
    edges = heads[np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])]
    for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(group)], strict=True):
        yield slice(lo, hi)


def removed_spans(docs: DataFrame, window: int = WINDOW_BYTES) -> DataFrame:
    """doc_id, text_hash and lists of packed byte ranges to remove, for documents that have any."""
    return repeated_spans(docs, Bytes(window), lambda batch: judged(batch, window))


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("n_spans", pa.int64()), ("kept", pa.binary())])


def without_repeats(docs: DataFrame, window: int = WINDOW_BYTES, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), and ``kept``, the remaining bytes
    in order (with ``digest``, ``kept_sha256`` instead)."""
    found = settle("byte-spans", removed_spans(docs, window))
    release(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[], [], [], []]
            for text, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (text or "").encode()
                starts, ends = merged(packed)
                keep, at = [], 0
                for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
                    keep.append(data[at:start])
                    at = end
                keep.append(data[at:])
                left = b"".join(keep)
                for column, value in zip(rows, (len(data), len(data) - len(left), len(starts), (
                        hashlib.sha256(left).hexdigest() if digest else left)), strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string() if digest else pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]], names)

    kept = "kept_sha256 string" if digest else "kept binary"
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", kept.split()[0]]
    return with_spans(docs, found).mapInArrow(run, f"doc_id long, n_bytes long, n_removed long, n_spans long, {kept}")


def with_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text, spans) for every row of ``docs``; null ids find their spans too."""
    last = F.lit(np.iinfo(np.int64).max)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    same = (F.coalesce(F.col("d.doc_id"), last) == F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    return own.alias("d").join(found.alias("s"), same, "left").select("d.doc_id", "d.text", "s.spans")


def merged(packed: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(packed or []), np.int64).reshape(-1, 2)
    return spans(pairs[:, 0], pairs[:, 1])
