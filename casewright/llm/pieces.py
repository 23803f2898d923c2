"""Cutting token streams into pieces that meet their repeats: shared by the two substring operators.

A window is a fixed number of consecutive tokens of one text. Its anchor is the k-gram of tokens with the smallest hash
in it (the leftmost of equals), which depends on the window's own tokens only. So two equal windows have equal
anchors at equal places, wherever they stand. Neighbouring windows mostly share their anchor; a run of windows with one
anchor is a piece, stored once with its tokens. Pieces go to the bucket of their anchor, and all windows equal to a
window of the bucket are in the bucket.

Before pieces move, equal pieces of one task are combined: the one of the smallest document is sent, those of other
documents are known to be repeats, and further ones of the same document travel as places only (twins), which share
what is found for the piece. An anchor that is very frequent in a sample of the texts (a passage that a large part of all
documents share) is not a bucket of its own: its windows are sent one by one, each to the bucket of its hash; its pieces
are combined before they are split, so copies of a passage take no memory by the window. The sample decides only where
pieces go, never what is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import text_bytes
from casewright.llm.words import mixed

FLUSH_BYTES = 12 << 20
#: Texts of one repeated word have a piece at each token.
FLUSH_PIECES = 2 << 20
STRETCH_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
#: Rows sampled to place splitters and to find very frequent anchors.
SAMPLE_ROWS = 4000
HITS = -1
#: The mark of pieces that are sent window by window.
SPLIT = -2
LEVEL = 3
LOW32 = np.uint64(0xFFFFFFFF)


@dataclass
class Runs:
    """Pieces of a stretch of texts: first window, number of windows and anchor, as token numbers of the stretch."""

    first: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchored_runs(gram: np.ndarray, bounds: np.ndarray, window: int, k: int) -> Runs:
    """Pieces from the k-gram hash at each token; ``bounds`` are the token offsets of the texts."""
    n = int(bounds[-1])
    lengths = np.diff(bounds)
    long = lengths >= window
    empty = np.zeros(0, np.int64)
    if not long.any():
        return Runs(empty, empty, empty)
    key = (gram & ~LOW32) | np.arange(len(gram), dtype=np.uint64)
    anchor = (sliding_min(key, window - k + 1) & LOW32).astype(np.int64)
    step = np.zeros(n + 1, np.int8)
    step[bounds[:-1][long]] += 1
    step[bounds[1:][long] - window + 1] -= 1
    valid = np.flatnonzero(np.cumsum(step[:-1], dtype=np.int8))
    at = anchor[valid]
    heads = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return Runs(valid[heads], np.diff(np.r_[heads, len(valid)]), at[heads])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0] + 1, ... for each slice, one slice after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def pairs(wanted: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``wanted``, index into ``keys``) of all pairs of equal values."""
    order = np.argsort(keys, kind="stable")
    low, high = np.searchsorted(keys[order], wanted, side="left"), np.searchsorted(keys[order], wanted, side="right")
    return np.repeat(np.arange(len(wanted)), high - low), order[ragged(low, high - low)]


@dataclass
class Batch:
    """Pieces with what is needed to judge them: token content as bytes, and the document they come from."""

    data: np.ndarray  # bytes of all pieces, one after the other
    lengths: np.ndarray  # bytes of each
    left: np.ndarray  # windows of the piece that start before or at the anchor: anchor - first window, in tokens
    windows: np.ndarray
    first: np.ndarray  # first token, counted in the document
    doc: np.ndarray  # number of the document in the two arrays below
    doc_ids: np.ndarray
    text_hashes: np.ndarray
    # Further places of a piece under the same doc_id: number of the piece, first token there, number of the document.
    twin_of: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    twin_first: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    twin_doc: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __len__(self) -> int:
        return len(self.lengths)


_FIELDS = (("lengths", np.uint32), ("left", np.uint8), ("windows", np.uint8), ("first", np.int64), ("doc", np.uint32))
_TWIN_FIELDS = (("twin_of", np.uint32), ("twin_first", np.int64), ("twin_doc", np.uint32))


def packed(batch: Batch) -> bytes:
    """A batch as compressed bytes. Documents are kept once, places as differences."""
    used, doc = np.unique(np.r_[batch.doc, batch.twin_doc], return_inverse=True)
    head = np.array([len(batch), len(used), len(batch.data), len(batch.twin_of)], np.int64)
    values = {"lengths": batch.lengths, "left": batch.left, "windows": batch.windows}
    for name, places in (("first", batch.first), ("doc", doc[: len(batch)]), ("twin_of", batch.twin_of),
                         ("twin_first", batch.twin_first), ("twin_doc", doc[len(batch):])):
        values[name] = np.diff(places, prepend=0)
    parts = [head.tobytes(), batch.doc_ids[used].tobytes(), batch.text_hashes[used].tobytes()]
    for name, kind in _FIELDS + _TWIN_FIELDS:
        wide = values[name].astype(kind)
        size = np.dtype(kind).itemsize
        parts.append(wide.view(np.uint8).reshape(-1, size).T.tobytes())  # equal bytes together compress well
    parts.append(batch.data.tobytes())
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(parts))


def unpacked(blobs: list[bytes]) -> Batch:
    """All batches of a bucket as one."""
    tool, found, n_docs, n_pieces = zstandard.ZstdDecompressor(), [], 0, 0
    for blob in blobs:
        raw = tool.decompress(blob)
        n, docs, size, twins = np.frombuffer(raw, np.int64, 4).tolist()
        at = 32
        ids = np.frombuffer(raw, np.int64, docs, at)
        hashes = np.frombuffer(raw, np.int64, docs, at + 8 * docs)
        at += 16 * docs
        values = {}
        for name, kind in _FIELDS + _TWIN_FIELDS:
            width, rows = np.dtype(kind).itemsize, twins if name.startswith("twin") else n
            values[name] = np.ascontiguousarray(
                np.frombuffer(raw, np.uint8, rows * width, at).reshape(width, rows).T).view(kind).ravel()
            at += rows * width
        found.append((np.frombuffer(raw, np.uint8, size, at), values["lengths"].astype(np.int64),
                      values["left"].astype(np.int64), values["windows"].astype(np.int64), np.cumsum(values["first"]),
                      np.cumsum(values["doc"], dtype=np.uint32).astype(np.int64) + n_docs, ids, hashes,
                      np.cumsum(values["twin_of"], dtype=np.uint32).astype(np.int64) + n_pieces,
                      np.cumsum(values["twin_first"]),
                      np.cumsum(values["twin_doc"], dtype=np.uint32).astype(np.int64) + n_docs))
        n_docs += docs
        n_pieces += n
    return Batch(*[np.concatenate(column) for column in zip(*found, strict=True)])


def spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open intervals, as sorted disjoint intervals that do not touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > ends[:-1]]
    heads = np.flatnonzero(new)
    return starts[heads], ends[np.r_[heads[1:] - 1, len(ends) - 1]]


def hit_rows(doc: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> Iterator[
        tuple[int, int, bytes]]:
    """(doc_id, text_hash, merged spans as int64 pairs) for each document with hits."""
    if not len(doc):
        return
    used, number = np.unique(doc, return_inverse=True)
    stride = int(ends.max()) + 1  # documents side by side do not touch
    low, high = spans(number * stride + starts, number * stride + ends)
    owner = low // stride
    raw = np.stack([low - owner * stride, high - owner * stride], axis=1).astype(np.int64).tobytes()
    edges = [*(16 * np.searchsorted(owner, np.arange(len(used)))).tolist(), len(raw)]
    yield from zip(ids[used].tolist(), hashes[used].tolist(), [raw[a:b] for a, b in pairwise(edges)], strict=True)


@dataclass
class Routes:
    buckets: int
    frequent: np.ndarray  # sorted hashes of very frequent anchors
    splitters: np.ndarray  # first bytes of anchors, sorted; used by range partitioning only


class Tokens:
    """How one kind of token is read. ``window`` tokens make a window and ``k`` an anchor, of which range partitioning
    looks at the first ``lead`` bytes."""

    window: int
    k: int
    lead: int = 16

    def read(self, data: np.ndarray, offsets: np.ndarray) -> tuple[
            np.ndarray, np.ndarray, np.ndarray, Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]]:
        """(bytes, token offsets of the texts, k-gram hash at each token, byte range of a token range)."""
        raise NotImplementedError

    def bucket(self, gram: np.ndarray, data: np.ndarray, at: np.ndarray, routes: Routes) -> np.ndarray:
        """The bucket of anchors with these hashes and first bytes."""
        raise NotImplementedError


def _cover(tokens: Tokens, gram: np.ndarray, first: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """A hash of all the content of pieces: anchors-sized grams that cover them."""
    cover = mixed(gram[first] + windows.astype(np.uint64))
    last = first + windows + tokens.window - 1 - tokens.k
    for step in range(tokens.k, 2 * tokens.window, tokens.k):
        cover = mixed(cover * np.uint64(3) + gram[np.minimum(first + step, last)])
    return cover


def _cut(tokens: Tokens, routes: Routes, data: np.ndarray, offsets: np.ndarray, base: int) -> dict[str, np.ndarray]:
    """The pieces of a stretch of whole texts; ``base`` is the number of its first document."""
    data, bounds, gram, byte_range = tokens.read(data, offsets)
    runs = anchored_runs(gram, bounds, tokens.window, tokens.k)
    first, windows, anchor = runs.first, runs.windows, runs.anchor
    starts, ends = byte_range(first, first + windows + tokens.window - 1)
    doc = np.searchsorted(bounds, first, side="right") - 1
    at, _ = byte_range(anchor, anchor + 1)
    bucket = tokens.bucket(gram[anchor], data, at, routes)
    bucket[np.isin(gram[anchor], routes.frequent)] = SPLIT
    small = {"lengths": ends - starts, "left": anchor - first, "windows": windows, "first": first - bounds[doc], "doc": doc + base,
             "bucket": bucket}
    return {"starts": starts, "cover": _cover(tokens, gram, first, windows), "data": data,
            **{name: column.astype(np.int32) for name, column in small.items()}}


def _windows(tokens: Tokens, routes: Routes, data: np.ndarray, piece: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Each window of the pieces as a piece of its own, in order, in the bucket of its hash."""
    before = np.cumsum(np.r_[0, piece["lengths"]])
    _, bounds, gram, byte_range = tokens.read(data[ragged(piece["starts"], piece["lengths"])], before)
    of = np.repeat(np.arange(len(piece["windows"])), piece["windows"])
    shift = ragged(np.zeros(len(piece["windows"]), np.int64), piece["windows"])
    first = bounds[of] + shift
    low, high = byte_range(first, first + tokens.window)
    cover = _cover(tokens, gram, first, np.ones(len(first), np.int64))
    small = {"lengths": high - low, "left": piece["left"][of] - shift, "windows": np.ones(len(first)), "first": piece["first"][of] + shift,
             "doc": piece["doc"][of], "bucket": cover % np.uint64(routes.buckets)}
    return {"starts": piece["starts"][of] + low - before[of], "cover": cover,
            **{name: column.astype(np.int32) for name, column in small.items()}}


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the slices at ``a`` and ``b`` hold the same bytes."""
    out = np.zeros(len(a), bool)
    for first in range(0, len(a), 1 << 15):
        part = slice(first, first + (1 << 15))
        differ = data[ragged(a[part], lengths[part])] != data[ragged(b[part], lengths[part])]
        ends = np.cumsum(lengths[part])
        wrong = np.r_[0, np.cumsum(differ)]
        out[part] = wrong[ends] == wrong[ends - lengths[part]]
    return out


def _equal(data: np.ndarray, piece: dict[str, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces equal to one that stays, the one that stays: of the smallest id)."""
    n = len(piece["starts"])
    order = np.lexsort((ids[piece["doc"]], piece["cover"]))
    cover = piece["cover"][order]
    head = np.maximum.accumulate(np.where(np.r_[True, cover[1:] != cover[:-1]], np.arange(n), 0))
    other = np.flatnonzero(head != np.arange(n))
    mine, model = order[other], order[head[other]]
    for name in ("lengths", "left"):
        same = piece[name][mine] == piece[name][model]
        mine, model = mine[same], model[same]
    same = _same(data, piece["starts"][mine], piece["starts"][model], piece["lengths"][mine])
    return mine[same], model[same]


def _flush(tokens: Tokens, routes: Routes, cut: list[dict[str, np.ndarray]], ids: np.ndarray, hashes: np.ndarray) -> Iterator[
        tuple[int, int, int, bytes]]:
    """Rows (bucket, doc_id, text_hash, bytes): packed pieces by bucket, and hits found within the flush. Empties ``cut``."""
    sizes = np.cumsum([0, *[len(c["data"]) for c in cut]])
    data = np.concatenate([c["data"] for c in cut])
    col = {k: np.concatenate([c[k] for c in cut]) for k in cut[0] if k != "data"}
    col["starts"] = np.concatenate([c["starts"] + s for c, s in zip(cut, sizes, strict=False)])
    cut.clear()
    if not len(col["starts"]):  # no text of the flush holds a window
        return
    mine, model = _equal(data, col, ids)
    after = ids[col["doc"][mine]] > ids[col["doc"][model]]
    later = mine[after]
    first = col["first"][later]
    yield from ((HITS, *row) for row in hit_rows(
        col["doc"][later], first, first + col["windows"][later] + tokens.window - 1, ids, hashes))
    # Equal pieces under the model's own id are no repeats of it, but share its repeats: they go along as places.
    twin, twin_of = mine[~after], model[~after]
    twin_first, twin_doc = col["first"][twin], col["doc"][twin]
    stays = np.ones(len(col["starts"]), bool)
    stays[mine] = False
    split = stays & (col["bucket"] == SPLIT)
    if split.any():  # equal pieces are combined before, and equal windows of what is left after
        whole, parted = np.flatnonzero(stays & ~split), np.flatnonzero(split)
        place = np.zeros(len(stays), np.int64)
        place[whole] = np.arange(len(whole))
        place[parted] = np.cumsum(np.r_[0, col["windows"][parted]])[:-1]
        single = _windows(tokens, routes, data, {k: v[parted] for k, v in col.items()})
        mine, model = _equal(data, single, ids)
        stands = np.arange(len(single["starts"]))
        stands[mine] = model
        is_later = ids[single["doc"]] > ids[single["doc"][stands]]
        is_twin = (stands != np.arange(len(stands))) & ~is_later
        # The windows of twins of split pieces, and what each is equal to.
        of_split = split[twin_of]
        count = col["windows"][twin[of_split]]
        shift = ragged(np.zeros(len(count), np.int64), count)
        own = np.repeat(place[twin_of[of_split]], count) + shift
        own_first = np.repeat(twin_first[of_split], count) + shift
        own_doc = np.repeat(twin_doc[of_split], count)
        gone = is_later[own]
        doc, first = np.r_[single["doc"][is_later], own_doc[gone]], np.r_[single["first"][is_later], own_first[gone]]
        yield from ((HITS, *row) for row in hit_rows(doc, first, first + tokens.window, ids, hashes))
        alone = np.flatnonzero(stands == np.arange(len(stands)))
        new = np.zeros(len(stands), np.int64)
        new[alone] = len(whole) + np.arange(len(alone))
        twin_of = np.r_[place[twin_of[~of_split]], new[stands[is_twin]], new[stands[own[~gone]]]]
        twin_first = np.r_[twin_first[~of_split], single["first"][is_twin], own_first[~gone]]
        twin_doc = np.r_[twin_doc[~of_split], single["doc"][is_twin], own_doc[~gone]]
        col = {k: np.concatenate([v[whole], single[k][alone]]) for k, v in col.items()}
        at = np.arange(len(col["starts"]))
    else:
        at = np.flatnonzero(stays)
    at = at[np.argsort(col["bucket"][at], kind="stable")]
    buckets = col["bucket"][at]
    place = np.zeros(len(col["starts"]), np.int64)
    place[at] = np.arange(len(at))
    twin_of = place[twin_of]
    order = np.argsort(twin_of, kind="stable")
    twin_of, twin_first, twin_doc = twin_of[order], twin_first[order], twin_doc[order]
    heads = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    for lo, hi in zip(heads, [*heads[1:], len(at)], strict=True):
        part = at[lo:hi]
        lengths = col["lengths"][part]
        own = slice(*np.searchsorted(twin_of, [lo, hi]).tolist())
        yield int(buckets[lo]), 0, 0, packed(Batch(
            data[ragged(col["starts"][part], lengths)], lengths, col["left"][part], col["windows"][part],
            col["first"][part], col["doc"][part], ids, hashes, twin_of[own] - lo, twin_first[own], twin_doc[own]))


_SENT = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("data", pa.binary())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("spans", pa.binary())])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 200) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema,
                                                                                strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema,
                                                                            strict=True)], schema=schema)


def _stretches(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + STRETCH_BYTES, side="left"))
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _sender(tokens: Tokens, held) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        routes: Routes = held.value
        cut: list[dict] = []
        ids: list[np.ndarray] = []
        hashes: list[np.ndarray] = []
        docs = size = n_pieces = 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last in _stretches(offsets):
                here = offsets[first: last + 1]
                cut.append(_cut(tokens, routes, data[here[0]: here[-1]], here - here[0], docs))
                ids.append(batch.column(0)[first:last].fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False))
                hashes.append(batch.column(2)[first:last].to_numpy(zero_copy_only=False))
                docs += last - first
                size += int(here[-1] - here[0])
                n_pieces += len(cut[-1]["starts"])
                if size >= FLUSH_BYTES or n_pieces >= FLUSH_PIECES:
                    yield from _flush(tokens, routes, cut, np.concatenate(ids), np.concatenate(hashes))
                    cut, ids, hashes, docs, size, n_pieces = [], [], [], 0, 0, 0
        if cut:
            yield from _flush(tokens, routes, cut, np.concatenate(ids), np.concatenate(hashes))

    return lambda batches: _batches(rows(batches), _SENT)


def _judge(judge: Callable[[Batch], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Callable:
    """Reads the rows of a partition in order of bucket; ``judge`` gives (piece, start, end) of the repeats of a bucket,
    counted from the piece's first token. They hold for its twins too."""

    def close(blobs: list[bytes]) -> Iterator[tuple]:
        if blobs:
            batch = unpacked(blobs)
            piece, start, end = judge(batch)
            hit, twin = pairs(piece, batch.twin_of)
            doc = np.r_[batch.doc[piece], batch.twin_doc[twin]]
            first = np.r_[batch.first[piece], batch.twin_first[twin]]
            yield from hit_rows(doc, first + np.r_[start, start[hit]], first + np.r_[end, end[hit]], batch.doc_ids,
                                batch.text_hashes)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, blobs = HITS, []
        for batch in batches:
            for i, bucket in enumerate(batch.column(0).to_pylist()):
                if bucket == HITS:
                    yield batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                    continue
                if bucket != now:
                    yield from close(blobs)
                    now, blobs = bucket, []
                blobs.append(batch.column(3)[i].as_py())
        yield from close(blobs)

    return lambda batches: _batches(rows(batches), _FOUND, 5000)


def routes(docs: DataFrame, tokens: Tokens, total_bytes: int, n_rows: int) -> Routes:
    """Number of buckets from the size of the texts; very frequent anchors and splitters from a sample of rows."""
    spark = docs.sparkSession
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes * 4 // BUCKET_BYTES))
    share = min(1.0, SAMPLE_ROWS / max(n_rows, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for first, last in _stretches(offsets):
                here = offsets[first: last + 1]
                part, bounds, gram, byte_range = tokens.read(data[here[0]: here[-1]], here - here[0])
                anchor = anchored_runs(gram, bounds, tokens.window, tokens.k).anchor
                at, _ = byte_range(anchor, anchor + 1)
                lead = [part[i: i + tokens.lead].tobytes() for i in at.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(gram[anchor].view(np.int64)), pa.array(lead, pa.binary())],
                                                 ["gram", "lead"])

    seen = docs.select("text").sample(share, seed=7).mapInArrow(run, "gram long, lead binary")
    counted = seen.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("lead").alias("lead"))
    n = counted.agg(F.sum("n")).first()[0] or 0
    often = counted.filter(F.col("n") > max(8, n // buckets)).select("gram").collect()  # at most ``buckets`` rows
    leads = counted.select("lead").sample(min(1.0, 16 * buckets / max(n, 1)), seed=7).orderBy("lead").collect()
    listed = np.array([bytes(r.lead).ljust(16, b"\0") for r in leads], "S16")
    places = np.linspace(0, len(listed), buckets + 1).astype(int)[1:-1]
    return Routes(buckets, np.sort(np.array([r.gram for r in often], np.int64).view(np.uint64)),
                  np.unique(listed[places[places < len(listed)]]) if len(listed) else listed)


def repeated_spans(docs: DataFrame, tokens: Tokens,
                   judge: Callable[[Batch], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """(doc_id, text_hash, spans): for documents with repeats, lists of packed token ranges covered by windows that also
    start in a document with a smaller id."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    held = docs.sparkSession.sparkContext.broadcast(routes(docs, tokens, int(size["bytes"] or 0), size["rows"]))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _sender(tokens, held), "bucket int, doc_id long, text_hash long, data binary")
    where = F.when(F.col("bucket") == HITS, F.pmod("doc_id", F.lit(1 << 20))).otherwise(F.col("bucket"))
    met = sent.repartition(partitions, where).sortWithinPartitions("bucket")
    found = met.mapInArrow(_judge(judge), "doc_id long, text_hash long, spans binary")
    return found.groupBy("doc_id", "text_hash").agg(F.collect_list("spans").alias("spans"))
