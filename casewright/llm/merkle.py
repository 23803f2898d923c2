"""Merkle manifest of a dataset: an append log in postorder, and inclusion proofs from it.

Each source is a tree of 16-ary runs over its documents in order of doc_id; the subroots, in order of source, are the leaves of
one more tree. A tree with n leaves has ceil(n / 16 ** l) nodes on level l, up to the first level with one node.

Builders take aligned blocks of ``FANOUT ** LEVELS`` nodes, hash their runs and write nodes in the order of completion. A node's
place in the postorder of its whole tree has a closed form (``position``), so builders need not know of each other, and the
log of a tree is the concatenation of theirs in order of position. The top nodes of the blocks are the input of the next
builders, and so on: the log of n leaves takes log(n) / log(256) passes, each over 1/256 of the nodes before.

A proof lists the siblings on the way up. They are read from the log at their positions, block by block from the top down;
each block gets the way up from its top once, not once per document.

Documents move as digests only. Ranks come from range-sorted stretches, so no task holds a whole source.

Defined cases: a null value counts as ``-``; a null source comes first; a null doc_id comes first in its source and is
tampered with nowhere. Rows that repeat a doc_id are leaves of their own, ordered by digest; wholly equal rows are
interchangeable. A lone leaf is its subroot, and a lone subroot the root; without siblings a proof is the digest of nothing. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm.common import ascii_lower, settle

FANOUT = 16
#: Levels of a builder's block; its top is a node of the next builders' lowest level.
LEVELS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**values: Column) -> Column:
    """The digest of a document, with ``values`` in place of its columns where given."""
    return F.sha2(F.concat(*[_field(values.get(f, F.col(f))) for f in FIELDS]), 256)


def height(leaves: int) -> int:
    """Level of the root over ``leaves`` leaves."""
    levels = 0
    while leaves > FANOUT ** levels:
        levels += 1
    return levels


def position(leaves: int, level: int, index: int) -> int:
    """Place (from 0) of node ``index`` of ``level`` in the postorder of the tree over ``leaves`` leaves.

    Before a node is written, all nodes on its own and lower levels are that cover leaves up to its last one, and on higher
    levels those that end before its first one.
    """
    first = index * FANOUT ** level
    last = min(first + FANOUT ** level, leaves)
    written = sum(-(-last // FANOUT ** low) for low in range(level + 1))
    return written - 1 + sum(first // FANOUT ** high for high in range(level + 1, height(leaves) + 1))


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``index`` (from 0, by ``order`` within ``tree``) and ``leaves`` (rows of the tree).

    Rows are range-sorted by (tree, order) into stretches and counted in each; the counts, one row for each tree and
    stretch, give every stretch its first rank.
    """
    ranged = settle("ranged", rows.repartitionByRange(tree, *order).withColumn("stretch", F.spark_partition_id()))
    counts = ranged.groupBy(tree, "stretch").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(tree).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    # A tree lies in neighbouring stretches: (tree, stretch) pairs are not more than trees and stretches together.
    offsets = counts.select(F.col(tree).alias("__tree"), F.col("stretch").alias("__stretch"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                            F.sum("n").over(Window.partitionBy(tree)).alias("leaves"))
    inside = Window.partitionBy(tree, "stretch").orderBy(*order)
    placed = ranged.withColumn("inside", F.row_number().over(inside))
    same = placed[tree].eqNullSafe(offsets["__tree"]) & (placed["stretch"] == offsets["__stretch"])
    return placed.join(offsets, same).withColumn("index", (F.col("inside") + F.col("offset") - 1).cast("long")).drop(
        "__tree", "__stretch", "offset", "inside", "stretch")


_LOG = "tree string, leaves long, position long, level int, index long, digest string"
_LOG_ARROW = pa.schema([("tree", pa.string()), ("leaves", pa.int64()), ("position", pa.int64()), ("level", pa.int32()),
                        ("index", pa.int64()), ("digest", pa.string())])


def _builder(base: int, levels: int):
    """Hashes one block of nodes of level ``base`` and lists its nodes in order of completion."""

    def build(block: pa.Table) -> pa.Table:
        rows = sorted(zip(block["index"].to_pylist(), block["digest"].to_pylist(), strict=True))
        tree, leaves = block["tree"][0].as_py(), block["leaves"][0].as_py()
        top = min(base + levels, height(leaves))
        out, open_runs = [], [[] for _ in range(levels + 1)]

        def write(level: int, index: int, value: str) -> None:
            if level > base or base == 0:  # others were written by the builders below
                out.append((position(leaves, level, index), level, index, value))
            if level == top:
                return
            run = open_runs[level - base]
            run.append(value)
            if len(run) == FANOUT or index == -(-leaves // FANOUT ** level) - 1:
                open_runs[level - base] = []
                write(level + 1, index // FANOUT, digest(run))

        for index, value in rows:
            write(base, index, value)
        return pa.table([[tree] * len(out), [leaves] * len(out), *map(list, zip(*out))] if out else
                        [[] for _ in _LOG_ARROW], schema=_LOG_ARROW)

    return build


def append_log(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The log of every tree: (tree, leaves, position, level, index, digest), positions 0, 1, 2 ... per tree.

    ``leaves`` has (tree, leaves, index, digest). A tree is complete when its root has been written.
    """
    nodes, log, base = leaves.select("tree", "leaves", "index", "digest"), None, 0
    most = leaves.agg(F.max("leaves")).first()[0] or 0
    while log is None or base < height(most):
        block = F.floor(F.col("index") / F.lit(FANOUT ** levels)).cast("long")
        written = settle("log", nodes.withColumn("block", block).groupBy("tree", "block").applyInArrow(_builder(base, levels), _LOG))
        log = written if log is None else log.union(written)
        base += levels
        nodes = written.filter((F.col("level") == base) & (F.col("leaves") > FANOUT ** base)).select(
            "tree", "leaves", "index", "digest")
    return log


def _is_root() -> Column:
    powers = F.array(*[F.lit(FANOUT ** i).cast("long") for i in range(16)])
    fits = lambda level: F.col("leaves") <= F.get(powers, level)
    return fits(F.col("level")) & ((F.col("level") == 0) | ~fits(F.col("level") - 1))


def tops(log: DataFrame) -> DataFrame:
    """(tree, digest) of every tree's root."""
    return log.filter(_is_root()).select("tree", "digest")


#: The way from a node up to a root: on each level, what is hashed before and after the node there.
_STEPS = "array<struct<before: string, after: string>>"
_WAYS = f"tree string, index long, top string, way {_STEPS}"
_WAYS_ARROW = pa.schema([("tree", pa.string()), ("index", pa.int64()), ("top", pa.string()),
                         ("way", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))])
_PROOFS = "source string, doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"
_PROOFS_ARROW = pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.string()) for f in _PROOFS.split(", ")])


def fold_up(value: str, way: list[dict]) -> str:
    """The root that ``value`` leads to along ``way``."""
    for step in way:
        value = digest([step["before"], value, step["after"]])
    return value


def _extractor(base: int, levels: int, claims: bool):
    """The ways from all nodes of level ``base`` of one block to the root, given that of the block's top; with ``claims`` what
    they prove for the block's documents."""
    schema = _PROOFS_ARROW if claims else _WAYS_ARROW

    def extract(key: tuple, block: pa.Table, above: pa.Table) -> pa.Table:
        if not len(block) or not len(above):
            return schema.empty_table()
        rows = block.to_pylist()
        nodes = [r for r in rows if r["position"] is not None]
        tree, leaves = nodes[0]["tree"], nodes[0]["leaves"]
        log = {r["position"]: r["digest"] for r in nodes}
        top = min(base + levels, height(leaves))
        whole, way_up = above["top"][0].as_py(), above["way"][0].as_py()
        steps: dict[tuple[int, int], dict] = {}

        def step(level: int, index: int) -> dict:
            if (level, index) not in steps:  # siblings are addressed by their positions
                start = index - index % FANOUT
                stop = min(start + FANOUT, -(-leaves // FANOUT ** level))
                side = lambda a, b: "".join(log[position(leaves, level, i)] for i in range(a, b))
                steps[level, index] = {"before": side(start, index), "after": side(index + 1, stop)}
            return steps[level, index]

        def way(index: int) -> list[dict]:
            return [step(level, index // FANOUT ** (level - base)) for level in range(base, top)] + way_up

        if not claims:
            indices = sorted(r["index"] for r in nodes if r["level"] == base)
            out = [(tree, i, whole, way(i)) for i in indices]
        else:
            out = []
            for r in rows:
                if r["position"] is None:
                    found = way(r["index"])
                    proof = digest([part for s in found for part in (s["before"], s["after"])])
                    leaf = log[position(leaves, 0, r["index"])]
                    out.append((tree, r["doc_id"], leaf, whole, proof, fold_up(r["digest"], found)))
        return pa.table([list(c) for c in zip(*out)], schema=schema) if out else schema.empty_table()

    return extract


def _blocks(log: DataFrame, base: int, levels: int) -> DataFrame:
    """The nodes of ``log`` that blocks of level ``base`` hold below their tops, with ``block``; of trees that reach so far."""
    number = [F.when(F.col("level") == base + k, F.floor(F.col("index") / F.lit(FANOUT ** (levels - k)))) for k in range(levels)]
    reaches = F.lit(True) if base == 0 else F.col("leaves") > FANOUT ** base
    return log.filter(F.col("level").between(base, base + levels - 1) & reaches).withColumn("block", F.coalesce(*number).cast("long"))


def _with_tops(nodes: DataFrame, known: DataFrame):
    """The rows of each block beside the one row of its top; both sides get names of their own, as they have a source in common."""
    left, right = nodes.toDF(*nodes.columns), known.toDF(*known.columns)
    return left.groupBy("tree", "block").cogroup(right.groupBy("tree", "block"))


def _starting(log: DataFrame, above: DataFrame, base: int, levels: int) -> DataFrame:
    """(tree, block, top, way) of the trees whose root tops a block of level ``base``: their ways go on as ``above`` says."""
    low = F.lit(True) if base == 0 else F.col("leaves") > FANOUT ** base
    here = log.filter(_is_root() & low & (F.col("leaves") <= FANOUT ** (base + levels))).select("tree")
    return here.alias("h").join(above.alias("a"), F.col("h.tree").eqNullSafe(F.col("a.tree"))).select(
        F.col("a.tree").alias("tree"), F.lit(0).cast("long").alias("block"), "a.top", "a.way")


def ways_up(log: DataFrame, above: DataFrame, levels: int = LEVELS, down_to: int = 0) -> DataFrame:
    """(tree, index, top, way) of the nodes on level ``down_to`` (a multiple of ``levels``) of every tree that reaches above it.

    ``above`` (tree, top, way) has the root of every tree and the way from there on. Blocks are taken from the top
    down, so each is given the way of its top once. A tree joins in at the block that its root tops.
    """
    most = height(log.agg(F.max("leaves")).first()[0] or 0)
    base, found = max(down_to, (most - 1) // levels * levels), None
    while base >= down_to:
        known = _starting(log, above, base, levels)
        if found is not None:
            known = known.union(found.select("tree", F.col("index").alias("block"), "top", "way"))
        found = settle("ways", _with_tops(_blocks(log, base, levels), known).applyInArrow(_extractor(base, levels, False), _WAYS))
        base -= levels
    return found


def proofs(leaves: DataFrame, log: DataFrame, above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(source, doc_id, leaf, subroot, proof_sha256, folded_root) for ``leaves`` (tree, index, doc_id, claimed).

    The proof is the digest of all siblings; folded_root is the root that the document leads to if it is what it claims.
    """
    known = _starting(log, above, 0, levels).union(ways_up(log, above, levels, levels).select(
        "tree", F.col("index").alias("block"), "top", "way"))
    asked = leaves.select("tree", "index", "doc_id", F.col("claimed").alias("digest"),
                          F.floor(F.col("index") / F.lit(FANOUT ** levels)).cast("long").alias("block"))
    both = _blocks(log, 0, levels).unionByName(asked, allowMissingColumns=True)
    return _with_tops(both, known).applyInArrow(_extractor(0, levels, True), _PROOFS)


def _trees(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` (tree, digest, ...) with their places, and the log of their trees."""
    placed = settle("placed", ranked(rows, "tree", order))
    return placed, append_log(placed)


def manifest(docs: DataFrame, claimed: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The logs of the source trees and of the tree over the sources, the placed documents (tree, index, doc_id, digest, claimed)
    and the way of each source's root: (tree, top, way). ``claimed`` is the leaf digest to prove, else the own one."""
    own = leaf_digest()
    rows = docs.select(F.col("source").cast("string").alias("tree"), F.col("doc_id").cast("long"), own.alias("digest"),
                       (own if claimed is None else F.coalesce(claimed, own)).alias("claimed"))
    placed, log = _trees(rows, ["doc_id", "digest"])
    sources, top_log = _trees(tops(log).select(
        F.lit("sources").alias("tree"), F.col("tree").alias("source"), "digest"), ["source"])
    root = tops(top_log).select("tree", F.col("digest").alias("top"), F.array().cast(_STEPS).alias("way"))
    ways = ways_up(top_log, root).select("index", "way").alias("w")
    above = sources.alias("s").join(ways, "index").select(F.col("s.source").alias("tree"), F.col("s.digest").alias("top"), "w.way")
    return log, top_log, placed, settle("above", above)


def verified(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: every document's proof, checked against the root.

    Where 5 divides the CRC-32 of the decimal doc_id, the document claims to have its text in lower case (A-Z only).
    """
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, leaf_digest(text=ascii_lower(F.col("text"))))
    log, top_log, placed, above = manifest(docs, tampered)
    root = tops(top_log).first()
    root = F.lit(root and root["digest"]).cast("string")
    return proofs(placed, log, above).select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
