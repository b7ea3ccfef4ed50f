"""SimHash near-duplicates, searched with BK-trees.

1. One pass over the texts gives a 64-bit fingerprint per document; equal
   fingerprints become one node.
2. Nodes are dealt to shards.  The 64 bits are cut into ``BLOCKS`` blocks; two
   fingerprints within ``RADIUS`` bits agree on at least ``BLOCKS - RADIUS``
   whole blocks, so every choice of that many blocks is a shard key and no
   link is lost.
3. Each shard is a BK-tree: children are keyed by their Hamming distance to
   the parent, and a probe follows only edges within the radius.  A shard
   above ``TREE_NODES`` nodes is split by the bits outside its blocks
   (pigeonhole again, five rows per node); what is still larger becomes several
   trees, and a node probes the trees before its own while they stream by, so
   one task never holds a hot shard.  The trees are routed to the tasks that
   probe them instead of being broadcast to all, because the set of
   fingerprints grows with the corpus.
4. A tree returns one link per node to its local component, not all pairs;
   the links of all shards go through distributed connected components.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import slices, table, text_or_empty, written
from tidewatch.llm.components import connected_components

SHINGLE_WORDS, RADIUS, BLOCKS, TREE_NODES, ROWS, SEED = 4, 4, 6, 2000, 512, 42
_PLACE = np.arange(0, 2048, 256)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(int)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash as a signed 64-bit integer; zero when there is no word.

    A-Z are lower-cased, words are runs of non-white-space, shingles are
    ``words`` words (repeats count; fewer words make one shingle).
    """
    from xxhash import xxh64_intdigest
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = [0, *ends[:-1].tolist()]
    stops = (ends[words - 1:] - 1).tolist() or [len(joined)]
    h = np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, stops)], "<u8")
    # how often each byte value stands at each place, then how often each bit is set
    seen = np.bincount((h.view(np.uint8).reshape(-1, 8) + _PLACE).reshape(-1), minlength=2048)
    over = 2 * (seen.reshape(8, 256) @ _BITS).reshape(-1) > len(h)
    return int(np.packbits(over, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp`` for every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, ROWS):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array([fingerprint(t, words) for t in b.column(2).to_pylist()], pa.int64())],
                names=["doc_id", "text_hash", "fp"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash(), "text"
                       ).mapInArrow(run, "doc_id long, text_hash long, fp long")


def _text_hash() -> Column:
    return F.xxhash64(text_or_empty()).alias("text_hash")


class BkTree:
    """Fingerprints by Hamming distance to their parent."""

    def __init__(self):
        self.nodes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, fp: int) -> int:
        at, new = 0, len(self.nodes)
        self.nodes.append(fp)
        self.children.append({})
        while new:
            d = (self.nodes[at] ^ fp).bit_count()
            down = self.children[at].setdefault(d, new)
            if down == new:
                break
            at = down
        return new

    def near(self, fp: int, radius: int) -> Iterator[int]:
        """Indexes of the nodes within the radius, following only edges that can lead to one."""
        stack = [0] if self.nodes else []
        while stack:
            at = stack.pop()
            d = (self.nodes[at] ^ fp).bit_count()
            if d <= radius:
                yield at
            stack += [c for k, c in self.children[at].items() if d - radius <= k <= d + radius]


_ALL = (1 << 64) - 1


class TreeLinks:
    """Links that connect whatever lies within the radius: members of one tree
    among themselves, and each probe with every local component it touches."""

    def __init__(self, radius: int):
        self.radius, self.tree = radius, BkTree()
        self.members: list[int] = []
        self.root: list[int] = []
        self.parts = 0  # local components

    def _find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def probe(self, fp: int) -> dict[int, int]:
        """Local components that ``fp`` touches, each with a member within the radius."""
        seen: dict[int, int] = {}
        for hit in self.tree.near(fp & _ALL, self.radius):
            seen.setdefault(self._find(hit), self.members[hit])
            if len(seen) == self.parts:  # it already touches every component of the tree
                break
        return seen

    def add(self, fp: int) -> list[int]:
        """Make ``fp`` a member; returns one linked member per component it joins."""
        seen = self.probe(fp)
        new = self.tree.add(fp & _ALL)
        self.members.append(fp)
        self.root.append(new)
        self.parts += 1 - len(seen)
        for r in seen:
            self.root[r] = new
        return [self.members[r] for r in seen]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _choices(radius: int, blocks: int) -> list[tuple[int, list[int]]]:
    """Per choice of blocks their mask, and masks that part the other bits in
    ``radius + 1`` groups."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    out = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << edges[c + 1]) - (1 << edges[c])) for c in chosen)
        free = [bit for bit in range(64) if not mask >> bit & 1]
        ends = [round(len(free) * i / (radius + 1)) for i in range(radius + 2)]
        out.append((mask, [sum(1 << bit for bit in free[s:e]) for s, e in zip(ends, ends[1:])]))
    return out


def _shards(nodes: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``shard``, ``choice``, ``fp``: one row per choice of blocks."""
    keys = [F.struct(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")))
                     .alias("shard"), F.lit(i).alias("choice"))
            for i, (m, _) in enumerate(_choices(radius, blocks))]
    return nodes.select(F.explode(F.array(*keys)).alias("at"), "fp").select("at.*", "fp")


def _inner(rows: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``shard``, ``fp``: the rows of hot shards by further bits.  Fingerprints of a
    shard differ in the bits outside its blocks only, so of ``radius + 1`` groups of
    these, two that are within the radius agree on one."""
    masks = F.array(*[F.array(*[F.lit(_signed(m)).cast("long") for m in inner])
                      for _, inner in _choices(radius, blocks)])
    return (rows.select("shard", "fp", F.posexplode(F.element_at(masks, F.col("choice") + 1))
                        .alias("group", "mask"))
            .select(F.xxhash64("shard", "group", F.col("fp").bitwiseAND(F.col("mask"))).alias("shard"),
                    "fp"))


def _sizes(rows: DataFrame, tree_nodes: int, name: str) -> DataFrame:
    """``shard``, ``trees`` of the shards with more than one row."""
    counts = rows.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1")
    return written(counts.select("shard", F.ceil(F.col("n") / tree_nodes).cast("int")
                                 .alias("trees")), name)


def dealt(nodes: DataFrame, radius: int, blocks: int, tree_nodes: int) -> DataFrame:
    """``shard``, ``tree``, ``probe``, ``fp``: members and probes of every tree.

    A shard of more than ``tree_nodes`` is split by further bits, which multiplies
    its rows by ``radius + 1`` only.  What is still larger is several trees, and
    a fingerprint probes the trees before its own.
    """
    rows = written(_shards(nodes, radius, blocks), "shards")
    sizes = _sizes(rows, tree_nodes, "shard-sizes")
    out = rows.join(sizes.filter("trees = 1"), "shard").select(
        "shard", F.lit(0).alias("tree"), F.lit(False).alias("probe"), "fp")
    hot = sizes.filter("trees > 1")
    if hot.isEmpty():
        return out
    inner = written(_inner(rows.join(hot, "shard"), radius, blocks), "shards-inner")
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    return out.union(
        inner.join(_sizes(inner, tree_nodes, "shard-inner-sizes"), "shard").withColumn("own", own)
        .withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("own"))))
        .select("shard", "tree", F.col("own") != F.col("tree"), "fp"))


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
          tree_nodes: int = TREE_NODES) -> DataFrame:
    """``a``, ``b``: links whose components are those of all pairs within ``radius`` bits.

    ``nodes`` holds distinct fingerprints ``fp``.
    """
    if not 0 <= radius < blocks <= 16:
        raise ValueError("the radius must be below the number of blocks")
    rows = dealt(nodes, radius, blocks, tree_nodes)
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "shard", "tree").sortWithinPartitions("shard", "tree", "probe", "fp")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trees = None, TreeLinks(radius)  # one tree at a time; its probes stream by
        for b in batches:
            out: list[tuple[int, int]] = []
            for shard, tree, probe, fp in zip(*(c.to_pylist() for c in b.columns)):
                if at != (shard, tree):
                    at, trees = (shard, tree), TreeLinks(radius)
                linked = trees.probe(fp).values() if probe else trees.add(fp)
                out += [(fp, other) for other in linked]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS,
                    blocks: int = BLOCKS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp``, ``component_id`` for every row.

    ``component_id`` is the smallest ``doc_id`` reachable over links of
    ``radius`` or fewer differing bits, the row itself included.

    * null and empty texts have fingerprint zero and link like any other;
    * equal fingerprints are linked whatever their texts;
    * a null ``doc_id`` is ignored for the smallest id (null if all are null);
    * repeated rows each give a row; an empty table gives none.
    """
    marks = written(fingerprints(docs, words), "fingerprints")
    nodes = written(marks.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprint-nodes")
    joined = written(connected_components(links(nodes, radius, blocks, tree_nodes)),
                     "fingerprint-components")
    labels = written(
        nodes.join(joined, nodes.fp == joined.node, "left")
        .select("fp", "low", F.coalesce("component", "fp").alias("label")), "fingerprint-labels")
    lows = written(labels.groupBy("label").agg(F.min("low").alias("component_id")),
                   "component-ids")
    ids = written(labels.join(lows, "label").select("fp", "component_id"), "fingerprint-ids")
    return marks.join(ids, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of its group, with all columns.

    Rows that repeat the smallest ``doc_id`` of a group are one document and
    stay; a null ``doc_id`` stays only where its whole group has none.
    """
    found = near_duplicates(docs, **how)
    gone = written(
        found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_hash")).distinct(),
        "near-duplicates-gone")
    own = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").cast("long").alias("_id"),
                      _text_hash())
    # what goes grows with the corpus: no broadcast, so cost grows alike at every size
    return own.join(gone.hint("merge"), own["_id"].eqNullSafe(gone["_gone"])
                    & (own["text_hash"] == gone["_gone_hash"]), "left_anti").select("_doc.*")


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
