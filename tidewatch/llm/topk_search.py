"""Exact top-k inner products by the three-phase uniform threshold method.

The score of a vector for a query is the sum of partial scores over slices of
the components.  A node holds one slice of a block of vectors and knows nothing
of the other slices.

1. Every node scores the queries over its slice and sends the head of its list;
   merged, they are each slice's local score list.  The exact scores of the
   vectors on these lists give each query a safe cutoff: the k-th best of them.
2. The cutoff goes to all nodes with the blocks of queries.  A vector that reaches
   it has a partial score of at least cutoff / slices in some slice, so every
   node sends all entries from there on.
3. Vectors whose entries came from all slices have their score, which may raise
   the cutoff; others are bounded from above (an entry that did not come is below
   the threshold).  Only those that still may reach the cutoff are looked up in
   the nodes that did not send them, and their exact scores are ranked.

Equal vectors are one vector with its smallest row ids, so a group of copies
costs as much as one row.  Partial scores are products of a block of queries with
a block of vectors; the queries are dealt to every bucket of nodes, and both
meet in a join by bucket.  All scores are integers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import slices as small_batches
from tidewatch.llm.common import table, written

K, EVERY, SCALE = 5, 50, 256
SLICES = 2
#: Bits of a place in a block of vectors and in a block of queries.
BLOCK_BITS, QUERY_BITS = 11, 9
#: Entries of a local score list.
LIST = 16
NONE = np.iinfo(np.int64).min

NODES = "slice int, block long, n int, cells binary"
LISTS = "slice int, qblock long, n int, scores binary, vids binary"
ENTRIES = "qblock long, block long, slice int, places binary, scores binary"
SUMS = "qblock long, block long, places binary, scores binary, seen binary"
TOTALS = "qn long, vid long, score long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, names)],
                                      names=[n for n, _ in names])


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id``, ``v``: rows that take part, components as integers."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))),
                                              F.lit(False)))
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(F.lit(float(SCALE)) * e.cast("double")).cast("long"))
        .alias("v")).distinct()


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``vid``, ``v`` and the ``keep`` smallest ``ids`` of each distinct vector; written once."""
    first = Window.partitionBy("v").orderBy("vec_id")  # limited in each task before the shuffle
    return written(rows.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= keep)
                   .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                   .withColumn("vid", F.monotonically_increasing_id()), "topk-vectors")


def _blocks(df: DataFrame, number: str, bits: int, dims: int, parts: int, name: str) -> DataFrame:
    """Slices of blocks of consecutively numbered vectors (see NODES); written once."""
    cuts = np.array_split(np.arange(dims), parts)

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(number)
        x = np.zeros((rows.num_rows, dims), np.int64)
        v = rows["v"].combine_chunks()
        sizes = np.diff(v.offsets.to_numpy())
        flat = v.flatten().to_numpy()
        at = np.repeat(np.arange(len(sizes)), sizes)
        x[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        return pa.Table.from_batches([_batch(
            [(j, key[0].as_py(), len(x), np.ascontiguousarray(x[:, c]).tobytes())
             for j, c in enumerate(cuts)], NODES)])

    return written(df.withColumn("block", F.shiftright(number, bits)).select(
        "block", number, "v").groupBy("block").applyInArrow(run, NODES), name)


def _matrix(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(n, -1)


def _products(queries: np.ndarray, vectors: np.ndarray, exact_floats: bool) -> np.ndarray:
    if exact_floats:  # every sum is below 2**53
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    return queries @ vectors.T


def _best(scores: np.ndarray, vids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if scores.shape[1] <= k:
        return scores, vids
    at = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return np.take_along_axis(scores, at, 1), np.take_along_axis(vids, at, 1)


def local_lists(pairs: DataFrame, exact_floats: bool, size: int) -> DataFrame:
    """Phase 1: ``qn``, ``vid`` of the best ``size`` vectors of every query and slice."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, best = None, None

        def row() -> pa.RecordBatch:
            return _batch([(*at, len(best[0]), best[0].tobytes(), best[1].tobytes())], LISTS)

        for b in small_batches(batches, 1):
            j, block, n, cells, qblock, qn, qcells = (c.to_pylist()[0] for c in b.columns)
            scores = _products(_matrix(qcells, qn), _matrix(cells, n), exact_floats)
            vids = np.broadcast_to((block << BLOCK_BITS) + np.arange(n), scores.shape)
            if at != (j, qblock):  # queries come one block after the other
                if at is not None:
                    yield row()
                at, best = (j, qblock), (scores[:, :0], vids[:, :0])
            best = _best(*(np.concatenate(x, 1) for x in zip(best, _best(scores, vids, size))), size)
        if at is not None:
            yield row()

    def merge(rows: pa.Table) -> pa.Table:
        j, qblock, n = (rows[c][0].as_py() for c in ("slice", "qblock", "n"))
        best = _best(*(np.concatenate([_matrix(x, n) for x in rows[c].to_pylist()], 1)
                       for c in ("scores", "vids")), size)
        return pa.Table.from_batches([_batch(
            [(j, qblock, n, best[0].tobytes(), best[1].tobytes())], LISTS)])

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            qblock, n, vids = (c.to_pylist()[0] for c in b.columns)
            vids = _matrix(vids, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat((qblock << QUERY_BITS) + np.arange(n), vids.shape[1])),
                 pa.array(vids.ravel())], names=["qn", "vid"])

    sent = pairs.select("slice", "block", "n", "cells", "qblock", "qn", "qcells").mapInArrow(run, LISTS)
    # in two levels: no task merges more than about the root of the number of lists
    groups = max(1, int(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
    sent = (sent.withColumn("_g", F.pmod(F.xxhash64("vids"), F.lit(groups))).groupBy("slice", "qblock", "_g")
            .applyInArrow(merge, LISTS).groupBy("slice", "qblock").applyInArrow(
                merge, LISTS))
    return sent.select("qblock", "n", "vids").mapInArrow(unpack, "qn long, vid long").distinct()


def entries(pairs: DataFrame, parts: int, exact_floats: bool) -> DataFrame:
    """Phase 2: all partial scores of at least cutoff / slices (see ENTRIES)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            j, block, n, cells, qblock, qn, qcells, cutoffs = (c.to_pylist()[0] for c in b.columns)
            scores = _products(_matrix(qcells, qn), _matrix(cells, n), exact_floats)
            need = _needed(_cutoffs(cutoffs, qn), parts)
            q, v = np.nonzero(scores >= need[:, None])
            yield _entries(qblock, block, j, (q << BLOCK_BITS) + v, scores[q, v])

    return written(pairs.select("slice", "block", "n", "cells", "qblock", "qn", "qcells", "cutoffs")
                   .mapInArrow(run, ENTRIES), "topk-entries")


def _entries(qblock: int, block: int, j: int, places: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    return _batch([(qblock, block, j, places.astype("<i8").tobytes(), scores.astype("<i8").tobytes())]
                  if len(places) else [], ENTRIES)


def _cutoffs(cutoffs: list, n: int) -> np.ndarray:
    out = np.full(n, NONE, np.int64)
    for x in cutoffs or []:
        out[x["at"]] = x["cutoff"]
    return out


def _needed(cutoff: np.ndarray, parts: int) -> np.ndarray:
    """Least partial score that some slice of a vector at the cutoff must have."""
    return np.where(cutoff == NONE, NONE, -(-cutoff // parts))


def summed(rows: DataFrame) -> DataFrame:
    """Sums of the entries of each pair of blocks, and the slices they came from (see SUMS)."""
    def run(rows: pa.Table) -> pa.Table:
        places = [np.frombuffer(x, "<i8") for x in rows["places"].to_pylist()]
        scores = np.concatenate([np.frombuffer(x, "<i8") for x in rows["scores"].to_pylist()])
        bits = np.repeat(np.int64(1) << np.array(rows["slice"].to_pylist(), np.int64),
                         [len(x) for x in places])
        kinds, at = np.unique(np.concatenate(places), return_inverse=True)
        total, seen = np.zeros((2, len(kinds)), np.int64)
        np.add.at(total, at, scores)
        np.bitwise_or.at(seen, at, bits)
        return pa.Table.from_batches([_batch(
            [(rows["qblock"][0].as_py(), rows["block"][0].as_py(), kinds.tobytes(),
              total.tobytes(), seen.tobytes())], SUMS)])

    return rows.groupBy("qblock", "block").applyInArrow(run, SUMS)


def complete(sums: DataFrame, parts: int, k: int) -> DataFrame:
    """Exact scores (see TOTALS) of vectors whose entries came from all slices: of
    each pair of blocks the ``k`` best per query, with those equal to the k-th."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            qblock, block, places, scores, seen = (c.to_pylist()[0] for c in b.columns)
            places, scores, seen = (np.frombuffer(x, "<i8") for x in (places, scores, seen))
            full = seen == (1 << parts) - 1
            q, v, scores = places[full] >> BLOCK_BITS, places[full], scores[full]
            order = np.lexsort((-scores, q))
            q, v, scores = q[order], v[order] & ((1 << BLOCK_BITS) - 1), scores[order]
            first = np.searchsorted(q, q)
            last = np.minimum(first + k, np.searchsorted(q, q, "right")) - 1
            best = scores >= scores[last]
            yield pa.RecordBatch.from_arrays(
                [pa.array((qblock << QUERY_BITS) + q[best]),
                 pa.array((block << BLOCK_BITS) + v[best]), pa.array(scores[best])],
                names=["qn", "vid", "score"])

    return sums.mapInArrow(run, TOTALS)


def lookups(sums: DataFrame, parts: int) -> DataFrame:
    """Phase 3: what is still asked of each slice (see ENTRIES, without scores): vectors
    that may reach the cutoff, in slices that did not send them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            qblock, block, places, scores, seen, cutoffs, first = (c.to_pylist()[0] for c in b.columns)
            places, scores, seen = (np.frombuffer(x, "<i8") for x in (places, scores, seen))
            q = places >> BLOCK_BITS
            n = 1 << QUERY_BITS
            cutoff = _cutoffs(cutoffs, n)[q]
            most = _needed(_cutoffs(first, n), parts)[q] - 1  # of an entry that did not come
            missing = parts - sum((seen >> j) & 1 for j in range(parts))
            may = (missing > 0) & (scores + missing * most >= cutoff)
            for j in range(parts):
                asked = places[may & ((seen >> j) & 1 == 0)]
                yield _entries(qblock, block, j, asked, np.zeros(len(asked), np.int64))

    return written(sums.mapInArrow(run, ENTRIES), "topk-lookups")


def looked_up(asked: DataFrame, exact_floats: bool) -> DataFrame:
    """The partial scores asked for (see ENTRIES)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            j, block, n, cells, qblock, qn, qcells, places = (c.to_pylist()[0] for c in b.columns)
            places = np.frombuffer(places, "<i8")
            scores = _products(_matrix(qcells, qn), _matrix(cells, n), exact_floats)
            yield _entries(qblock, block, j, places,
                           scores[places >> BLOCK_BITS, places & ((1 << BLOCK_BITS) - 1)])

    return asked.select("slice", "block", "n", "cells", "qblock", "qn", "qcells", "places").mapInArrow(
        run, ENTRIES)


def _kth(totals: DataFrame, k: int) -> DataFrame:
    """``qn``, ``cutoff``: the k-th best score of each query that has so many."""
    best = Window.partitionBy("qn").orderBy(F.desc("score"), "vid")
    return (totals.withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") <= k)
            .where(F.col("_rn") == k).select("qn", F.col("score").alias("cutoff")))


def _by_block(cutoffs: DataFrame, name: str) -> DataFrame:
    """Cutoffs of each block of queries (at most 2**QUERY_BITS)."""
    mask = (1 << QUERY_BITS) - 1
    return cutoffs.groupBy(F.shiftright("qn", QUERY_BITS).alias("qblock")).agg(
        F.collect_list(F.struct(F.col("qn").bitwiseAND(mask).cast("int").alias("at"), "cutoff"))
        .alias(name))


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
           every: int = EVERY, parts: int = SLICES, size: int = LIST) -> DataFrame:
    """The ``k`` rows of highest inner product for every row whose id is divisible
    by ``every``: ``query_id``, ``rank``, ``vec_id``, ``score`` (components are
    floor(256 * x)).

    * a null id, a null vector, or one with a null, NaN or infinite component
      takes no part; rows equal in id and vector count once, and a query's own
      row is the one equal in both;
    * equal scores: the smaller id first; with fewer rows, all are returned;
    * shorter vectors count as filled up with zeros; components so large that a
      score may not fit 64 bits are an error;
    * without rows or queries there are no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col)
    known = distinct_vectors(rows, k + 1)  # one may be the query's own row
    about = known.agg(F.max(F.size("v")), F.max(F.aggregate(
        "v", F.lit(0.0), lambda a, e: F.greatest(a, F.abs(e.cast("double")))))).first()
    dims, most = about[0] or 0, about[1] or 0.0
    bound = max(1, dims) * most * most
    if bound >= 2.0 ** 63:
        raise ValueError(f"components of up to {most:g} may give scores beyond 64 bits")
    exact_floats, parts = bound < 2.0 ** 53, max(1, min(parts, dims))

    asking = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v")
    asking = written(asking.hint("merge").join(known.select("v", "vid"), "v")
                     .select("query_id", "vid"), "topk-asking")
    queries = written(known.select("v", "vid").hint("merge").join(
        asking.select("vid").distinct(), "vid", "left_semi")
        .withColumn("qn", F.monotonically_increasing_id()), "topk-queries")
    nodes = _blocks(known, "vid", BLOCK_BITS, dims, parts, "topk-nodes")
    asked = _blocks(queries, "qn", QUERY_BITS, dims, parts, "topk-query-blocks").select(
        "slice", F.col("block").alias("qblock"), F.col("n").alias("qn"), F.col("cells").alias("qcells"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = nodes.withColumn("bucket", F.pmod(F.xxhash64("block"), F.lit(buckets)))
    dealt = asked.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"),
                                                              F.lit(buckets - 1).cast("long"))))

    # phase 1
    head = local_lists(dealt.hint("merge").join(nodes, ["slice", "bucket"]), exact_floats,
                       max(size, k + 1))
    product = F.aggregate(F.zip_with("_q", "v", lambda a, b: F.coalesce(a * b, F.lit(0))),
                          F.lit(0).cast("long"), lambda a, e: a + e)
    totals = (head.join(known.select("vid", "v"), "vid")
              .join(queries.select("qn", F.col("v").alias("_q")), "qn")
              .select("qn", "vid", product.alias("score")))
    first = written(_kth(totals, k + 1), "topk-cutoffs")
    # phase 2
    sent = entries(dealt.join(_by_block(first, "cutoffs"), "qblock", "left").hint("merge").join(
        nodes, ["slice", "bucket"]), parts, exact_floats)
    sums = written(summed(sent), "topk-sums")
    raised = written(_kth(complete(sums, parts, k + 1), k + 1).unionByName(first).groupBy("qn").agg(
        F.max("cutoff").alias("cutoff")), "topk-cutoffs")
    # phase 3
    wanted = lookups(sums.join(_by_block(raised, "cutoffs"), "qblock", "left").join(
        _by_block(first, "first"), "qblock", "left").select(
        "qblock", "block", "places", "scores", "seen", "cutoffs", "first"), parts)
    wanted = wanted.drop("scores").withColumn("bucket", F.pmod(F.xxhash64("block"), F.lit(buckets)))
    found = looked_up(wanted.hint("merge").join(dealt, ["slice", "bucket", "qblock"]).hint("merge").join(
        nodes.drop("bucket"), ["slice", "block"]), exact_floats)
    totals = complete(summed(sent.unionByName(found)), parts, k + 1)

    numbered = totals.join(queries.select("qn", F.col("vid").alias("_own")), "qn").join(
        raised, "qn", "left").where("cutoff is null or score >= cutoff")
    # with the k + 1 best rows of each query vector, then those of each query
    some = numbered.join(known.select("vid", F.explode("ids").alias("vec_id")), "vid")
    head = Window.partitionBy("_own").orderBy(F.desc("score"), "vec_id", "vid")
    some = some.withColumn("_rn", F.row_number().over(head)).where(F.col("_rn") <= k + 1)
    each = asking.select("query_id", F.col("vid").alias("_own")).join(some, "_own").where(
        "vid != _own or vec_id != query_id")
    best = Window.partitionBy("query_id", "_own").orderBy(F.desc("score"), "vec_id", "vid")
    return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op11_topk_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
         AS rank, vec_id, score
FROM s QUALIFY rank <= {K}"""
