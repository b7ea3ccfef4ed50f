"""Ranked lexical search with norm buckets in the manner of LEMP.

The score of a document for an item is the inner product of two vectors over
terms: how often the item has a term, and the term's weighted impact in the
document.  Only terms of items matter, so an impact vector holds just those.

1. One pass over the documents counts their terms, keeping the items' ones;
   document frequencies follow from it by aggregation.
2. Impact vectors are ordered by length (a range shuffle); a bucket is a run of
   vectors of about equal length.
3. A bucket is left out for an item if, by Cauchy-Schwarz, length of the item
   times greatest length of the bucket, or the products with the bucket's
   greatest coordinates, stay below the item's cutoff: the k-th best score known
   so far.  The longest documents give the first cutoff, and every task raises
   its own as it goes down its buckets.
4. Coordinate bounds filter inside a bucket: the products over the item's focus
   terms, plus a bound of the rest: by Cauchy-Schwarz with the lengths of what is
   left of both vectors, or with the bucket's greatest coordinates.
5. Survivors are scored again in integers over all terms, so bounds (with some
   slack for rounding) only ever save work.

Items are taken in groups of bounded size, each sent to the tasks whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import slices, table, written

K = 10
#: Impact of a term: (IMPACT * tf) div (1000 * tf + 8 * m), m = 25 + (75 * n * N) div L.
IMPACT, SATURATION, LENGTH = 1_000_000_000, 8, 75
#: Bounds of a group of items that is sent to all tasks (a single longer item is a group of its own).
GROUP_ITEMS, GROUP_BYTES = 512, 8 << 20
BUCKET, FIRST, ROWS = 1024, 2048, 256
#: Share of an item's squared length that its focus terms make up.
FOCUS = 0.95
#: Relative slack of a bound, for rounding.
SLACK = 1e-9

TERMS = "part long, doc_id long, n long, terms array<int>, tf array<long>"
VECTORS = "length double, part long, doc_id long, terms array<int>, impact array<long>"
FOUND = "item int, doc_id long, score long"

#: A-Z lower-cased; bytes that end a term (ASCII but 0-9, A-Z, a-z) become spaces.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower()
                    else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TERM_BYTES).split()


def counted_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Every document with a term: its number of terms, and the occurrences of
    those in ``vocabulary`` (see TERMS); written once."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, get = TaskContext.get().partitionId() << 40, 0, known.value.get
        width = max(1, len(known.value))
        for b in slices(batches, ROWS):
            ids, sizes, hits, of = [], [], [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = terms(text)
                if not found:
                    continue
                mine = [i for i in map(get, found) if i is not None]
                hits.extend(mine)
                of.append(len(mine))
                ids.append(doc_id)
                sizes.append(len(found))
            code, tf = np.unique(np.repeat(np.arange(len(of)), of) * width
                                 + np.array(hits, np.int64), return_counts=True)
            at = np.searchsorted(code, np.arange(len(of) + 1) * width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part + seen + np.arange(len(ids))), pa.array(ids, pa.int64()),
                 pa.array(sizes, pa.int64()), _lists(at, (code % width).astype(np.int32)),
                 _lists(at, tf.astype(np.int64))], names=[x.split()[0] for x in TERMS.split(", ")])
            seen += len(ids)

    return written(docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, TERMS),
                   "lemp-terms")


def _lists(starts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each value, and the values."""
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(sizes)), sizes), column.flatten().to_numpy()


def impact_vectors(counted: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """Weighted impacts and vector lengths (see VECTORS).

    An item's vector has ``count * sqrt(weight)`` and a document's
    ``impact * sqrt(weight)``: the same products, with closer bounds."""
    shared = counted.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, doc_id, m, found, tf = b.columns
            row, t = _flat(found)
            _, tf = _flat(tf)
            impact = (IMPACT * tf) // (1000 * tf + SATURATION * m.to_numpy()[row])
            length = np.sqrt(np.bincount(row, shared.value[t] * (impact * 1.0) ** 2,
                                         minlength=len(part)))
            at = np.searchsorted(row, np.arange(len(part) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(length), part, doc_id, _lists(at, t), _lists(at, impact)],
                names=[x.split()[0] for x in VECTORS.split(", ")])

    m = F.expr(f"cast({100 - LENGTH} + (cast({LENGTH} as decimal(20,0)) * n * {n_docs}) "
               f"div {n_terms} as long)")
    return counted.where(F.size("terms") > 0).select(
        "part", "doc_id", m.alias("m"), "terms", "tf").mapInArrow(run, VECTORS)


@dataclass
class Items:
    """Vectors of a group of items, sorted by term, and the cutoffs to begin with."""

    term: np.ndarray
    item: np.ndarray
    count: np.ndarray
    weight: np.ndarray      # of the term, integer
    focus: np.ndarray       # whether the term is a focus term of the item
    length: np.ndarray      # by item
    rest: np.ndarray        # length without the focus terms
    cutoff: np.ndarray      # k-th best score known, or 0

    @classmethod
    def of(cls, vectors: list[dict[int, int]], weights: np.ndarray) -> Items:
        flat = sorted((t, i, c) for i, v in enumerate(vectors) for t, c in v.items())
        term, item, count = (np.array(x, np.int64) for x in (zip(*flat) if flat else ([], [], [])))
        square = count * 1.0 * count * weights[term]
        n = len(vectors)
        total = np.bincount(item, square, minlength=n)
        order = np.lexsort((-square, item))  # an item's greatest coordinates first
        before = np.cumsum(square[order]) - square[order]
        first = np.searchsorted(item[order], np.arange(n))
        before -= np.concatenate([before, [0]])[first][item[order]] if len(order) else 0
        focus = np.zeros(len(term), bool)
        focus[order] = before < FOCUS * total[item[order]]
        rest = np.sqrt(np.maximum(0, np.bincount(item[~focus], square[~focus], minlength=n)))
        return cls(term, item, count, weights[term], focus, np.sqrt(total), rest,
                   np.zeros(n, np.int64))


def _meet(terms_: np.ndarray, sorted_terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in ``terms_``, place in ``sorted_terms``) of equal terms."""
    low = np.searchsorted(sorted_terms, terms_)
    n = np.searchsorted(sorted_terms, terms_, "right") - low
    left = np.repeat(np.arange(len(terms_)), n)
    return left, np.arange(len(left)) - np.repeat(np.cumsum(n) - n - low, n)


class Bucket:
    """Vectors of about equal length: entries (``row``, ``term``, ``impact``)
    met with the coordinates of the items that it may have an answer for."""

    def __init__(self, items: Items, length: np.ndarray, row: np.ndarray, term: np.ndarray,
                 impact: np.ndarray) -> None:
        self.n, self.length = len(length), length
        top = np.zeros(int(max(items.term.max(initial=0), term.max(initial=0))) + 1, np.int64)
        np.maximum.at(top, term, impact)  # greatest coordinates of the bucket
        most = items.count * items.weight * top[items.term]
        n = len(items.cutoff)
        whole = np.minimum(items.length * length.max(), np.bincount(items.item, most, minlength=n))
        self.active = whole * (1 + SLACK) + 1 >= items.cutoff
        self.rest = np.bincount(items.item[~items.focus], most[~items.focus], minlength=n)
        used = self.active[items.item]
        term_, self.item, count, weight, self.focus = (
            x[used] for x in (items.term, items.item, items.count, items.weight, items.focus))
        left, right = _meet(term, term_)
        self.cell = self.item[right] * self.n + row[left]
        self.part = count[right] * weight[right] * impact[left]
        self.square = weight[right] * (impact[left] * 1.0) ** 2
        self.focus = self.focus[right]

    def survivors(self, items: Items) -> np.ndarray:
        """Cells (item * n + document) whose coordinate bound reaches the item's cutoff."""
        cells, cell = len(self.active) * self.n, self.cell[self.focus]
        part = np.bincount(cell, self.part[self.focus], minlength=cells).reshape(-1, self.n)
        taken = np.bincount(cell, self.square[self.focus], minlength=cells).reshape(-1, self.n)
        left = np.sqrt(np.maximum(0, self.length ** 2 * (1 + SLACK) - taken))
        bound = part + np.minimum(items.rest[:, None] * left, self.rest[:, None])
        return np.flatnonzero((bound * (1 + SLACK) + 1 >= items.cutoff[:, None])
                              & self.active[:, None])

    def scores(self, cells: np.ndarray) -> np.ndarray:
        """Integer scores of the cells over all terms of their items."""
        place = np.full(len(self.active) * self.n, -1, np.int64)
        place[cells] = np.arange(len(cells))
        at = place[self.cell]
        out = np.zeros(len(cells), np.int64)
        np.add.at(out, at[at >= 0], self.part[at >= 0])
        return out


def _searched(vectors: DataFrame, items: Items, k: int) -> DataFrame:
    """The best ``k`` of each task's documents for each item (see FOUND); rows
    come in order of falling length."""
    shared = vectors.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        own = Items(**{**own.__dict__, "cutoff": own.cutoff.copy()})
        best = [np.zeros(0, np.int64)] * 4  # item, no id, doc_id, score
        for b in slices(batches, BUCKET):
            length = b.column(0).to_numpy()
            if not (own.length * length.max() * (1 + SLACK) + 1 >= own.cutoff).any():
                continue
            row, term = _flat(b.column(3))
            _, impact = _flat(b.column(4))
            bucket = Bucket(own, length, row, term, impact)
            cells = bucket.survivors(own)
            if len(cells):
                score, i, d = bucket.scores(cells), cells // bucket.n, cells % bucket.n
                kept = np.flatnonzero((score > 0) & (score >= own.cutoff[i]))
                ids = b.column(2).take(pa.array(d[kept]))
                new = [i[kept], ids.is_null().to_numpy(False).astype(np.int64),
                       ids.fill_null(0).to_numpy(), score[kept]]
                best = [np.concatenate(x) for x in zip(best, new)]
                order = np.lexsort((best[2], best[1], -best[3], best[0]))
                best = [x[order] for x in best]
                place = np.arange(len(order)) - np.searchsorted(best[0], best[0])
                full = place == k - 1
                own.cutoff[best[0][full]] = np.maximum(own.cutoff[best[0][full]], best[3][full])
                best = [x[place < k] for x in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(best[0], pa.int32()), pa.array(best[2], pa.int64(), mask=best[1] == 1),
             pa.array(best[3], pa.int64())], names=[x.split()[0] for x in FOUND.split(", ")])

    return vectors.mapInArrow(run, FOUND)


def _search_group(docs: DataFrame, texts: list[str], k: int) -> DataFrame:
    """``item`` (place in ``texts``), ``doc_id``, ``score``: every task's best ``k``."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    vectors: list[dict[int, int]] = []
    for text in texts:
        own: dict[int, int] = {}
        for w in terms(text):
            i = vocabulary.setdefault(w, len(vocabulary))
            own[i] = own.get(i, 0) + 1
        vectors.append(own)
    counted = counted_terms(docs, vocabulary)
    size = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in (counted.select(F.explode("terms").alias("t")).groupBy("t").count()
              .collect()):  # one row per term of the group
        df[r.t] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * size.docs + 2) / (2 * x + 1)))
                        for x in df.tolist()], np.int64)
    items = Items.of(vectors, weights)
    if not size.docs or not len(items.term):
        return spark.createDataFrame([], FOUND)
    by_length = written(impact_vectors(counted, weights, size.docs, size.terms), "lemp-vectors")
    # the longest vectors give the first cutoffs: one small task, k numbers per item
    longest = by_length.orderBy(F.desc("length"), "part").limit(FIRST).coalesce(1)
    first = _searched(longest, items, k).groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
    for r in first.collect():  # one row per item of the group
        if r.n == k:
            items.cutoff[r.item] = r.score
    # ``part`` splits documents of equal length
    ranged = by_length.repartitionByRange(F.desc("length"), "part").sortWithinPartitions(
        F.desc("length"), "part")
    return _searched(ranged, items, k)


def search(docs: DataFrame, items: DataFrame, k: int = K, group_items: int = GROUP_ITEMS,
           group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The best ``k`` documents (``doc_id``, ``text``) for each item (``item_id``,
    ``text``): ``item_id``, ``rank``, ``doc_id``, ``score`` above 0.

    * null or empty texts have no term: such documents are not counted, such
      items give no rows; very long texts count whole;
    * equal scores: the smaller ``doc_id`` first, a null one last; rows that
      repeat a ``doc_id`` are ranked each;
    * every row of ``items`` is an item of its own, also if it repeats an
      ``item_id``, whose ranks then stand once for each;
    * without documents or items there are no rows; other columns are not read.
    """
    spark = docs.sparkSession
    asked = written(items.select(F.monotonically_increasing_id().alias("_row"), "item_id",
                                 F.col("text").alias("_text")), "lemp-items")
    size = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("_text"))).first()
    groups = max(1, -(-size[0] // group_items), -(-(size[1] or 0) // group_bytes))
    group = F.pmod(F.xxhash64("_row"), F.lit(groups))
    out = None
    for g in range(groups):
        rows = asked.where(group == g).select("_row", "_text").collect()  # a bounded group
        found = _search_group(docs, [r._text for r in rows], k)
        numbers = spark.createDataFrame([(i, r._row) for i, r in enumerate(rows)],
                                        "item int, _row long")
        found = found.join(numbers, "item").select("_row", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    best = Window.partitionBy("_row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .join(asked.select("_row", "item_id"), "_row")
            .select("item_id", "rank", "doc_id", "score"))


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = f"""
WITH t AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS d, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
size AS (SELECT count(DISTINCT d) AS n_docs, count(*) AS n_terms FROM t),
q AS (
  SELECT item_id, term, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
tf AS (SELECT d, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, size GROUP BY term, n_docs),
m AS (SELECT d, {100 - LENGTH} + ({LENGTH} * count(*) * n_docs) // n_terms AS m
      FROM t, size GROUP BY d, n_docs, n_terms),
s AS (SELECT item_id, d, doc_id,
             CAST(sum(c * w * (({IMPACT} * tf) // (1000 * tf + {SATURATION} * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (d) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER)
         AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {K}"""
