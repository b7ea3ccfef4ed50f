"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into dictionary phrases: each phrase is the longest one seen
before plus one character, and joins the dictionary.  Texts that would
compress well together share phrases.  The fingerprint is the minimum-hash
signature of the phrase set; the share of equal entries of two signatures
estimates how much their phrase sets overlap.
"""

from __future__ import annotations

import gc
import hashlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import slices, table

ENTRIES, ROWS = 64, 256
#: Ranges of neighbouring documents per shuffle partition, and their largest number.
RANGES_PER_PARTITION, MAX_RANGES = 4, 10_000
#: Rows of one id that fill several ranges are cut by this many leading characters;
#: cuts are chosen from about this many of an id's beginnings per range.
HEAD, BEGINNINGS = 64, 16
_MASK, _MULTIPLIER = (1 << 60) - 1, 0x2545F4914F6CDD1D & ((1 << 60) - 1)
_rng = np.random.default_rng(20_240_601)
_A = _rng.integers(0, 1 << 32, ENTRIES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, ENTRIES, dtype=np.uint32)

PAIRS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
         "edited_fingerprint string, near_edited double, near_next double")


def phrases(prefix: str, tails: list[str]) -> list[list[int]]:
    """Hashes of the phrase sets of ``prefix + tail`` for every tail; the prefix
    is parsed once.  A phrase's hash depends on its characters only."""
    root: dict = {None: 1}  # a node: character -> node, None -> hash of its phrase
    shared: list[int] = []

    def parse(text: str, node: dict, out: list[int], added: list | None) -> dict:
        for ch in text:
            down = node.get(ch)
            if down is not None:
                node = down
                continue
            h = (node[None] * _MULTIPLIER + ord(ch)) & _MASK
            node[ch] = {None: h}
            out.append(h)
            if added is not None:
                added.append((node, ch))
            node = root
        return node

    at = parse(prefix, root, shared, None)
    sets = []
    for i, tail in enumerate(tails):
        own: list[int] = []
        added: list | None = [] if i + 1 < len(tails) else None
        parse(tail, at, own, added)
        sets.append(shared + own)
        for node, ch in reversed(added or []):
            del node[ch]
    return sets


def signature(hashes: list[int]) -> np.ndarray:
    """Minimum of each hash function over the set; all ones for the empty set."""
    out = np.full(ENTRIES, 0xFFFFFFFF, np.uint32)
    x = (np.array(hashes, np.uint64) >> np.uint64(28)).astype(np.uint32)  # the high bits
    for at in range(0, len(x), 4096):
        out = np.minimum(out, (x[at:at + 4096, None] * _A + _B).min(axis=0))
    return out


def fingerprint(text: str | None) -> np.ndarray:
    return signature(phrases(text or "", [""])[0])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex) for every row, in one pass without a shuffle."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, ROWS):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([as_text(fingerprint(t)) for t in b.column(1).to_pylist()],
                                       pa.string())], names=["doc_id", "fingerprint"])
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(
        run, "doc_id long, fingerprint string")


def _cuts(rows: DataFrame, n: int) -> tuple[list[int], dict[int, int]]:
    """Smallest key and ``n - 1`` percentiles; and of each key that holds more than
    a range's share of rows, how many ranges it fills."""
    at = [i / n for i in range(1, n)]
    got = rows.agg(F.min("k").alias("low"), F.count(F.lit(1)).alias("rows"),
                   F.percentile_approx("k", at or [0.5], 100 * n).alias("cuts")).first()
    if got.low is None:
        return [], {}
    cuts = [got.low, *(got.cuts if at else [])]
    often = [float(c) for c, times in Counter(cuts).items() if times > 1]
    if not often:
        return cuts, {}
    # a percentile is the double next to the key, so keys are counted by their doubles
    sizes = (rows.where(F.col("k").cast("double").isin(often)).groupBy("k").count()
             .where(F.col("count") * n > got.rows).collect())  # fewer than n
    hot = {r.k: -(-r["count"] * n // got.rows) for r in sizes}
    return sorted({*cuts, *hot}), hot


def _ranges(rows: DataFrame, n: int, found: list[int] | None = None) -> list[int]:
    """Ascending first keys of at most ``n`` ranges of ``rows``; each is the key of a row.

    Percentiles are doubles, so a cut beyond 2**53 may be no row's key; the
    smallest key at or above it is."""
    cuts = np.array(sorted(set(_cuts(rows, n)[0] if found is None else found)), np.int64)
    if not len(cuts):
        return []

    @F.pandas_udf("long")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(), side="right"))

    firsts = rows.groupBy(range_of("k").alias("range")).agg(F.min("k").alias("k"))
    return sorted(r.k for r in firsts.collect())  # at most n numbers


def _hot_starts(rows: DataFrame, wanted: dict[int, int], n: int) -> dict[int, list[str]]:
    """For every id that is to fill several ranges, the beginnings of text at
    which its ranges start, each that of a row.

    Beginnings are counted in Spark; the driver gets the frequent ones and a
    part of the others drawn by hash, about ``(BEGINNINGS + 4) * n`` in all."""
    if not wanted:
        return {}
    heads = (rows.where(F.col("k").isin(list(wanted)))
             .groupBy("k", F.substring("text", 1, HEAD).alias("head"))
             .agg(F.count(F.lit(1)).alias("c")))
    size = heads.agg(F.count(F.lit(1)).alias("d"), F.sum("c").alias("c")).first()
    every = max(1, size.d // (BEGINNINGS * n))
    drawn = heads.where((F.col("c") * 4 * n > size.c)
                        | (F.pmod(F.xxhash64("head"), F.lit(every)) == 0)).collect()
    cuts: dict[int, list[str]] = {}
    for k, parts in wanted.items():
        mine = sorted((r.head, r.c) for r in drawn if r.k == k)
        total, seen, cuts[k] = sum(c for _, c in mine), 0, []
        for head, c in mine:  # a cut before what passes the next share
            if seen * parts // total != (seen + c) * parts // total:
                cuts[k].append(head)
            seen += c

    @F.pandas_udf("int")
    def part_of(k: pd.Series, head: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(cuts[a], b) for a, b in zip(k, head)], dtype="int32")

    firsts = heads.groupBy("k", part_of("k", "head").alias("part")).agg(F.min("head").alias("head"))
    out: dict[int, list[str]] = {}
    for r in firsts.collect():  # at most twice n
        out.setdefault(r.k, []).append(r.head)
    return {k: sorted(v) for k, v in out.items()}


def with_successor(docs: DataFrame) -> DataFrame:
    """Fingerprint every text, its edited form, and compare with the next document.

    The edited text replaces the last ``floor(n / 2)`` characters by the first
    as many (or all) of the next document by ascending ``doc_id``; the first
    document follows the last.

    Documents are dealt to ranges of neighbouring ids, so a text moves once;
    the first document of a range is also sent to the range before it.  An id
    (or no id) that fills several ranges is cut by the beginnings of its texts,
    which follow the order of the texts; only rows that share the id and the
    first ``HEAD`` characters stay together (and ids beyond 2**53 that are the
    same double, since percentiles are doubles).

    * a null text counts as empty; a null ``doc_id`` comes first;
    * rows with equal ``doc_id`` follow each other by text; a single document
      follows itself;
    * other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MAX_RANGES, parts * RANGES_PER_PARTITION)
    found, sizes = _cuts(rows, wanted)
    firsts = _ranges(rows, wanted, found)
    hot = _hot_starts(rows, sizes, wanted)
    # ranges in order; a range of an id's rows is named by its first beginning
    starts = np.array(firsts, np.int64)
    before_of = np.concatenate([[0], np.cumsum([len(hot.get(k, "-")) for k in firsts])]).astype(int)
    n = max(1, int(before_of[-1]))

    @F.pandas_udf("long")
    def place(k: pd.Series, head: pd.Series) -> pd.Series:
        """Twice the range, plus one for rows that may be its first."""
        keys = k.to_numpy()
        at = np.searchsorted(starts, keys, side="right") - 1
        first = starts[at] == keys
        out = 2 * before_of[at] + first
        for i in np.flatnonzero(np.isin(starts[at], list(hot))) if hot else ():
            names = hot[int(starts[at[i]])]
            j = bisect_right(names, head[i]) - 1 if first[i] else len(names) - 1
            out[i] = 2 * (before_of[at[i]] + j) + (first[i] and names[j] == head[i])
        return pd.Series(out)

    own = F.struct(F.floor(F.col("p") / 2).cast("int").alias("range"),
                   F.lit(False).alias("after"))
    before = F.struct(F.pmod(F.floor(F.col("p") / 2) - 1, F.lit(n)).cast("int").alias("range"),
                      F.lit(True).alias("after"))
    dealt = (rows.withColumn("p", place("k", F.substring("text", 1, HEAD)))
             .select("doc_id", "text", "k", F.explode(
                 F.when(F.col("p") % 2 == 1, F.array(own, before)).otherwise(F.array(own))
             ).alias("to"))
             .select("doc_id", "text", "k", "to.range", "to.after")
             # neighbouring ranges share a partition, as many in each
             .repartitionById(parts, F.floor(F.col("range") * parts / n).cast("int"))
             .sortWithinPartitions("range", "after", "k", "text")
             .select("range", "after", "doc_id", "text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the dictionaries have no cycles
        held = None  # range, doc_id, text of the document whose successor comes next
        closed, followed = None, []
        for b in slices(batches, ROWS):
            out = []
            for rng, after, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                if closed == rng:
                    continue  # only the smallest text that starts the next range follows
                if held is not None and held[0] == rng:
                    half = len(held[2]) // 2
                    edited = held[2][:len(held[2]) - half] + text[:half]
                    plain, other = map(signature, phrases(
                        held[2][:len(held[2]) - half], [held[2][len(held[2]) - half:], text[:half]]))
                    if followed:  # the document before waits for this fingerprint
                        out.append((*followed.pop(), plain))
                    followed.append((held[1], len(held[2]),
                                     hashlib.sha256(edited.encode()).hexdigest(), plain, other))
                    if after:
                        out.append((*followed.pop(), fingerprint(text)))
                        held, closed = None, rng
                        continue
                held = (rng, doc_id, text)
            if out:
                yield _rows(out)

    return dealt.mapInArrow(run, PAIRS)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    ids, sizes, shas, plain, other, following = zip(*out)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
         pa.array(map(as_text, plain), pa.string()), pa.array(map(as_text, other), pa.string()),
         pa.array(map(likeness, plain, other), pa.float64()),
         pa.array(map(likeness, plain, following), pa.float64())],
        names=[x.split()[0] for x in PAIRS.split(", ")])


def op6_lz_fingerprint(spark, sf_dir: str) -> DataFrame:
    return with_successor(table(spark, sf_dir, "documents"))
