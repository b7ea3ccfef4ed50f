"""Toxicity by cumulative-link ordinal regression.

Severity grades are ordered: 0 is clean, 1 to 3 are increasingly toxic.  One
weight vector over sparse text features (which words occur) is shared by all
thresholds: ``P(grade >= k) = logistic(w . x - t_k)`` with ``t_1 < t_2 < t_3``.
The expected severity is the sum of these probabilities.

The labels say toxic or not; among toxic training rows the grade follows how
many distinct words they have that mark toxic rows (``SEVERE_AT``).

The model is fitted on a bounded sample of labelled rows (``TRAIN_ROWS``, the
smallest hashes of ``doc_id``); scoring covers every whole text in one pass
without a shuffle.  An L1 penalty keeps the broadcast model to the words that
matter; ``MAX_WORDS`` bounds it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import slices, table

TRAIN_ROWS, MAX_WORDS, ROWS = 12_000, 200_000, 512
#: Distinct marking words from which a toxic training row has grade 2, and grade 3.
SEVERE_AT = (3, 6)
#: A word marks toxic rows if it is this many times as common in them as in clean rows.
MARK_LIFT = 20
#: Least G statistic (one degree of freedom) of a word that becomes a feature.
LEAST_G = 16.0
#: Least ratio of a feature's share among toxic rows to that among clean rows.
LEAST_LIFT = 2
SCHEMA = "doc_id long, expected_severity double, p_toxic double, grade int, toxic boolean"

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    """The sparse features of a text: its distinct lower-cased runs of letters."""
    return set(_WORD.findall((text or "").lower()))


@dataclass
class OrdinalModel:
    weights: dict[str, float]
    thresholds: list[float]

    def exceed(self, found: set[str]) -> list[float]:
        """P(grade >= k) for every k from 1."""
        # sorted: the sum must not depend on the order of a set
        eta = sum(self.weights[w] for w in sorted(found & self.weights.keys()))
        return [float(1 / (1 + np.exp(min(max(t - eta, -500), 500)))) for t in self.thresholds]


def grades(rows: list[tuple[set[str], int]]) -> list[int]:
    """Severity grade of labelled rows (words, toxic 0 or 1)."""
    n = max(1, sum(t for _, t in rows))
    m = max(1, len(rows) - n)
    toxic = Counter(w for x, t in rows if t for w in x)
    clean = Counter(w for x, t in rows if not t for w in x)
    marks = {w for w, k in toxic.items() if k > 2 and k / n >= MARK_LIFT * (clean[w] + 1) / m}
    return [1 + sum(len(x & marks) >= s for s in SEVERE_AT) if t else 0 for x, t in rows]


def telling(rows: list[tuple[set[str], int]], least: float = LEAST_G) -> list[str]:
    """Words more common in toxic rows than in clean ones by the G test, in order.

    Words that are common in clean rows would only make long texts look clean.
    """
    n = np.array([sum(g == 0 for _, g in rows), sum(g > 0 for _, g in rows)], float)
    found = [Counter(w for x, g in rows if (g > 0) == k for w in x) for k in (False, True)]
    vocabulary = sorted(w for w in found[0].keys() | found[1].keys()
                        if found[0][w] + found[1][w] > 2)
    inside = np.array([[found[k][w] for w in vocabulary] for k in (0, 1)], float).reshape(2, -1)
    g = 0
    for cell in (inside, n[:, None] - inside):
        expected = cell.sum(0) * n[:, None] / n.sum()
        g = g + 2 * (cell * np.log(np.maximum(cell, 1e-300) / np.maximum(expected, 1e-300))).sum(0)
    more = inside[1] * n[0] >= LEAST_LIFT * inside[0] * n[1]
    return [w for w, v, up in zip(vocabulary, g, more) if up and v >= least]


def fit(rows: list[tuple[set[str], int]], levels: int = 3, l1: float = 0.3,
        steps: int = 800, rate: float = 0.05) -> OrdinalModel:
    """Fit on (words, grade) rows by proximal steps (Adam's scaling) on the summed loss.

    Without rows of both kinds there is nothing to learn: no weights, and
    thresholds that call nothing toxic.
    """
    y = np.array([g for _, g in rows], int)
    if not len(y) or not (y > 0).any() or (y > 0).all():
        return OrdinalModel({}, [20.0 + k for k in range(levels)])
    vocabulary = telling(rows)
    index = {w: i for i, w in enumerate(vocabulary)}
    lists = [sorted(index[w] for w in x if w in index) for x, _ in rows]
    col = np.fromiter((i for x in lists for i in x), np.int64)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    w, n_words = np.zeros(len(vocabulary)), len(vocabulary)
    share = [(y > k).mean() for k in range(levels)]
    t = np.array([np.log((1 - s + 1e-3) / (s + 1e-3)) for s in share]) + 0.1 * np.arange(levels)
    mean, square = np.zeros(n_words + levels), np.zeros(n_words + levels)
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -40, 40)))
    low = np.concatenate([[-40.0], np.zeros(levels)])  # threshold below grade k
    for k in range(1, steps + 1):
        eta = np.bincount(row, w[col], len(y))
        low[1:] = t
        a = sigmoid(eta - low[y])
        b = np.where(y < levels, sigmoid(eta - np.append(t, 0)[y]), 0.0)
        a = np.where(y > 0, a, 1.0)
        p = np.maximum(a - b, 1e-9)
        slope = 1 - a - b
        at = [(a * (1 - a) / p)[y == j + 1].sum() - (b * (1 - b) / p)[y == j].sum()
              for j in range(levels)]
        g = np.append(-np.bincount(col, slope[row], n_words), at)
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        step = rate / (np.sqrt(square / (1 - 0.99 ** k)) + 1e-3)
        move = step * mean / (1 - 0.9 ** k)
        w = w - move[:n_words]
        w = np.sign(w) * np.maximum(np.abs(w) - step[:n_words] * l1, 0)
        t = np.maximum.accumulate(t - move[n_words:] + 1e-3 * np.arange(levels))
    return OrdinalModel({v: float(x) for v, x in zip(vocabulary, w) if abs(x) > 1e-6},
                        [float(x) for x in t])


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS
                  ) -> list[tuple[set[str], int]]:
    """At most ``limit`` labelled documents: those with the smallest hash of ``doc_id``.

    Rows without ``doc_id`` or label are left out; a ``doc_id`` labelled twice
    counts as toxic if one label says so.
    """
    chosen = (labels.filter("doc_id is not null and toxic is not null")
              .groupBy(F.col("doc_id").cast("long").alias("_id"))
              .agg(F.max("toxic").cast("int").alias("_toxic"))
              .orderBy(F.xxhash64("_id"), "_id").limit(limit))

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, ROWS):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array([" ".join(sorted(words(t))) for t in b.column(2).to_pylist()])],
                names=["doc_id", "toxic", "words"])

    # the sample is bounded by ``limit`` rows of two numbers
    rows = (docs.selectExpr("cast(doc_id as long) as _id", "text")
            .join(F.broadcast(chosen), "_id").select("_id", "_toxic", "text")
            .mapInArrow(features, "doc_id long, toxic int, words string")
            .orderBy("doc_id", "words").limit(limit))
    same: dict[str, str] = {}  # one object per distinct word
    return [({same.setdefault(w, w) for w in r.words.split()}, int(r.toxic > 0))
            for r in rows.collect()]


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> OrdinalModel:
    rows = training_rows(docs, labels, limit)
    model = fit([(x, g) for (x, _), g in zip(rows, grades(rows))])
    if len(model.weights) > MAX_WORDS:
        raise ValueError(f"the model has more than {MAX_WORDS} words")
    return model


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """``doc_id``, ``expected_severity`` (0 to 3), ``p_toxic``, ``grade``, ``toxic`` per row.

    * null and empty texts have no feature; they are scored by the thresholds
      alone (clean);
    * repeated rows each give a row, a null ``doc_id`` is kept;
    * other columns are not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, ROWS):
            p = [m.exceed(words(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([round(sum(x), 9) for x in p], pa.float64()),
                 pa.array([round(x[0], 9) for x in p], pa.float64()),
                 pa.array([sum(v >= 0.5 for v in x) for x in p], pa.int32()),
                 pa.array([x[0] >= 0.5 for x in p], pa.bool_())],
                names=["doc_id", "expected_severity", "p_toxic", "grade", "toxic"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows of ``docs`` that are not toxic, unchanged and with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, ROWS):
            keep = [m.exceed(words(t))[0] < 0.5 for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # any column name will do
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
