import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from helpers import docs, with_clashes
from tidewatch.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(given, items, k=10):
    bags = [(i, Counter(words(t))) for i, t in given if words(t)]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        rows = []
        for i, b in bags:
            m = 25 + (75 * sum(b.values()) * n_docs) // n_terms
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10**9 * b[t]) // (1000 * b[t] + 8 * m))
                    for t, c in Counter(words(text)).items() if t in b)
            if s > 0:
                rows.append((-s, i is None, i or 0, i))
        out += [(str(item), r, i, -s) for r, (s, _, _, i) in
                enumerate(sorted(rows, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def corpus(n=300, seed=2):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)] + ["É", "naïve", "X9", "x9", "\x85dot"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    def text(size):
        return rnd.choice([" ", "-", "\t", "_"]).join(rnd.choices(vocabulary, weights, k=size))
    given = [(i, text(rnd.randint(0, 60))) for i in range(n)]
    copy = text(30)
    given += [(1000 + i, copy) for i in range(40)] + [(1000, copy), (None, copy), (None, None),
             (2000, ""), (2001, "..., ;"), (2002, text(40_000)), (2003, "lonely")]
    items = [(i, text(rnd.randint(1, 25))) for i in range(12)] + [
        (50, copy), (50, "lonely lonely"), (51, None), (52, ""), (53, "unknown words"), (None, "w1 W1")]
    return given, items


def run(spark, given, items, **kw):
    found = S.search(with_clashes(docs(spark, given)).withColumnRenamed("item_id", "x"),
                     spark.createDataFrame(items, "item_id long, text string"), **kw).collect()
    return sorted(((str(r.item_id), r["rank"], r.doc_id, r.score) for r in found), key=str)


@pytest.mark.parametrize("kw", [{}, {"group_items": 5}, {"k": 3}])
def test_equals_brute_force(spark, kw, monkeypatch):
    monkeypatch.setattr(S, "BUCKET", 32)
    monkeypatch.setattr(S, "FIRST", 20)
    given, items = corpus()
    assert run(spark, given, items, **kw) == brute(given, items, kw.get("k", 10))


def test_no_documents_and_no_items(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, None)], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []


def test_bounds_drop_pairs_but_none_that_counts():
    """Random vectors: survivors hold every pair at or above the cutoff, and not all pairs."""
    rnd = np.random.default_rng(0)
    n_terms, n_docs, n_items = 400, 500, 20
    weights = rnd.integers(1, 9000, n_terms)
    vectors = [{int(t): int(rnd.integers(1, 4)) for t in rnd.choice(n_terms, 25, replace=False)}
               for _ in range(n_items)]
    items = S.Items.of(vectors, weights)
    row = np.repeat(np.arange(n_docs), 30)
    term = np.concatenate([np.sort(rnd.choice(n_terms, 30, replace=False)) for _ in range(n_docs)])
    impact = rnd.integers(100_000, 990_000, len(row))
    length = np.sqrt(np.bincount(row, weights[term] * (impact * 1.0) ** 2))
    scores = S.Bucket(items, length, row, term, impact).scores(np.arange(n_items * n_docs)).reshape(
        n_items, n_docs)
    for i, d in ((0, 0), (7, 123), (19, 499)):
        own = dict(zip(term[row == d].tolist(), impact[row == d].tolist()))
        assert scores[i, d] == sum(c * int(weights[t]) * own.get(t, 0) for t, c in vectors[i].items())
    items.cutoff = np.sort(scores, 1)[:, -10]
    bucket = S.Bucket(items, length, row, term, impact)
    kept = set(bucket.survivors(items).tolist())
    wanted = set(np.flatnonzero(scores >= items.cutoff[:, None]).tolist())
    assert bucket.active.all() and wanted <= kept and len(kept) < 0.5 * n_items * n_docs
    items.cutoff[:10] = 2 * scores[:10].sum(1)  # out of reach
    assert S.Bucket(items, length, row, term, impact).active.tolist() == [False] * 10 + [True] * 10
