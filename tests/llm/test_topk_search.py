import math
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import topk_search as T

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, given):
    return spark.createDataFrame([(i, v, 0) for i, v in given], SCHEMA)


def brute(given, k=5, every=50):
    import numpy as np
    rows = set()
    for i, v in given:
        if i is not None and v is not None and all(
                x is not None and math.isfinite(np.float32(x)) for x in v):
            rows.add((i, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for q, x in rows:
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if (i, y) != (q, x))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def run(df, **kw):
    return sorted(tuple(r) for r in T.search(df, **kw).select("query_id", "rank", "vec_id", "score")
                  .collect())


def corpus(n=260, dims=9, seed=1):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    given = [(i, [c + rnd.gauss(0, .5) for c in rnd.choice(centres)]) for i in range(n)]
    hot = given[50][1]
    given += [(i, hot) for i in range(1000, 1150)]       # copies, queries among them
    given += [(1000, hot), (1000, hot), (1000, given[3][1])]  # repeats, and an id with two vectors
    given += [(None, hot), (2000, None), (2050, [1.0, None]), (2100, [float("nan")] * dims),
              (2150, [float("inf")] * dims), (2200, []), (2250, [1.0]), (2300, [0.0] * dims),
              (2350, [-1.0] * dims), (2400, [3.0] * (dims + 4))]
    return given


@pytest.mark.parametrize("kw", [{}, {"parts": 4, "size": 6}, {"parts": 1}, {"k": 1}])
def test_equals_brute_force(spark, kw, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_BITS", 5)
    monkeypatch.setattr(T, "QUERY_BITS", 3)
    given = corpus()
    df = frame(spark, given).withColumn("score", F.lit("x")).withColumn("vid", F.lit("x"))
    assert run(df.repartition(5), **kw) == brute(given, kw.get("k", 5))


def test_large_components(spark):
    rnd = random.Random(4)
    given = [(i, [rnd.uniform(-1e6, 1e6) for _ in range(4)]) for i in range(120)]
    assert run(frame(spark, given)) == brute(given)
    with pytest.raises(ValueError, match="64 bits"):
        T.search(frame(spark, [(0, [1e9, 1e9]), (1, [1e9, 1e9])]))


def test_few_rows(spark):
    assert run(frame(spark, [])) == []
    assert run(frame(spark, [(50, [1.0])])) == []
    assert run(frame(spark, [(1, [1.0]), (2, [1.0])])) == []
    assert run(frame(spark, [(0, [1.0]), (2, [2.0])])) == [(0, 1, 2, 131072)]


def test_nodes_send_and_look_up_few_of_all_entries(spark, monkeypatch):
    """The threshold holds back most entries, and few vectors are looked up."""
    told = {}
    for name in ("entries", "lookups"):
        def seen(*a, f=getattr(T, name), name=name):
            told[name] = f(*a)
            return told[name]
        monkeypatch.setattr(T, name, seen)
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    T.search(df).count()
    n, q = df.count(), df.where("vec_id % 50 = 0").count()
    sent, asked = (told[x].agg(F.sum(F.length("places") / 8)).first()[0] for x in ("entries", "lookups"))
    assert sent < 0.3 * 2 * n * q and asked < 0.2 * 2 * n * q
