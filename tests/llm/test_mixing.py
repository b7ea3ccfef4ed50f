import random

import pytest
from pyspark.sql import functions as F

from helpers import docs, with_clashes
from tidewatch.llm import mixing as M


def corpus(n=400, seed=7):
    rnd = random.Random(seed)
    texts = ["plain words here ", "all rights reserved ", "mail a@b.cd ", "x | y | z "]
    return [(i, rnd.choice(texts) * rnd.randint(1, 9), rnd.choice(["en", "en", "de", None]),
             "hot" if rnd.random() < 0.4 else f"s{rnd.randrange(5)}") for i in range(n)]


def test_marginals_meet_their_targets(spark):
    cells = M.features(docs(spark, corpus())).groupBy(*M.CELL).agg(
        F.sum("n_tokens").alias("tokens"))
    got = M.rake(cells).collect()
    total = sum(r.tokens for r in got)
    for dim, power in M.EXPONENTS.items():
        before, after = {}, {}
        for r in got:
            before[r[dim]] = before.get(r[dim], 0) + r.tokens
            after[r[dim]] = after.get(r[dim], 0) + r.tokens * r.weight
        norm = sum(v ** power for v in before.values())
        for k, v in before.items():
            assert after[k] == pytest.approx(total * v ** power / norm, rel=1e-6)


@pytest.mark.parametrize("budget", [0.3, 0.8, 1.0, 5.0])
def test_expected_tokens_meet_the_budget(spark, budget):
    got = M.mix(docs(spark, corpus()), budget=budget).collect()
    total = sum(r.n_tokens for r in got)
    expected = sum(r.n_tokens * r.probability for r in got)
    assert expected == pytest.approx(min(1, budget) * total, rel=1e-4)
    drawn = sum(r.n_tokens for r in got if r.sampled)
    assert abs(drawn - expected) < 0.2 * total
    assert all(0 <= r.probability <= 1 for r in got)


def test_targets_that_cannot_be_met_tell_their_misses(spark):
    """Source A is all English, source B all German: A's target fixes English."""
    cells = spark.createDataFrame([("A", "en", "x", 8000), ("B", "de", "x", 2000)],
                                  "source string, lang string, topic string, tokens long")
    got = {r.lang: r for r in M.rake(cells).collect()}
    a = 8000 ** 0.5 / (8000 ** 0.5 + 2000 ** 0.5)
    en = 8000 ** 0.7 / (8000 ** 0.7 + 2000 ** 0.7)
    assert got["en"].weight * 8000 / 10000 == pytest.approx(a)  # sources are met
    assert got["en"].lang_miss == pytest.approx(a - en)
    assert got["de"].lang_miss == pytest.approx(en - a)
    assert got["en"].topic_miss == pytest.approx(0, abs=1e-9)
    df = docs(spark, [(i, "w " * 80, "en", "A") for i in range(100)]
              + [(100 + i, "w " * 80, "de", "B") for i in range(25)])
    missed = {r.lang: r.lang_miss for r in M.mix(df).collect()}
    assert missed == {"en": round(a - en, 6), "de": round(en - a, 6)}


def test_slow_targets_are_still_met(spark):
    """Three sources joined by small cells only: many rounds, and no miss."""
    cells = spark.createDataFrame([("A", "en", "x", 4000), ("A", "de", "x", 150), ("B", "de", "x", 2000),
                                   ("B", "fr", "x", 900), ("C", "fr", "x", 5000), ("C", "en", "x", 200)],
                                  "source string, lang string, topic string, tokens long")
    got = M.rake(cells).collect()
    assert all(abs(r.lang_miss) < 1e-9 and abs(r.topic_miss) < 1e-9 for r in got)
    total = sum(r.tokens for r in got)
    for lang in ("en", "de", "fr"):
        share = sum(r.tokens for r in got if r.lang == lang)
        want = share ** 0.7 / sum(n ** 0.7 for n in (4200, 2150, 5900))
        assert sum(r.tokens * r.weight for r in got if r.lang == lang) == pytest.approx(total * want)


def test_sampled_rows_are_those_marked(spark):
    df = with_clashes(docs(spark, corpus() + [(None, None, None, None), (3, "dup"), (3, "dup")]))
    marked = sorted((r.doc_id or -1) for r in M.mix(df).collect() if r.sampled)
    left = M.sampled(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id or -1) for r in left.collect()) == marked


def test_rare_groups_gain_on_hot_ones(spark):
    got = M.mix(docs(spark, corpus())).groupBy("source").agg(
        (F.sum(F.col("n_tokens") * F.col("weight")) / F.sum("n_tokens")).alias("w")).collect()
    w = {r.source: r.w for r in got}
    assert w["hot"] == min(w.values())


def test_edge_cases(spark):
    assert M.mix(docs(spark, [])).count() == 0 and M.sampled(docs(spark, [])).count() == 0
    got = M.mix(docs(spark, [(1, None, None, None), (2, "", "en", "a"), (None, " ", "en", "a")]))
    assert [r.probability for r in got.collect()] == [1.0] * 3  # nothing to weigh
    got = M.mix(docs(spark, [(1, "a b", "en", "a"), (2, None, "xx", "empty"), (3, "c " * 9999)]))
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {1: 2, 2: 0, 3: 9999}
    too_many = spark.createDataFrame([("s", f"l{i}", "t", 1) for i in range(M.MAX_PAIRS + 1)],
                                     "source string, lang string, topic string, tokens long")
    with pytest.raises(ValueError):
        M.rake(too_many)
