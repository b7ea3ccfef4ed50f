import random

import pytest

from helpers import docs, with_clashes
from tidewatch.llm import toxicity as T

BAD = ["vilify", "grubber", "snarl", "rotter", "cadge", "lout"]


def corpus(n, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        w = [f"w{rnd.randrange(400)}".translate(str.maketrans("0123456789", "abcdefghij"))
             for _ in range(rnd.randint(5, 80))]
        bad = rnd.random() < 0.2
        if bad:
            w += rnd.sample(BAD, rnd.randint(1, 6))
        rnd.shuffle(w)
        out.append((i, " ".join(w), int(bad)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = [(T.words(t), y) for _, t, y in corpus(1500)]
    return T.fit([(x, g) for (x, _), g in zip(rows, T.grades(rows))])


def test_held_out_accuracy(model):
    held = corpus(800, seed=2)
    right = [(model.exceed(T.words(t))[0] >= 0.5) == bool(y) for _, t, y in held]
    assert sum(right) / len(right) > 0.98


def test_thresholds_are_ordered_and_share_weights(model):
    assert model.thresholds == sorted(model.thresholds)
    values = [sum(model.exceed(set(BAD[:k]))) for k in range(len(BAD) + 1)]
    assert values == sorted(values) and values[0] < 0.5 < 2 < values[-1]
    for k in range(len(BAD) + 1):
        p = model.exceed(set(BAD[:k]))
        assert p == sorted(p, reverse=True)


def test_nothing_to_learn():
    for rows in ([], [({"a"}, 0)], [({"a"}, 1)]):
        m = T.fit(rows)
        assert m.exceed({"a"})[0] < 0.5


def test_operator_and_edge_cases(spark):
    rows = corpus(600)
    text_rows = [(i, t) for i, t, _ in rows]
    df = docs(spark, text_rows)
    labels = spark.createDataFrame(
        [(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (5, 1, None), (10_000, 0, 1)],
        "doc_id long, quality int, toxic int")
    model = T.train(df, labels)
    odd = with_clashes(docs(spark, [(1, None), (2, ""), (None, " ".join(BAD)), (3, "wab " * 50_000),
                                    (3, "wab " * 50_000), (4, "Snarl, VILIFY! rotter grubber")]))
    got = {(r.doc_id, r.toxic) for r in T.score(odd, model).collect()}
    assert got == {(1, False), (2, False), (None, True), (3, False), (4, True)}
    left = T.keep_clean(odd, model)
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 3]
    for r in T.score(df, model).collect():
        assert 0 <= r.expected_severity <= 3 and r.toxic == (r.p_toxic >= 0.5)
    empty = labels.limit(0)
    assert not T.train(df, empty).weights
    assert T.score(docs(spark, []), model).count() == 0


def test_sample_is_bounded(spark):
    rows = corpus(50)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    assert len(T.training_rows(docs(spark, [r[:2] for r in rows]), labels, limit=20)) == 20
