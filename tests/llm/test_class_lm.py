import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from helpers import docs, with_clashes
from tidewatch.llm import class_lm as L


def corpus(n=150, seed=3):
    """Two languages whose words never mix, so classes help."""
    rnd = random.Random(seed)
    vocabularies = [[f"{p}{i}" for i in range(60)] for p in ("an", "zu")]
    out = []
    for i in range(n):
        v = vocabularies[i % 2]
        out.append((i, " ".join(rnd.choice(v) + rnd.choice(["", "", "X"])
                                for _ in range(rnd.randint(1, 60)))))
    return out


def brute_tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [""]


def held(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1


@pytest.mark.parametrize("block_tokens", [10, 1_000_000])
def test_counts_and_base_score(spark, block_tokens):
    given = corpus(60) + [(None, None), (901, ""), (902, "É\xa0b\x1cc \x0b d"), (7, "an1 AN1 new"),
                          (903, "far " * 20_000)]
    got = L.score_documents(with_clashes(docs(spark, given)), classes=4, rounds=2,
                            block_tokens=block_tokens).collect()
    count = Counter(w for i, t in given if not held(i) for w in brute_tokens(t))
    n, kinds = sum(count.values()), len(count)
    expected = []
    for i, t in given:
        w = brute_tokens(t)
        base = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (kinds + 1))) for x in w)
        expected.append((str(i), held(i), len(w), sum(count[x] > 0 for x in w), n, round(base, 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 6)) for r in got) == sorted(expected)
    assert all(r.score < 0 for r in got)


def test_classes_beat_the_unigram_on_held_out_texts(spark):
    got = [r for r in L.score_documents(docs(spark, corpus()), classes=4).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 5


def test_block_size_does_not_change_scores(spark):
    df = docs(spark, corpus(60))
    a, b = ({r.doc_id: r.score for r in L.score_documents(df, classes=4, block_tokens=n).collect()}
            for n in (50, 10**6))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_exchange_gain_is_the_change_of_the_likelihood():
    rng = np.random.default_rng(1)
    units, classes = 12, 4
    n = rng.integers(0, 9, (units, units)).astype(float)
    cls = rng.integers(0, classes, units)

    def table(c):
        out = np.zeros((classes, classes))
        for u in range(units):
            for v in range(units):
                out[c[u], c[v]] += n[u, v]
        return out
    for w in range(units):
        after = np.bincount(cls, n[w], classes)
        before = np.bincount(cls, n[:, w], classes)
        best = L.best_class(int(cls[w]), after, before, n[w, w], table(cls))
        values = [L.likelihood(table(np.where(np.arange(units) == w, k, cls)))
                  for k in range(classes)]
        assert values[best] == pytest.approx(max(values), abs=1e-6)


def test_probabilities_sum_to_one(spark):
    """Over all training words and the unknown one, after any word."""
    df = docs(spark, corpus(40))
    blocks = L.blocks_of(df)
    n = sum(r.n_train for r in blocks.collect())
    replies = L.corpus_counts(blocks, 8, n)
    m = L.train(blocks, replies, n, classes=4)
    count = Counter(w for i, t in corpus(40) if not held(i) for w in brute_tokens(t))
    cls = {w: int(m.unit_class[m.unit_of([w.encode()])[0]]) for w in count}
    space = m.class_tokens + 0.5 * (m.class_kinds + 1)
    for k in range(4):
        p = sum(m.transitions()[k, cls[w]] * (c + 0.5) / space[cls[w]] for w, c in count.items())
        assert p + (m.transitions()[k] @ (0.5 / space)) == pytest.approx(1)


def test_words_of_few_tokens_are_units_however_large_the_corpus(spark):
    """Words far below 1e-4 of all tokens, with one ending, in two contexts that never mix."""
    rnd = random.Random(4)
    given = [(i, "far " * 12_000) for i in range(60)]
    for i in range(60, 120):
        a, b = ("an", "zu") if i % 2 else ("ke", "lo")
        given.append((i, " ".join(f"{rnd.choice((a, b))}{rnd.randint(0, 2)}end {a}" for _ in range(8))))
    df = docs(spark, given)
    blocks = L.blocks_of(df)
    n = sum(r.n_train for r in blocks.collect())
    m = L.train(blocks, L.corpus_counts(blocks, 8, n), n, classes=4)
    count = Counter(w for i, t in given if not held(i) for w in brute_tokens(t))
    words = [f"{p}{k}end" for p in ("an", "zu", "ke", "lo") for k in range(3)]
    assert all(L.LEAST <= count[w] < 1e-4 * n for w in words)
    cls = [int(m.unit_class[u]) for u in m.unit_of([w.encode() for w in words])]
    assert set(cls[:6]).isdisjoint(cls[6:])


def test_nothing_to_learn(spark):
    assert L.score_documents(docs(spark, [])).count() == 0
    only_held = [(i, "a b") for i in range(200) if held(i)][:5]
    got = L.score_documents(docs(spark, only_held)).collect()
    assert len(got) == 5 and all(r.base_score == 0 and abs(r.score) < 1e-9 for r in got)


def test_scores_equal_a_plain_model_with_the_same_classes(spark):
    """Counts, class pairs, transitions, emissions and the mixture from plain dictionaries
    over the texts; only the class of a word is taken from the trained model."""
    given = corpus(60) + [(901, ""), (902, "never an1 seen zu2 before"), (903, "an1 " * 500),
                          (904, "an3 zu4"), (904, "an3 zu4"), (905, None), (906, "unseen words only")]
    df = docs(spark, given)
    blocks = L.blocks_of(df, 400)
    n = sum(r.n_train for r in blocks.collect())
    replies = L.corpus_counts(blocks, 3, n)
    m = L.train(blocks, replies, n, classes=4)
    tokens = [(i, brute_tokens(t)) for i, t in given]
    words = sorted({w for _, ws in tokens for w in ws})
    cls = dict(zip(words, m.unit_of([w.encode() for w in words]).tolist()))
    assert len(set(cls.values())) == 4
    count, pairs = Counter(), Counter()
    for i, ws in tokens:
        if not held(i):
            count.update(ws)
            pairs.update((cls[a], cls[b]) for a, b in zip(["", *ws], ws))
    total = sum(count.values())
    mass = {k: sum(c for w, c in count.items() if cls[w] == k)
            + 0.5 * (1 + sum(cls[w] == k for w in count)) for k in range(4)}

    def move(a, b):
        return (pairs[a, b] + 0.5) / (sum(pairs[a, k] for k in range(4)) + 0.5 * 4)

    def log_p(ws):
        out = 0.0
        for prev, w in zip(["", *ws], ws):
            a = cls[prev]
            by_class = (move(a, cls[w]) * (count[w] + 0.5) / mass[cls[w]] if count[w]
                        else sum(move(a, k) * 0.5 / mass[k] for k in range(4)))
            plain = (count[w] + 0.5) / (total + 0.5 * (len(count) + 1))
            out += math.log10(0.9 * by_class + 0.1 * plain)
        return out
    got = L.score_blocks(blocks, replies, m, 3).collect()
    assert any(held(i) and "" not in ws[:-1] for i, ws in tokens)
    assert sorted((r.doc_id, round(r.score, 7)) for r in got) == sorted(
        (i, round(log_p(ws), 7)) for i, ws in tokens)
