import hashlib
import random

import numpy as np
import pytest

from helpers import docs, with_clashes
from tidewatch.llm import lz_fingerprint as Z


def brute(text):
    seen, now = set(), ""
    for c in text:
        now += c
        if now not in seen:
            seen.add(now)
            now = ""
    hashes = []
    for phrase in seen:
        h = 1
        for c in phrase:
            h = (h * Z._MULTIPLIER + ord(c)) & Z._MASK
        hashes.append(h)
    return Z.signature(hashes)


def expected(given):
    order = sorted(((i if i is not None else -(1 << 63), (t or "").encode(), i) for i, t in given))
    texts = [t.decode() for _, t, _ in order]
    out = []
    for (_, _, i), text, after in zip(order, texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = brute(text), brute(edited), brute(after)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), Z.as_text(a),
                    Z.as_text(b), Z.likeness(a, b), Z.likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("given", [
    [], [(4, "only one")], [(7, "q"), (7, "q")], [(1, None), (2, "")],
    [(None, "x"), (None, None), (3, "aaaa"), (3, "bb"), (3, "bb"), (9, ""), (10, "é中🙂" * 30)],
    [(i * 7, f"{i} " * (i % 9)) for i in range(300)],
    [(5, "long text of many words " * 5000), (6, "x" * 100_000), (2, "short")],
])
def test_equals_brute_force(spark, given):
    got = Z.with_successor(with_clashes(docs(spark, given))).collect()
    assert sorted(map(tuple, got), key=str) == expected(given)


def test_ids_beyond_doubles_keep_every_row(spark):
    """Percentiles of 64-bit ids are rounded, range starts must not be."""
    rnd = random.Random(5)
    given = [(rnd.randrange(-(1 << 63), 1 << 63), f"text {i} " * (i % 5)) for i in range(500)]
    given += [((1 << 62) + i, f"near {i}") for i in range(200)] + [(None, "no id")]
    df = docs(spark, given)
    keys = {i if i is not None else -(1 << 63) for i, _ in given}
    starts = Z._ranges(df.selectExpr("coalesce(doc_id, -9223372036854775807L - 1) as k"), 32)
    assert len(starts) > 16 and keys.issuperset(starts)
    got = Z.with_successor(df).collect()
    assert sorted(map(tuple, got), key=str) == expected(given)


@pytest.mark.parametrize("hot", [None, 77, (1 << 62) + 1])
def test_a_hot_id_fills_several_ranges(spark, hot):
    """A third of the rows under one id: its rows are split by their texts, repeats
    and shared beginnings included, and the order of the texts is kept."""
    rnd = random.Random(9)
    texts = [f"{rnd.randrange(10 ** 6)} words of text " * (i % 4) for i in range(200)]
    texts += ["one text " * 9] * 40 + ["shared beginning " * 8 + str(i) for i in range(60)]
    given = [(hot, t) for t in texts] + [(i, f"own {i}") for i in range(300)]
    given += [((1 << 62) + ((5 + i) << 20), f"far {i}") for i in range(300)]
    df = docs(spark, given)
    rows = df.selectExpr("coalesce(doc_id, -9223372036854775807L - 1) as k", "text")
    _, sizes = Z._cuts(rows, 32)
    assert list(sizes) == [hot if hot is not None else -(1 << 63)]
    starts = next(iter(Z._hot_starts(rows, sizes, 32).values()))
    assert len(starts) >= 8 and starts == sorted(starts)
    assert {t[:Z.HEAD] for t in texts}.issuperset(starts) and starts[0] == ""
    got = Z.with_successor(df).collect()
    assert sorted(map(tuple, got), key=str) == expected(given)
    held = [sum(1 for _ in p) for p in Z.with_successor(df).select("doc_id").rdd.glom().collect()]
    assert len(held) == 8 and max(held) <= 2 * len(given) / 8


def test_plain_fingerprints_agree(spark):
    df = docs(spark, [(1, "some text"), (2, None), (3, "some text")])
    got = {r.doc_id: r.fingerprint for r in Z.fingerprints(df).collect()}
    assert got == {1: Z.as_text(brute("some text")), 2: "ff" * 256, 3: Z.as_text(brute("some text"))}


def test_likeness_follows_overlap():
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    a = " ".join(word() for _ in range(500))
    near = a[:2500] + " ".join(word() for _ in range(60)) + a[2900:]
    far = " ".join(word() for _ in range(500))
    sim = lambda x, y: Z.likeness(Z.fingerprint(x), Z.fingerprint(y))
    assert sim(a, a) == 1 and sim(a, near) > sim(a, far) + 0.2
    sets = [set(Z.phrases(x, [""])[0]) for x in (a, near)]
    exact = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert abs(sim(a, near) - exact) < 0.2
    assert np.array_equal(Z.fingerprint(None), Z.fingerprint(""))
