"""SimHash groups against all pairs."""
import random
import re

import pytest
from xxhash import xxh64_intdigest

from helpers import docs, rows, with_clashes
from tidewatch.llm import simhash as S

MASK = (1 << 64) - 1


def brute_fingerprint(text, words=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    parts = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    fs = sorted(parent)
    for i, f in enumerate(fs):
        for g in fs[:i]:
            if ((f ^ g) & MASK).bit_count() <= radius:
                parent[find(f)] = find(g)
    return {f: find(f) for f in fs}


@pytest.mark.parametrize("text", ["", None, " \n", "A", "a b C", "a b c d", "É é A a\x0bB\x1cc d e",
                                  "q w e r t y " * 2000])
def test_fingerprint(text):
    assert S.fingerprint(text) & MASK == brute_fingerprint(text)


def clustered(n, seed=3):
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(4)]
    out = {0}
    while len(out) < n:
        x = rnd.choice(centres)
        for _ in range(rnd.randint(0, 5)):
            x ^= 1 << rnd.randrange(64)
        out.add(x - (1 << 64) if x >> 63 else x)
    return sorted(out)


@pytest.mark.parametrize("tree_nodes", [2000, 3])
@pytest.mark.parametrize("blocks", [5, 6])
def test_links_connect_what_all_pairs_connect(spark, blocks, tree_nodes):
    fps = clustered(150)
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = S.links(nodes, radius=4, blocks=blocks, tree_nodes=tree_nodes).collect()
    expected, parent = components(fps, 4), {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in got:
        assert expected[a] == expected[b]
        parent[find(a)] = find(b)
    assert len({find(f) for f in fps}) == len(set(expected.values()))
    assert len(got) < 30 * len(fps)  # links, not all pairs


def _agreeing(n, seed=9):
    """Distinct fingerprints that agree on the 21 lowest bits (two of six blocks)."""
    rnd = random.Random(seed)
    out = {rnd.getrandbits(43) << 21 | 12345 for _ in range(n)}
    return [f - (1 << 64) if f >> 63 else f for f in out]


def test_rows_of_a_hot_shard_are_linear(spark):
    rows_of = [S.dealt(spark.createDataFrame([(f,) for f in _agreeing(n)], "fp long"), 4, 6, 200).count()
               for n in (10_000, 50_000)]
    # fourteen choices once each and the hot one by five groups of bits
    assert rows_of[0] <= 19 * 10_000 and rows_of[1] <= 19 * 50_000


def test_links_within_a_hot_shard(spark):
    rnd = random.Random(1)
    far = _agreeing(1200)
    near = []
    for f in far[:300]:
        for _ in range(rnd.randint(1, 4)):
            f ^= 1 << rnd.randrange(21, 63)
        near.append(f)
    fps = sorted(set(far + near))
    got = S.links(spark.createDataFrame([(f,) for f in fps], "fp long"), tree_nodes=50).collect()
    expected, parent = components(fps, 4), {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in got:
        assert expected[a] == expected[b]
        parent[find(a)] = find(b)
    assert len({find(f) for f in fps}) == len(set(expected.values())) < len(fps)


def test_groups_and_edge_cases(spark):
    base = " ".join(f"w{i}" for i in range(300))
    given = [(9, base), (4, base + " tail"), (12, base.upper()), (None, base), (1, None), (2, ""),
             (3, " \t"), (None, "lonely words here"), (20, "other words"), (20, "other words"),
             (21, "w " * 30_000)]
    df = with_clashes(docs(spark, given))
    got = rows(S.near_duplicates(df).select("doc_id", "component_id", "fp"))
    fps = [S.fingerprint(t) for _, t in given]
    where = components(fps, 4)
    expected = []
    for (i, _), f in zip(given, fps):
        ids = [j for (j, _), g in zip(given, fps) if where[g] == where[f] and j is not None]
        expected.append((i, min(ids) if ids else None, f))
    assert got == sorted(expected, key=str)
    left = S.keep_one_of_each(df)
    assert left.columns == df.columns
    # a null id stays only in a group without ids; repeated rows are one document
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted(
        [i for i, low, _ in expected if i == low], key=str)


def test_empty_table(spark):
    assert S.near_duplicates(docs(spark, [])).count() == 0
    assert S.keep_one_of_each(docs(spark, [])).count() == 0
