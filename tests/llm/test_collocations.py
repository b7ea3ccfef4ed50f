import random
import re
from collections import Counter, defaultdict

import pytest

from helpers import docs, with_clashes
from tidewatch.llm import collocations as C


def brute(given, least, top=2000, covered=80):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in given:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        many = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in many.items():
            if any(100 * b >= covered * a and len(q) > len(p) and any(
                    q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                    for q, b in many.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]],
                                  count[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus(seed=5, n=80):
    rnd = random.Random(seed)
    words = ["a", "b", "c", "new york", "x y z", "ä", "Q", "q", "É\xa0é", "\x1c", "far\x85off"]
    glue = [" ", "\t", "  ", ". ", ",", "\n", " \x0b", "\x0c", "\r\n", " ! "]
    out = [(i, "".join(rnd.choice(words) + rnd.choices(glue, [20, 3, 3, 2, 2, 1, 1, 1, 1, 1])[0]
                       for _ in range(rnd.randint(0, 40))), rnd.choice(["en", "de", None, "und", ""]))
           for i in range(n)]
    return out + [(901, None, "en"), (902, "", "en"), (None, "a b c", "de"), (7, "a b c d", "de"),
                  (7, "a b c d", "de"), (903, "a a b " * 700, "de"), (904, ". , !", "fr")]


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n",
                                              "score").collect())


@pytest.mark.parametrize("block_size, least", [(1_000_000, 3), (7, 3), (100, 30)])
def test_equals_brute_force(spark, block_size, least):
    given = corpus()
    df = with_clashes(docs(spark, [(i, t, g) for i, t, g in given]))
    assert got(C.collocations(df, least=least, block_size=block_size)) == brute(given, least)


def test_ties_and_the_last_rank(spark):
    given = [(i, "b c. a b; é f, z y", "en") for i in range(5)]
    out = got(C.collocations(docs(spark, given), least=2, top=3))
    assert out == brute(given, 2, top=3) and [r[2] for r in out] == ["z y", "é f", "a b"]


def test_a_phrase_inside_a_dropped_one_goes_too(spark):
    given = [(i, "p q r s", "en") for i in range(10)] + [(20, "p q r", "en"), (21, "p q", "en")]
    assert [r[2] for r in got(C.collocations(docs(spark, given), least=2))] == ["p q r s"]


def test_nothing_frequent_and_no_rows(spark):
    assert C.collocations(docs(spark, [])).count() == 0
    assert C.collocations(docs(spark, [(1, "a b c", "en")])).count() == 0


def test_scores_past_64_bits(spark):
    big = 4_000_000_000_000_000
    row = spark.createDataFrame([(big, [big, big], [big + 7, big])],
                                "a long, heads array<long>, tails array<long>")
    s = row.select(C._lowest_cut(2).alias("c")).first().c
    assert s.score == 2_000_000 * big // (big + big + 7)
