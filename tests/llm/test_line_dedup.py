import random

import pytest

from helpers import docs, rows, with_clashes
from tidewatch.llm import line_dedup as L


def brute(given, size=3):
    """First occurrences by (doc_id, position); rows with equal id and text are one place."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    first, lines = {}, {}
    for r in sorted(set(given), key=key):
        ls = lines[r] = (r[1] or "").split("\n")
        cmp_ = [x.strip(" \t\n\x0b\x0c\r") for x in ls]
        for p in range(len(ls) - size + 1):
            w = tuple(cmp_[p:p + size])
            if any(w):
                first.setdefault(w, (r, p))
    out = []
    for r in given:
        ls = lines[r]
        cmp_ = [x.strip(" \t\n\x0b\x0c\r") for x in ls]
        gone = set()
        for p in range(len(ls) - size + 1):
            w = tuple(cmp_[p:p + size])
            if any(w) and first[w] != (r, p):
                gone |= set(range(p, p + size))
        out.append((r[0], len(ls), len(gone),
                    "\n".join(x for i, x in enumerate(ls) if i not in gone)))
    return sorted(out, key=str)


def check(spark, given):
    got = L.dedup_lines(with_clashes(docs(spark, given)))
    assert rows(got.select("doc_id", "n_lines", "n_removed", "text")) == brute(given)
    for r in got.collect():
        assert sum(s.after - s.first for s in r.spans) == r.n_removed
        assert all(a.after < b.first for a, b in zip(r.spans, r.spans[1:]))


@pytest.mark.parametrize("seed", range(3))
def test_random_documents(spark, seed):
    rnd = random.Random(seed)
    given = [(i, "\n".join(rnd.choice("abc") + rnd.choice(["", " ", "\r"])
                           for _ in range(rnd.randint(0, 12)))) for i in range(40)]
    check(spark, given)


def test_edge_cases(spark):
    shared = "one line\nsecond line\nthird line"
    check(spark, [(5, shared), (2, "x\n" + shared + "\ny"), (9, None), (10, ""), (11, "\n\n\n\n"),
                  (12, "\n\n\n\n"), (3, shared), (3, shared), (None, shared + "\nz"),
                  (20, "a\na\na\na\na\na"), (21, "two\nlines"), (22, "two\nlines"),
                  (30, "\n".join(f"l{i}" for i in range(20_000))),
                  (31, "\n".join(f"l{i}" for i in range(20_000)))])


def test_empty_table(spark):
    assert L.dedup_lines(docs(spark, [])).count() == 0
