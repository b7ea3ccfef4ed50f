"""Chunk recipes against plain grouping of normalised texts."""
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import docs, rows, with_clashes
from tidewatch.llm import exact_dedup as X


def brute(given):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in given]
    out = []
    for (i, _), n in zip(given, norm):
        group = [j for (j, _), m in zip(given, norm) if m == n]
        known = [j for j in group if j is not None]
        out.append((i, min(known) if known else None, len(group),
                    hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def cases():
    rnd = random.Random(5)
    words = ["alder ", "seen", "is ", "of\t", "red\n", "é ", "中文 ", "dole  "]
    long_text = "".join(rnd.choice(words) for _ in range(30_000))
    return [(1, "a b"), (2, "a \t\r\nb"), (3, None), (4, ""), (5, " "), (6, "\x0b"), (None, "a  b"),
            (None, "z"), (None, "z"), (7, long_text), (8, long_text + " "), (9, long_text),
            (10, "x" * 20_000), (11, "x" * 20_000), (12, "a\xa0b"), (13, "a\x1cb"), (14, "A B")]


@pytest.mark.parametrize("mask", [-1, 1, 0])
def test_equals_brute_force_even_when_identifiers_collide(spark, mask):
    given = cases()
    got = X.exact_groups(with_clashes(docs(spark, given)), mask)
    assert rows(got.select("doc_id", "keep_id", "group_size", "text_sha256")) == brute(given)
    kept = got.filter("kept").groupBy("text_sha256").count()
    assert kept.count() == len({r[3] for r in brute(given)})
    assert kept.filter("count > 1").isEmpty()


def test_chunks_join_to_the_text_and_follow_content(spark):
    rnd = random.Random(1)
    body = "".join(rnd.choice(["alder ", "seen of ", "the ", "rode "]) for _ in range(4000))
    df = spark.createDataFrame([(body,), ("prefix " + body,), ("",), (" \n" * 3000,)], "t string")
    got = [r[0] for r in df.select(X.chunks(F.col("t"))).collect()]
    assert ["".join(c) for c in got] == [body, "prefix " + body, "", " \n" * 3000]
    assert all(len(c) <= X.MAX_CHUNK for cs in got for c in cs)
    assert len(set(got[0]) & set(got[1])) > 0.8 * len(got[0])  # cuts find each other again


def test_dropping_keeps_one_whole_row_of_each(spark):
    given = [(3, "a b"), (1, "a  b"), (1, "a  b"), (5, "c"), (None, "c"), (None, "n"), (None, "n"),
             (6, None), (7, "")]
    df = with_clashes(docs(spark, given))
    left = X.drop_exact_copies(df)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(1, "a  b"), (5, "c"), (None, "n"), (6, None)], key=str)


def test_empty_table(spark):
    assert X.exact_groups(docs(spark, [])).count() == 0
    assert X.drop_exact_copies(docs(spark, [])).count() == 0
