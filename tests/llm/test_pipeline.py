"""The stages against their operators' plain meaning, and every registered query against SQL."""
import re

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from compare import compare, duck
from helpers import docs, with_clashes
from tidewatch.llm import exact_dedup, mixing, queries as Q, simhash, url_filter

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(Q.QUERIES[name](spark, SF), duck(SF), Q.ORACLES[name]) == []


def test_everything_is_registered():
    names = E.queries()
    assert all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11))
    assert names["pipeline"] is P.run and set(Q.ORACLES) <= set(E.oracle_sql())


def test_stages(spark, tmp_dir):
    docs_in = spark.read.parquet(f"{SF}/documents.parquet")
    kept, seen = docs_in, []
    for name, stage in P.STAGES:
        out = stage(spark, kept, SF)
        out.write.parquet(f"{tmp_dir}/{name}")
        after = spark.read.parquet(f"{tmp_dir}/{name}")
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        before = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
        assert ids <= set(before) and after.count() == len(ids)
        if name != "bpe":
            assert after.columns == docs_in.columns
        norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", before[i] or "") for i in before}
        if name == "exact_dedup":
            low = {}
            for i, t in norm.items():
                low[t] = min(low.get(t, i), i)
            assert ids == set(low.values())
        if name == "simhash":
            fps = {i: simhash.fingerprint(t) for i, t in before.items()}
            close = [(i, j) for i in ids for j in ids if i < j
                     and ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 4]
            assert not close  # nobody left is linked to another
        if name == "bpe":
            assert ids == set(before)
        seen.append((name, len(before), len(ids)))
        kept = after
    assert seen[1][1] > seen[1][2]  # copies went
    assert P.run(spark, SF).count() == seen[-1][2]


def test_stages_accept_an_empty_table(spark):
    empty = docs(spark, [])
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_stages_accept_odd_rows(spark):
    """Nulls everywhere, repeated rows, a very long text, extra columns with the operators' names."""
    odd = with_clashes(docs(spark, [
        (1, None, None, None), (None, None, None, None), (None, "words of no one", "en", None),
        (2, "", "en", "s"), (3, "a b c " * 40_000), (4, "same text here"), (4, "same text here"),
        (5, "same  text here"), (6, "x"), (7, "\n \t"), (8, "copyright é 中文 🙂")]))
    kept = odd
    for name, stage in P.STAGES:
        out = stage(spark, kept, SF)
        if name != "bpe":
            assert out.columns == odd.columns
        kept = spark.createDataFrame(out.collect(), out.schema)
    texts = [r.doc_id for r in kept.collect()]
    assert len(texts) == len(set(texts))


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_query_pairs_everything(spark, name):
    plan = _plan(Q.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("make", [
    lambda s, d: exact_dedup.exact_groups(d), lambda s, d: exact_dedup.chunk_store(d),
    lambda s, d: exact_dedup.drop_exact_copies(d), lambda s, d: mixing.mix(d),
    lambda s, d: mixing.sampled(d),
    lambda s, d: url_filter.judge(s.read.parquet(f"{SF}/pages.parquet"))])
def test_native_operators_plan_no_python(spark, make):
    plan = _plan(make(spark, spark.read.parquet(f"{SF}/documents.parquet")))
    assert not re.search("Python|Pandas|InArrow", plan)
