import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import merge as M
from tidewatch.operators.dedupe import dedupe_first
from tidewatch.operators.merge import merge_insert_only, merge_upsert, rows_to_insert
from tidewatch.sources.tables import append_day_partitioned

SCHEMA = "k long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: (t[0] is None, t))


def test_insert_only_adds_missing_keys_and_keeps_existing(spark):
    tgt = spark.createDataFrame([(1, "old"), (2, "old")], SCHEMA)
    src = spark.createDataFrame([(2, "new"), (3, "new")], SCHEMA)
    assert rows(merge_insert_only(tgt, src, ["k"])) == [(1, "old"), (2, "old"), (3, "new")]


def test_insert_only_rerun_adds_nothing(spark):
    tgt = spark.createDataFrame([(1, "a")], SCHEMA)
    src = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    once = merge_insert_only(tgt, src, ["k"])
    twice = merge_insert_only(once, src, ["k"])
    assert rows(once) == rows(twice)
    assert rows_to_insert(once, src, ["k"]).count() == 0


def test_null_key_never_matches(spark):
    tgt = spark.createDataFrame([(None, "x")], SCHEMA)
    src = spark.createDataFrame([(None, "x")], SCHEMA)
    once = merge_insert_only(tgt, src, ["k"])
    assert once.count() == 2
    assert merge_insert_only(once, src, ["k"]).count() == 3


def test_composite_key(spark):
    s = "id string, t long, v double"
    tgt = spark.createDataFrame([("btc", 1, 1.0), ("btc", 2, 2.0)], s)
    src = spark.createDataFrame([("btc", 2, 9.0), ("eth", 2, 3.0)], s)
    got = rows(merge_insert_only(tgt, src, ["id", "t"]))
    assert got == [("btc", 1, 1.0), ("btc", 2, 2.0), ("eth", 2, 3.0)]


def test_upsert_overwrites_inserts_and_keeps(spark):
    tgt = spark.createDataFrame([(1, "old"), (2, "old")], SCHEMA)
    src = spark.createDataFrame([(2, "new"), (3, "new")], SCHEMA)
    assert rows(merge_upsert(tgt, src, ["k"])) == [(1, "old"), (2, "new"), (3, "new")]


def test_upsert_twice_equals_once(spark):
    tgt = spark.createDataFrame([(1, "old")], SCHEMA)
    src = spark.createDataFrame([(1, "new"), (4, "new")], SCHEMA)
    once = merge_upsert(tgt, src, ["k"])
    assert rows(merge_upsert(once, src, ["k"])) == rows(once)


def test_dedupe_first_wins_and_null_keys_pass(spark):
    df = spark.createDataFrame(
        [(42, "first", 1), (42, "second", 2), (42, "third", 3), (None, "n1", 1),
         (None, "n2", 2), (7, "only", 5)], "k long, v string, seq int")
    got = rows(dedupe_first(df, ["k"], ["seq"]))
    assert got == [(7, "only", 5), (42, "first", 1), (None, "n1", 1), (None, "n2", 2)]


def test_dedupe_hot_key_is_map_side_combined(spark):
    df = spark.range(0, 20000).select((F.col("id") % 3 == 0).cast("long").alias("k"),
                                      F.col("id").alias("seq"))
    out = dedupe_first(df, ["k"], ["seq"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(" in plan
    assert rows(out) == [(0, 1), (1, 0)]


@pytest.mark.parametrize("seed", range(3))
def test_key_ranges_hold_every_key(spark, seed):
    rnd = random.Random(seed)
    keys = [rnd.choice([5, 10 ** 15, -(10 ** 12)]) + rnd.randrange(10 ** rnd.randrange(1, 6))
            for _ in range(200)]
    got = M.key_ranges(spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long"), "k", 6)
    assert 1 <= len(got) <= 6 and got == sorted(got)
    assert all(any(a <= k <= b for a, b in got) for k in keys)
    assert all(a in keys and b in keys for a, b in got)
    assert sum(b - a for a, b in got) < 10 ** 7  # parted at the wide gaps
    assert M.key_ranges(spark.createDataFrame([(None,)], "k long"), "k") == []


def scanned(df):
    """Rows that the scan hands on after files, row groups and pages are skipped."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_one_old_id_leaves_most_rows_unread(spark, tmp_dir):
    schema, at = "trade_id long, ingested_at timestamp_ntz", dt.datetime(2026, 3, 1)
    ids = spark.range(40_000).select(  # even ids, a thousand a day
        (F.col("id") * 2).alias("trade_id"),
        F.expr(f"timestamp_ntz'{at}' + make_dt_interval(cast(id div 1000 as int))").alias("ingested_at"))
    append_day_partitioned(ids.repartition(1), tmp_dir, "ingested_at", "trade_id")
    target = spark.read.schema(schema + ", part_day date").parquet(tmp_dir)
    new = list(range(79_900, 80_100))
    source = spark.createDataFrame([(i, at) for i in [7, 5000, *new]], schema)
    bounded = M.within_key_range(target, source, "trade_id")
    assert scanned(bounded) <= 3000  # a file for each range, of 40; between 7 and the newest lie all
    assert scanned(target.where("trade_id between 7 and 80099")) > 39_000
    got = rows_to_insert(bounded, source, ["trade_id"]).collect()
    assert sorted(r.trade_id for r in got) == [7, *[i for i in new if i % 2 or i >= 80_000]]
    # an odd id inside the range of a file: its statistics cannot tell, its filters do
    assert scanned(target.where("trade_id = 8001")) == 0
    assert scanned(target.where("trade_id = 8002")) > 0
    lone = spark.createDataFrame([(8001, at), (5, at)], schema)
    assert scanned(M.within_key_range(target, lone, "trade_id")) == 0


def test_key_ranges_of_times(spark):
    at = dt.datetime(2026, 3, 1)
    days = [0, 1, 2, 300]
    df = spark.createDataFrame([(at + dt.timedelta(days=d),) for d in days], "k timestamp_ntz")
    assert [h - l for l, h in M.key_ranges(df, "k", 2)] == [2 * 86_400_000_000, 0]
    target = spark.createDataFrame([(at + dt.timedelta(days=d),) for d in (1, 100, 300)], "k timestamp_ntz")
    got = M.within_key_range(target, df, "k").collect()
    assert [(r.k - at).days for r in got] in ([1, 300], [1, 100, 300]) and len(got) == 2
    text = spark.createDataFrame([("b",), ("d",)], "k string")
    other = spark.createDataFrame([("a",), ("c",), ("e",)], "k string")
    assert [r.k for r in M.within_key_range(other, text, "k").collect()] == ["c"]
