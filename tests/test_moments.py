"""Stored slot moments: merging, trust, and what a run reads."""
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from test_journal import Died, T0, gold, land, snapshots, stale
from tidewatch.operators.baseline import SLOT, baseline_at_grid, slot_moments
from tidewatch.plans import gold as G
from tidewatch.plans import silver as SV
from tidewatch.sources import journal, moments
from tidewatch.sources.tables import Layout, create_tables, read_table

SNAPS = "asset_symbol string, ingested_at timestamp_ntz, current_price double"


def parts(frames):
    """Frames as (sequence number, whole, rows)."""
    out = None
    for seq, whole, df in frames:
        one = slot_moments(df).withColumn("seq", F.lit(seq).cast("long")).withColumn("whole", F.lit(whole))
        out = one if out is None else out.unionByName(one)
    return out


def as_rows(df):
    return sorted((r.asset_symbol, r.slot_end, r.newest, r.n, pytest.approx(r.mean, rel=1e-12),
                   pytest.approx(r.m2, rel=1e-9, abs=1e-9)) for r in df.collect())


def plain(df):
    return sorted((r.asset_symbol, r.slot_end, r.newest, r.n, r.mean, r.m2) for r in df.collect())


def rows_of(spark, seed, n=300, base=1e6):
    rnd = random.Random(seed)
    return spark.createDataFrame(
        [(rnd.choice("ab"), T0 + dt.timedelta(seconds=rnd.randrange(3600)),
          None if rnd.random() < 0.1 else base + rnd.random()) for _ in range(n)], SNAPS)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_parts_pool_to_the_whole(spark, order):
    dfs = [rows_of(spark, i) for i in range(3)]
    everything = dfs[0].unionByName(dfs[1]).unionByName(dfs[2])
    got = moments.merge_moments(parts([(s, False, dfs[i]) for s, i in enumerate(order)]))
    assert plain(slot_moments(everything)) == as_rows(got)


def test_a_whole_row_replaces_older_parts_of_its_group_only(spark):
    old, new, later = (rows_of(spark, i) for i in (5, 6, 7))
    a = F.col("asset_symbol") == "a"
    got = moments.merge_moments(parts([(1, False, old), (2, False, old), (2, True, new.where(a)),
                                       (3, False, later)]))
    want = (new.where(a).unionByName(old.where(~a)).unionByName(old.where(~a)).unionByName(later))
    assert plain(slot_moments(want)) == as_rows(got)
    assert moments.merge_moments(parts([(1, False, old.where("false"))])).count() == 0


def test_null_prices_and_null_keys(spark):
    df = spark.createDataFrame([("a", T0, None), (None, T0, 1.0), ("a", None, 2.0)], SNAPS)
    (row,) = moments.merge_moments(parts([(1, False, df), (2, False, df)])).collect()
    assert (row.asset_symbol, row.n, row.mean, row.m2) == ("a", 0, 0.0, 0.0)
    (b,) = baseline_at_grid(df, moments=slot_moments(df)).collect()
    assert b.baseline_mean is None and b.baseline_stddev is None


@pytest.fixture
def lake(spark, tmp_dir):
    layout = Layout(tmp_dir)
    create_tables(spark, layout)
    snapshots(spark, layout, range(-900, 200, 5))
    land(spark, layout, "first", range(0, 120, 4))
    SV.run_silver_trades(spark, layout)
    moments.start(spark, layout)
    gold(spark, layout, 0, incremental=False)
    return layout


def run(spark, layout, n):
    return G.run_gold(spark, layout, f"{layout.base}/staging-{n}", True, moments=True)


def true_state(spark, layout):
    return plain(slot_moments(read_table(spark, layout, "silver_snapshots")))


def test_a_late_trade_reads_the_low_edge_only(spark, lake):
    land(spark, lake, "late", [13], first_id=500, price=900.0)
    SV.run_silver_trades(spark, lake)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = G.gold_source(spark, lake, incremental=True, moments=True)._jdf.queryExecution() \
            .sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # the window ends at 12:20; its frame's low edge is the group that ends at 06:20
    scans = [x for x in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan) if "ingested_at" in x]
    assert scans and all("GreaterThan(ingested_at,2026-03-01T06:10)" in x
                         and "LessThanOrEqual(ingested_at,2026-03-01T06:20)" in x for x in scans)
    assert run(spark, lake, 1)["days"] == 1
    assert stale(spark, lake) == 0


def bronze_like(spark, minutes, price=500.0):
    rows = [("BTC", T0 + dt.timedelta(minutes=m, seconds=30), price + m % 5) for m in minutes]
    return spark.createDataFrame(rows, "asset_symbol string, ingested_at timestamp_ntz, p double").select(
        F.col("asset_symbol").alias("id"), F.col("ingested_at").alias("last_updated"), "asset_symbol",
        "ingested_at", F.col("p").cast("decimal(38,8)").alias("current_price"))


def merge(spark, layout, df, step=None):
    return SV._merge(spark, layout, "silver_snapshots", df, SV.SNAPSHOT_KEYS, SV.snapshot_changes, step)


def test_merges_keep_the_state(spark, lake):
    late = bronze_like(spark, range(-500, 100, 45))
    assert merge(spark, lake, late) == late.count()
    assert merge(spark, lake, late) == 0  # a rerun adds nothing
    assert as_rows(moments.read(spark, lake)) == true_state(spark, lake)
    run(spark, lake, 1)
    assert stale(spark, lake) == 0
    moments.store(spark, lake).fold(2 * journal.last_number(spark, lake, "silver_snapshots") + 1)
    assert as_rows(moments.read(spark, lake)) == true_state(spark, lake)


@pytest.mark.parametrize("at", ["noted", "appended"])
def test_a_dead_merge_is_not_trusted_and_then_renewed(spark, lake, at):
    def dies(step):
        if step == at:
            raise Died
    with pytest.raises(Died):
        merge(spark, lake, bronze_like(spark, range(-200, 100, 30)), dies)
    assert as_rows(moments.read(spark, lake)) == true_state(spark, lake)
    run(spark, lake, 1)
    assert stale(spark, lake) == 0
    merge(spark, lake, bronze_like(spark, range(-200, 100, 25), 700.0))
    assert journal.open_notes(spark, lake, "silver_snapshots") == []
    assert as_rows(moments.store(spark, lake).rows()) == true_state(spark, lake)
    run(spark, lake, 2)
    assert stale(spark, lake) == 0


def test_moments_must_exist_and_fit(spark, tmp_dir):
    layout = Layout(tmp_dir)
    create_tables(spark, layout)
    with pytest.raises(ValueError):
        G.gold_source(spark, layout, incremental=True, moments=True)
    moments.start(spark, layout)  # of an empty table
    assert moments.exists(spark, layout) and moments.read(spark, layout).count() == 0
    with pytest.raises(ValueError):
        G.gold_source(spark, layout, incremental=True, moments=True, window_minutes=20)
    assert SLOT == 600_000_000
