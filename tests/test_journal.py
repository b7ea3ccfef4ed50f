"""The change journal, the last-snapshot state and gold as a stream."""
import datetime as dt
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import gold as G
from tidewatch.plans import silver as SV
from tidewatch.sources import journal
from tidewatch.sources.landing import land_jsonl
from tidewatch.sources.tables import Layout, append_day_partitioned, create_tables, read_anomalies

T0 = dt.datetime(2026, 3, 1, 12)
BRONZE = ("trade_id long, symbol string, price string, quantity string, trade_time long, "
          "is_buyer_maker boolean, ingested_at string, _ingested_at string")


class Died(Exception):
    pass


def land(spark, layout, label, minutes, first_id=0, price=100.0):
    at = [T0 + dt.timedelta(minutes=m) for m in minutes]
    rows = [(first_id + i, "BTCUSDT", str(price + i), "1", int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 1000,
             True, t.isoformat() + "+00:00", None) for i, t in enumerate(at)]
    land_jsonl(spark.createDataFrame(rows, BRONZE), layout.bronze_trades, label,
               F.lit("2026-03-02T00:00:00+00:00"))


def snapshots(spark, layout, minutes, asset="BTC", state=True):
    rows = [(asset, T0 + dt.timedelta(minutes=m), 100.0 + (m % 7)) for m in minutes]
    df = spark.createDataFrame(rows, "asset_symbol string, ingested_at timestamp_ntz, p double").select(
        F.col("asset_symbol").alias("id"), "asset_symbol", "ingested_at",
        F.col("ingested_at").alias("last_updated"), F.col("p").cast("decimal(38,8)").alias("current_price"))
    append_day_partitioned(df, layout.silver_snapshots, "ingested_at")
    if state:
        SV.note_newest(layout, df)


def gold(spark, layout, n, incremental=True):
    return G.run_gold(spark, layout, f"{layout.base}/staging-{n}", incremental)


def stale(spark, layout):
    """Windows whose gold row differs from a full recompute."""
    full = G.typed_gold(G.score_windows(SV.silver_trades_for_gold(spark, layout),
                                        SV.silver_snapshots_for_gold(spark, layout), exact_decimal=True))
    have = read_anomalies(spark, layout).select(*full.columns)
    return full.exceptAll(have).count() + have.exceptAll(full).count()


@pytest.fixture(scope="module")
def first_run(spark):
    out = Layout(tempfile.mkdtemp(prefix="tw-test-"))
    create_tables(spark, out)
    snapshots(spark, out, range(-300, 200, 5))
    land(spark, out, "first", range(0, 120, 4))
    SV.run_silver_trades(spark, out)
    gold(spark, out, 0, incremental=False)
    assert stale(spark, out) == 0
    return out.base


@pytest.fixture
def layout(first_run, tmp_dir):
    shutil.copytree(first_run, f"{tmp_dir}/lake")
    return Layout(f"{tmp_dir}/lake")


def test_a_merge_that_dies_after_its_append(spark, layout):
    land(spark, layout, "second", range(1, 120, 11), first_id=500, price=900.0)

    def dies(step):
        if step == "appended":
            raise Died
    with pytest.raises(Died):
        SV.run_silver_trades(spark, layout, step=dies)
    assert stale(spark, layout) > 0
    gold(spark, layout, 1)
    assert stale(spark, layout) == 0
    # the note stays open and is taken up again, until the next merge closes it
    before = journal.consumed(spark, layout)["silver_trades"]
    assert journal.open_notes(spark, layout, "silver_trades") == [before + 1]
    assert SV.run_silver_trades(spark, layout) == 0
    assert journal.open_notes(spark, layout, "silver_trades") == []
    gold(spark, layout, 2)
    assert journal.consumed(spark, layout)["silver_trades"] == before + 1
    assert journal._states(spark, layout) == []  # consumed notes are gone
    assert gold(spark, layout, 3)["days"] == 0


def test_gold_runs_inside_a_merge(spark, layout):
    land(spark, layout, "second", range(2, 120, 9), first_id=500, price=900.0)
    SV.run_silver_trades(spark, layout, step=lambda s: gold(spark, layout, 1) if s == "noted" else None)
    assert stale(spark, layout) > 0
    gold(spark, layout, 2)
    assert stale(spark, layout) == 0


def test_a_late_trade_touches_its_own_window_only(spark, layout):
    land(spark, layout, "second", [13], first_id=500, price=900.0)
    SV.run_silver_trades(spark, layout)
    rows = G.gold_source(spark, layout, incremental=True).collect()
    assert [r.window_start for r in rows] == [T0 + dt.timedelta(minutes=10)]
    gold(spark, layout, 1)
    assert stale(spark, layout) == 0


def test_merges_number_their_notes(spark, layout):
    lows = spark.createDataFrame([("BTC", T0)], "asset_symbol string, low timestamp_ntz")
    first = journal.open_note(spark, layout, "silver_trades", lows)
    second = journal.open_note(spark, layout, "silver_trades", lows)
    assert second == first + 1
    journal.close_notes(spark, layout, "silver_trades", [second])
    assert journal.settled(spark, layout)["silver_trades"] == first - 1  # stops at the open one
    journal.close_notes(spark, layout, "silver_trades", [first])
    assert journal.settled(spark, layout)["silver_trades"] == second
    other = journal.open_note(spark, layout, "silver_snapshots", lows)
    assert other == 1 and journal.settled(spark, layout)["silver_trades"] == second


@pytest.mark.parametrize("state", [True, False])
def test_pick_from_the_last_snapshot_state(spark, tmp_dir, state):
    """The newest snapshot is days older than the window; a snapshot of an open merge may
    be missing in the state."""
    layout = Layout(tmp_dir)
    create_tables(spark, layout)
    snapshots(spark, layout, [-4000, -3990, -3700])
    land(spark, layout, "first", range(0, 60, 4))
    SV.run_silver_trades(spark, layout)
    gold(spark, layout, 0, incremental=False)
    land(spark, layout, "second", range(3, 60, 7), first_id=500, price=300.0)
    SV.run_silver_trades(spark, layout)
    lows = spark.createDataFrame([("BTC", T0 + dt.timedelta(minutes=21))],
                                 "asset_symbol string, low timestamp_ntz")
    journal.open_note(spark, layout, "silver_snapshots", lows)
    snapshots(spark, layout, [21, 22, 35], state=state)
    gold(spark, layout, 1)
    assert stale(spark, layout) == 0 and read_anomalies(spark, layout).count() > 3


def test_a_dead_snapshot_merge_is_made_up_for(spark, tmp_dir):
    """State that a dead merge left out is written by the next one."""
    layout = Layout(tmp_dir)
    create_tables(spark, layout)
    snapshots(spark, layout, [0, 5], state=False)
    journal.open_note(spark, layout, "silver_snapshots", spark.createDataFrame(
        [("BTC", T0)], "asset_symbol string, low timestamp_ntz"))
    empty = spark.createDataFrame([], "id string, last_updated timestamp_ntz, asset_symbol string, "
                                      "ingested_at timestamp_ntz, part_day date")
    SV._merge(spark, layout, "silver_snapshots", empty.drop("part_day"), ["id", "last_updated"],
              SV.snapshot_changes)
    assert [tuple(r) for r in SV.read_newest(spark, layout).collect()] == [
        ("BTC", T0 + dt.timedelta(minutes=5))]
    assert journal.open_notes(spark, layout, "silver_snapshots") == []


def test_rejects_of_the_merge_are_set_aside(spark, tmp_dir):
    layout = Layout(tmp_dir)
    create_tables(spark, layout)
    rows = [(1, "BTCUSDT", "100.5", "1", 1_772_366_400_000, True, "2026-03-01T12:00:00+00:00", None),
            (2, "BTCUSDT", "oops", "1", 1_772_366_400_000, True, "2026-03-01T12:00:00+00:00", None),
            (None, "BTCUSDT", "1", "1", 1_772_366_400_000, True, "2026-03-01T12:00:00+00:00", None),
            (4, "BTCUSDT", "1", "2", 1_772_366_400_000, True, None, "not a time")]
    land_jsonl(spark.createDataFrame(rows, BRONZE), layout.bronze_trades, "a",
               F.lit("2026-03-02T00:00:00+00:00"))
    for inserted in (1, 0):  # a rerun adds neither trades nor rejects
        assert SV.run_silver_trades(spark, layout, rejects=True) == inserted
        got = SV.read_trade_rejects(spark, layout)
        assert sorted((r.reason, r.trade_id or 0) for r in got.collect()) == [
            ("ingested_at", 4), ("price", 2), ("trade_id", 0)]
        assert {(r.year, r.hour) for r in got.collect()} == {("2026", "00")}
