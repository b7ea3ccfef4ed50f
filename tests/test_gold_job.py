"""The file-based gold job: a full run, then an incremental run after new
data, equals one full recompute over everything."""
import datetime as dt

from pyspark.sql import functions as F

from tidewatch.functions.time import ntz_micros
from tidewatch.plans import gold as G
from tidewatch.plans import silver as SV
from tidewatch.sources import journal
from tidewatch.sources import testdata as TD
from tidewatch.sources.landing import land_jsonl
from tidewatch.sources.tables import Layout, create_tables, read_anomalies

SF = "/root/testdata/sf0.001"


def _land(ev, layout, label):
    stamp = F.coalesce(F.col("ingested_at"), F.col("_ingested_at"))
    for df, path in ((TD.bronze_trades(ev), layout.bronze_trades),
                     (TD.bronze_snapshots(ev), layout.bronze_snapshots)):
        land_jsonl(df.drop("year", "month", "day", "hour"), path, label, stamp)


def _rows(df):
    return sorted((r["asset_symbol"], r["window_start"], r["trade_count"],
                   str(r["z_score"]), r["is_anomaly"]) for r in df.collect())


def _silver_scans(plan):
    return [x for x in plan.splitlines() if "FileScan parquet" in x and "silver" in x]


def test_incremental_gold_job_equals_full_recompute(spark, tmp_dir):
    """The second landing also holds trades and snapshots far older than the first run."""
    ev = TD.load(spark, SF, "events").where(F.col("ts") < dt.datetime(2024, 1, 12))
    lo, hi = ev.agg(F.min(ntz_micros("ts")), F.max(ntz_micros("ts"))).first()
    late = (ntz_micros("ts") >= F.lit((lo + hi) // 2)) | (F.col("event_id") % 37 == 0)
    layout = Layout(tmp_dir)
    _land(ev.where(~late), layout, "first")
    create_tables(spark, layout)
    SV.run_silver_trades(spark, layout)
    SV.run_silver_snapshots(spark, layout)
    assert G.run_gold(spark, layout, f"{tmp_dir}/staging-1")["days"] > 3

    _land(ev.where(late), layout, "second")
    SV.run_silver_trades(spark, layout)
    SV.run_silver_snapshots(spark, layout)
    before = _rows(read_anomalies(spark, layout))
    G.run_gold(spark, layout, f"{tmp_dir}/staging-2", incremental=True)
    incremental = _rows(read_anomalies(spark, layout))
    full = _rows(G.typed_gold(G.score_windows(
        SV.silver_trades_for_gold(spark, layout),
        SV.silver_snapshots_for_gold(spark, layout), exact_decimal=True)))
    kept = {r[:2] for r in full}
    # as with a table merge, rows whose window is no longer scored stay
    assert incremental == sorted(full + [r for r in before if r[:2] not in kept])
    assert incremental != before


def test_gold_source_reads_from_the_bounds_on(spark, tmp_dir):
    """New rows of one asset: only its range is read, though another has been idle for years."""
    layout = Layout(tmp_dir)
    create_tables(spark, layout)
    t0 = dt.datetime(2026, 4, 30, 8)
    snaps = [("IDLE", dt.datetime(2019, 12, 31), 5.0 + i) for i in range(2)] + [
        ("BTC", t0 + dt.timedelta(minutes=i), 100.0 + i % 3) for i in range(60)]
    spark.createDataFrame(snaps, "asset_symbol string, ingested_at timestamp_ntz, p double").select(
        F.col("asset_symbol").alias("id"), "asset_symbol", "ingested_at",
        F.col("p").cast("decimal(38,8)").alias("current_price"),
        F.to_date("ingested_at").alias("part_day")).write.mode("append").partitionBy(
        "part_day").parquet(layout.silver_snapshots)
    spark.createDataFrame(
        [(a, d, t) for a, d, t in [("IDLE", dt.date(2019, 12, 31), dt.datetime(2019, 12, 31)),
                                   ("BTC", t0.date(), t0 + dt.timedelta(minutes=59))]],
        "asset_symbol string, part_day date, last timestamp_ntz").write.parquet(layout.silver_newest)
    journal.open_note(spark, layout, "silver_trades", spark.createDataFrame(
        [("BTC", t0.replace(hour=9))], "asset_symbol string, low timestamp_ntz"))
    plan = G.gold_source(spark, layout, incremental=True)._jdf.queryExecution().sparkPlan().toString()
    snapshots = [x for x in _silver_scans(plan) if "market_snapshot" in x]
    assert snapshots and all("part_day" in x.split("PartitionFilters")[1] for x in snapshots)
    bounded = [x for x in _silver_scans(plan) if "GreaterThan" in x]
    assert any("trade_time,2026-04-30T08:" in x or "trade_time" in x for x in bounded)
    assert not any("2019" in x for x in bounded)


def test_run_gold_evaluates_its_source_once(spark, tmp_dir):
    """Gold content comes from the staged rows, with the affected days as literals."""
    layout = Layout(tmp_dir)
    create_tables(spark, layout)
    from tidewatch import schemas as S
    from tidewatch.sources.tables import with_day
    source = spark.createDataFrame([], with_day(S.GOLD_ANOMALIES))
    plan = G.gold_content(spark, layout, source, [dt.date(2026, 4, 30)])._jdf.queryExecution() \
        .executedPlan().toString()
    gold = [x for x in plan.splitlines() if "FileScan parquet" in x and "gold" in x]
    assert len(gold) == 1 and "2026-04-30" in gold[0].split("PartitionFilters")[1]
    assert not _silver_scans(plan)


def test_late_trade_is_rescored(spark):
    """A trade dated before the last run changes its old window."""
    t0 = dt.datetime(2026, 7, 1, 10)
    snaps = spark.createDataFrame(
        [("BTC", t0 + dt.timedelta(minutes=m), 100.0 + (m % 2) * 0.5) for m in range(-60, 400, 5)],
        "asset_symbol string, ingested_at timestamp_ntz, current_price double")
    old = [("BTC", t0 + dt.timedelta(minutes=10 * i), 100.0, 1.0) for i in range(40)]
    new = [("BTC", t0 + dt.timedelta(minutes=5), 820.0, 1.0),
           ("BTC", t0 + dt.timedelta(minutes=401), 100.0, 1.0)]
    schema = "asset_symbol string, trade_time timestamp_ntz, price double, quantity double"
    both, fresh = spark.createDataFrame(old + new, schema), spark.createDataFrame(new, schema)
    cuts = G.rescoring_cuts(
        fresh.groupBy("asset_symbol").agg(F.min("trade_time").alias("low")),
        snaps.where("false").groupBy("asset_symbol").agg(F.min("ingested_at").alias("low")))
    got = {r.window_start: r for r in G.score_touched(both, snaps, cuts).collect()}
    assert got[t0].vwap == 460.0 and got[t0].is_anomaly
    assert len(got) == G.score_windows(both, snaps).count()
