"""Physical-plan properties of the registered queries: bounded window
partitions, no cartesian products, pruned scans, key-only merge reads."""
import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewatch import queries as Q
from tidewatch.plans import silver
from tidewatch.sources import testdata as TD
from tidewatch.sources.landing import land_jsonl
from tidewatch.sources.tables import Layout, create_tables

SF = "/root/testdata/sf0.001"
WRITERS = {"gold_incremental_journal", "gold_incremental_moments", "baseline_stored_moments", "bronze_compaction", "stream_batch_counters", "gold_stream", "vwap_partials_merged",
           "stream_dedup_ttl",
           "rejects_replay", "stream_first_wins_ordered", "stream_record_bounded", "stream_retry_atomic", "hour_partition_filter",
           "silver_trades_backfill", "silver_snapshots_backfill", "gold_upsert_job",
           "snapshot_ingest_batch"}
PURE = sorted(set(Q.QUERIES) - WRITERS)


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def _window_keys(plan: str) -> list[str]:
    specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)
    return [re.sub(r"#\d+L?", "", s) for s in specs]


@pytest.mark.parametrize("name", PURE)
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", PURE)
def test_window_partitions_are_bounded(spark, name):
    """Every window over rows is partitioned by key *and* a time bucket; the
    one key-only window is the as-of carry-in over (key, day) cells."""
    for spec in _window_keys(_plan(E.queries()[name](spark, SF))):
        cols = [c.strip() for c in spec.split(",") if c.strip()]
        assert len(cols) >= 2 or cols == ["_by"], (name, spec)


def test_scans_read_only_needed_columns(spark):
    plan = E.queries()["gold_anomalies"](spark, SF)._jdf.queryExecution() \
        .executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("user_id" not in s for s in schemas)


def _landed(spark, tmp_dir):
    layout = Layout(tmp_dir)
    ev = TD.load(spark, SF, "events").where(F.col("event_id") < 40)
    for df, path in ((TD.bronze_trades(ev), layout.bronze_trades),
                     (TD.bronze_snapshots(ev), layout.bronze_snapshots)):
        land_jsonl(df.drop("year", "month", "day", "hour"), path, "b",
                   F.coalesce("ingested_at", "_ingested_at"))
    create_tables(spark, layout)
    return layout


def _scans(df, kind: str) -> list[str]:
    conf = df.sparkSession.conf
    conf.set("spark.sql.maxMetadataStringLength", "4000")  # whole paths
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.unset("spark.sql.maxMetadataStringLength")
    return re.findall(rf"FileScan {kind}[^\n]*", plan)


@pytest.mark.parametrize("make", [silver.trade_source, silver.snapshot_source])
def test_silver_source_scans_bronze_once(spark, tmp_dir, make):
    assert len(_scans(make(spark, _landed(spark, tmp_dir)), "json")) == 1


@pytest.mark.parametrize("table,make,keys", [
    ("silver_trades", silver.trade_source, silver.TRADE_KEYS),
    ("silver_snapshots", silver.snapshot_source, silver.SNAPSHOT_KEYS)])
def test_merge_scans_target_keys_once_within_the_source_range(spark, tmp_dir, table, make, keys):
    layout = _landed(spark, tmp_dir)
    source = make(spark, layout)
    source.write.parquet(f"{tmp_dir}/staged")
    staged = spark.read.schema(source.schema).parquet(f"{tmp_dir}/staged")
    delta = silver.silver_delta(spark, layout, table, staged, keys)
    target = [x for x in _scans(delta, "parquet") if "/silver/" in x]
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert len(target) == 1 and all(f"{op}({keys[-1]}," in target[0]
                                    for op in ("GreaterThanOrEqual", "LessThanOrEqual"))
    fields = re.search(r"ReadSchema: struct<([^>]*)>", target[0])[1].split(",")
    assert sorted(f.split(":")[0] for f in fields) == sorted(keys)
    assert "LeftSemi" in plan and "LeftAnti" in plan and not _scans(delta, "json")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_general_asof_is_split_below_the_day(spark):
    """Raw rows by (key, ten-minute slot), a day's cells by (key, day), days by key."""
    specs = {re.sub(r"\s", "", s) for s in _window_keys(_plan(E.queries()["asof_baseline"](spark, SF)))}
    assert {"_by,_s", "_by,_b", "_by"} <= specs
