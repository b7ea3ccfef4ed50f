import datetime as dt
import glob
import json
import os

import pytest

from tidewatch.plans import runner as R
from tidewatch.sources.bronze import read_bronze_trades, where_hours
from tidewatch.sources.landing import land_jsonl, land_snapshots

UTC = dt.timezone.utc
NOW = dt.datetime(2026, 6, 10, 14, 30, tzinfo=UTC)


def _trades(spark, ids, stamp="2026-06-10T14:30:00+00:00"):
    return spark.createDataFrame(
        [(i, "BTCUSDT", "41250.30000007", "0.00000003", 1707994496789, False, stamp, None)
         for i in ids],
        "trade_id long, symbol string, price string, quantity string, trade_time long, "
        "is_buyer_maker boolean, ingested_at string, _ingested_at string")


def test_one_file_per_batch_hive_layout_and_precision(spark, tmp_dir):
    land_jsonl(_trades(spark, [1, 2, 3]), tmp_dir, "20260610T143000Z_req-abc")
    files = glob.glob(f"{tmp_dir}/year=2026/month=06/day=10/hour=14/"
                      f"batch=20260610T143000Z_req-abc/*.json")
    assert len(files) == 1
    lines = open(files[0], encoding="utf-8").read().splitlines()
    assert len(lines) == 3
    first = json.loads(lines[0])
    assert first["price"] == "41250.30000007" and first["quantity"] == "0.00000003"


def test_replayed_batch_overwrites_only_itself(spark, tmp_dir):
    land_jsonl(_trades(spark, [1]), tmp_dir, "b1")
    land_jsonl(_trades(spark, [2]), tmp_dir, "b2")
    land_jsonl(_trades(spark, [2]), tmp_dir, "b2")
    got = sorted(r[0] for r in read_bronze_trades(spark, tmp_dir).select("trade_id").collect())
    assert got == [1, 2]


def test_string_partitions_and_pruning(spark, tmp_dir):
    land_jsonl(_trades(spark, [1], "2026-07-16T14:10:00+00:00"), tmp_dir, "a")
    land_jsonl(_trades(spark, [2], "2026-07-16T07:10:00+00:00"), tmp_dir, "b")
    df = read_bronze_trades(spark, tmp_dir)
    assert dict(df.dtypes)["month"] == "string"
    hours = [{"year": "2026", "month": "07", "day": "16", "hour": "07"}]
    pruned = where_hours(df, hours)
    assert [r["trade_id"] for r in pruned.collect()] == [2]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "hour" in plan


def test_snapshot_landing_stamps_and_counts(spark, tmp_dir):
    df = spark.createDataFrame([("bitcoin", 65000.0), ("ethereum", 3500.0)],
                               "id string, current_price double")
    res = land_snapshots(df, tmp_dir, NOW)
    assert res["statusCode"] == 200 and res["records"] == 2
    assert res["batch"] == "20260610T143000Z"
    files = glob.glob(f"{tmp_dir}/year=2026/month=06/day=10/hour=14/batch=*/*.json")
    rec = json.loads(open(files[0]).readline())
    assert rec["ingested_at"] == "2026-06-10T14:30:00+00:00"


def test_snapshot_landing_empty_writes_nothing(spark, tmp_dir):
    df = spark.createDataFrame([], "id string, current_price double")
    assert land_snapshots(df, tmp_dir, NOW) == {"statusCode": 204, "records": 0}
    assert os.listdir(tmp_dir) == []


CLOCK = dt.datetime(2025, 11, 3, 9, 41, tzinfo=UTC)


def test_a_failed_hour_does_not_stop_the_others():
    tried = []

    def merge(hours):
        tried.append(hours)
        if len(tried) == 2:
            raise OSError("disk gone")

    with pytest.raises(R.HoursFailed) as told:
        R.incremental(merge, CLOCK, lookback_hours=3)
    report = told.value.report
    assert [h[0]["hour"] for h in tried] == ["09", "08", "07", "06"]
    assert [h["hour"] for h in report.merged] == ["09", "07", "06"] and not report.complete
    assert list(report.causes) == ["year=2025/month=11/day=03/hour=08"]
    assert isinstance(told.value.__cause__, OSError) and "disk gone" in str(told.value)


@pytest.mark.parametrize("payload", [None, {}, {"backfill": False}, {"other": 1}])
def test_payload_without_backfill_is_incremental(payload):
    calls = []
    report = R.run(payload, calls.append, CLOCK)
    assert report.mode == "incremental" and report.complete
    assert [c[0]["hour"] for c in calls] == ["09", "08"]


def test_backfill_is_one_merge_whose_error_comes_through():
    calls = []
    assert R.run({"backfill": True}, calls.append) == R.RunReport("backfill")
    assert calls == [None]
    with pytest.raises(ZeroDivisionError):
        R.run({"backfill": True}, lambda hours: 1 / 0)


def test_an_empty_hour_list_reads_nothing(spark, tmp_dir):
    land_jsonl(_trades(spark, [1, 2]), tmp_dir, "b1")
    df = read_bronze_trades(spark, tmp_dir)
    assert where_hours(df, []).count() == 0 and where_hours(df, None).count() == 2


def test_snapshot_response_ingest(spark, tmp_dir):
    from tidewatch.plans.snapshot_ingest import ingest_snapshots
    from tidewatch.sources.bronze import read_bronze_snapshots, within_years
    resp = os.path.join(tmp_dir, "resp.json")
    with open(resp, "w") as f:
        json.dump([{"id": "bitcoin", "current_price": 65000, "roi": None, "image": "x"},
                   {"id": "ethereum", "current_price": 3500}], f)
    out = os.path.join(tmp_dir, "bronze")
    assert ingest_snapshots(spark, resp, out, NOW)["records"] == 2
    df = read_bronze_snapshots(spark, out)
    assert sorted(r["id"] for r in df.collect()) == ["bitcoin", "ethereum"]
    assert "roi" not in df.columns
    assert within_years(df, (2027, 2030)).count() == 0
    empty = os.path.join(tmp_dir, "empty.json")
    with open(empty, "w") as f:
        f.write("[]")
    assert ingest_snapshots(spark, empty, os.path.join(tmp_dir, "b2"), NOW)["records"] == 0


def test_silver_merge_counts_inserted_rows_and_is_idempotent(spark, tmp_dir):
    from tidewatch.plans.silver import run_silver_trades
    from tidewatch.sources.tables import Layout, create_tables, read_table
    layout = Layout(tmp_dir)
    land_jsonl(_trades(spark, [1, 2, 3]), layout.bronze_trades, "b1")
    create_tables(spark, layout)
    assert run_silver_trades(spark, layout) == 3
    land_jsonl(_trades(spark, [3, 4]), layout.bronze_trades, "b2")
    assert run_silver_trades(spark, layout) == 1
    assert run_silver_trades(spark, layout) == 0
    assert read_table(spark, layout, "silver_trades").count() == 4


def test_large_snapshot_landing_uses_several_writers(spark, tmp_dir, monkeypatch):
    from tidewatch.sources import landing
    monkeypatch.setattr(landing, "RECORDS_PER_FILE", 100)
    df = spark.range(1000).selectExpr("cast(id as string) AS id", "1.5D AS current_price")
    assert land_snapshots(df, tmp_dir, NOW)["records"] == 1000
    files = glob.glob(f"{tmp_dir}/year=2026/month=06/day=10/hour=14/batch=*/*.json")
    assert 5 < len(files) <= 10
    assert sum(len(open(f).read().splitlines()) for f in files) == 1000


def test_many_files_per_batch(spark, tmp_dir):
    land_jsonl(_trades(spark, range(40)), tmp_dir, "big", files=4)
    files = glob.glob(f"{tmp_dir}/year=2026/month=06/day=10/hour=14/batch=big/*.json")
    assert 1 < len(files) <= 4


def test_register_views(spark, tmp_dir):
    from tidewatch.sources.tables import Layout, create_tables, register_views
    layout = Layout(tmp_dir)
    land_jsonl(_trades(spark, [1, 2]), layout.bronze_trades, "b1")
    create_tables(spark, layout)
    made = register_views(spark, layout)
    assert {"bronze_trades", "silver_trades", "gold_anomalies"} <= set(made)
    assert spark.sql("SELECT count(*) FROM bronze_trades WHERE hour = '14'").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM gold_anomalies").first()[0] == 0


def test_catalog_tables(spark, tmp_dir):
    from tidewatch.sources.tables import CATALOG, Layout, create_catalog
    layout = Layout(tmp_dir)
    land_jsonl(_trades(spark, [1, 2]), layout.bronze_trades, "b1")
    made = create_catalog(spark, layout, prefix="tw_")
    try:
        assert made == [f"tw_{n}" for n in CATALOG]
        assert [spark.table(t).count() for t in made] == [2, 0, 0, 0, 0]
        assert spark.sql("SELECT trade_id FROM tw_bronze.trades WHERE hour = '14'").count() == 2
        land_jsonl(_trades(spark, [3]), layout.bronze_trades, "b2")
        create_catalog(spark, layout, prefix="tw_")
        assert spark.table("tw_bronze.trades").count() == 3
    finally:
        for name in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS tw_{name} CASCADE")


def test_snapshot_landing_may_be_compressed(spark, tmp_dir, monkeypatch):
    from tidewatch.sources import landing
    from tidewatch.sources.bronze import read_bronze_snapshots
    monkeypatch.setattr(landing, "RECORDS_PER_FILE", 100)
    df = spark.range(400).selectExpr("cast(id as string) AS id", "1.5D AS current_price")
    for _ in range(2):  # a replay replaces its files
        assert land_snapshots(df, tmp_dir, NOW, "gzip")["records"] == 400
    files = glob.glob(f"{tmp_dir}/year=2026/month=06/day=10/hour=14/batch=*/*.json.gz")
    assert 1 < len(files) <= 4
    got = read_bronze_snapshots(spark, tmp_dir)
    assert got.count() == got.select("id").distinct().count() == 400


def test_backfill_bronze_is_landed_compressed(spark, tmp_dir):
    from tidewatch.queries import _land_bronze
    spark.sql("SELECT 1L event_id, TIMESTAMP_NTZ'2026-01-01 10:00:00' ts, 2L user_id, 'view' event_type, "
              "1.5D value, '{\"k\": 3}' props").write.parquet(f"{tmp_dir}/events.parquet")
    layout = _land_bronze(spark, tmp_dir, f"{tmp_dir}/lake")
    for path in (layout.bronze_trades, layout.bronze_snapshots):
        files = glob.glob(f"{path}/**/part-*", recursive=True)
        assert files and all(f.endswith(".json.gz") for f in files)
    assert [r.price for r in read_bronze_trades(spark, layout.bronze_trades).collect()] == ["1.5"]


def test_landing_without_a_shuffle(spark, tmp_dir):
    from pyspark.sql import functions as F
    from tidewatch.sources.landing import land_jsonl
    df = spark.range(0, 450, numPartitions=3).selectExpr("id AS trade_id", "'1.5' AS price")
    for _ in range(2):  # a replay replaces its files
        land_jsonl(df, tmp_dir, "b", F.lit("2026-06-10T14:05:00+00:00"), compression="gzip",
                   records_per_file=100)
    files = glob.glob(f"{tmp_dir}/year=2026/month=06/day=10/hour=14/batch=b/*.json.gz")
    assert len(files) == 6  # two of each task
    assert sorted(r.trade_id for r in read_bronze_trades(spark, tmp_dir).collect()) == list(range(450))


def test_gold_after_late_rows_lands_compressed_and_keeps_nothing_staged(spark, tmp_dir):
    from tidewatch import queries as Q
    from tidewatch.session import shared_dir
    spark.sql("SELECT id event_id, TIMESTAMP_NTZ'2026-01-01 10:00:00' + make_dt_interval(0, 0, id, 0) ts, "
              "id user_id, 'view' event_type, 1.5D + id % 3 value, '{\"k\": 3}' props FROM range(1, 40)"
              ).write.parquet(f"{tmp_dir}/events.parquet")
    shared = shared_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{shared}/*"))
    assert Q.QUERIES["gold_incremental_moments"](spark, tmp_dir).count() > 0
    made = set(glob.glob(f"{shared}/*")) - before
    assert [p for p in made if "-merge-" in p] == []
    files = [f for p in made for f in glob.glob(f"{p}/lake/bronze/**/part-*", recursive=True)]
    assert files and all(f.endswith(".json.gz") for f in files)


def test_key_filters_of_small_files_are_small(spark, tmp_dir):
    import os
    import pyarrow.parquet as pq
    from tidewatch.sources.tables import append_day_partitioned
    df = spark.range(0, 300, numPartitions=1).selectExpr(
        "id AS trade_id", "TIMESTAMP_NTZ'2026-01-01 10:00:00' AS ingested_at")
    assert append_day_partitioned(df, tmp_dir, "ingested_at", "trade_id") == 300
    (file,) = glob.glob(f"{tmp_dir}/part_day=*/part-*")
    column = pq.ParquetFile(file).metadata.row_group(0).column(0)
    assert column.path_in_schema == "trade_id"
    assert 500 < os.path.getsize(file) - column.total_compressed_size < 8000  # it was 66 000
