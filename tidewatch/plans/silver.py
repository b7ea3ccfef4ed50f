"""Bronze → silver jobs: read (optionally hour-pruned), type, remove repeats
inside the source, insert-only merge into the day-partitioned silver table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas as S
from tidewatch.functions.time import (
    MICROS_PER_MINUTE, floor_to_grid_micros, micros_to_ntz, ntz_micros,
)
from tidewatch.operators.dedupe import dedupe_first
from tidewatch.operators.merge import rows_to_insert, within_key_range
from tidewatch.operators.projections import quarantine_trades, type_snapshots, type_trades
from tidewatch.session import drop_scratch, scratch_path
from tidewatch.sources import journal, moments
from tidewatch.sources.bronze import read_bronze_snapshots, read_bronze_trades, where_hours
from tidewatch.sources.tables import DAY, Layout, add_day, append_day_partitioned, read_table

# Merge keys.  The reference keys trades by ``trade_id`` alone although ids
# are numbered per symbol; ``("symbol", "trade_id")`` is the safer option.
TRADE_KEYS = ["trade_id"]
SNAPSHOT_KEYS = ["id", "last_updated"]
#: Changed trades are noted by slots of this length.
SLOT = 10 * MICROS_PER_MINUTE


def trade_source(spark: SparkSession, layout: Layout, hours=None,
                 keys: list[str] = TRADE_KEYS, strict: bool = True) -> DataFrame:
    """Typed trades of the hours, one row per key (pure plan, one bronze scan)."""
    bronze = where_hours(read_bronze_trades(spark, layout.bronze_trades), hours)
    return dedupe_first(type_trades(bronze, strict=strict), keys, ["ingested_at", "trade_time"])


def snapshot_source(spark: SparkSession, layout: Layout, hours=None,
                    keys: list[str] = SNAPSHOT_KEYS, strict: bool = True) -> DataFrame:
    bronze = where_hours(read_bronze_snapshots(spark, layout.bronze_snapshots), hours)
    return dedupe_first(type_snapshots(bronze, strict=strict), keys, ["ingested_at"])


def silver_delta(spark: SparkSession, layout: Layout, table: str, source: DataFrame,
                 keys: list[str]) -> DataFrame:
    """Rows of a staged ``source`` that the merge into ``table`` inserts: one
    scan of the target's keys, bounded by the source's key ranges."""
    target = within_key_range(read_table(spark, layout, table), source, keys[-1])
    return rows_to_insert(target, source, keys)


def trade_changes(trades: DataFrame) -> DataFrame:
    """``asset_symbol``, ``low``: the slots of the window grid that hold the trades."""
    low = micros_to_ntz(floor_to_grid_micros(ntz_micros("trade_time"), SLOT))
    return trades.select("asset_symbol", low.alias("low")).distinct()


def snapshot_changes(snapshots: DataFrame) -> DataFrame:
    """``asset_symbol``, ``low``: the oldest of the snapshots."""
    return snapshots.groupBy("asset_symbol").agg(F.min("ingested_at").alias("low"))


def note_newest(layout: Layout, snapshots: DataFrame) -> None:
    """Append the newest of these snapshots per asset and day to the last-snapshot
    state (``silver/newest``).

    Written after the rows themselves, so it never names a snapshot that is not in
    the table; what a dead merge left out is added by the next one."""
    (add_day(snapshots, "ingested_at").groupBy("asset_symbol", DAY)
     .agg(F.max("ingested_at").alias("last")).coalesce(1)
     .write.mode("append").parquet(layout.silver_newest))  # a row per asset and day


def read_newest(spark: SparkSession, layout: Layout) -> DataFrame:
    """``asset_symbol``, ``last``: the newest snapshot of each day."""
    schema = f"asset_symbol string, {DAY} date, last timestamp_ntz"
    try:
        rows = spark.read.schema(schema).parquet(layout.silver_newest)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    return rows.groupBy("asset_symbol", DAY).agg(F.max("last").alias("last")).select(
        "asset_symbol", "last")


def _merge(spark: SparkSession, layout: Layout, table: str, source: DataFrame, keys: list[str],
           changes: Callable[[DataFrame], DataFrame],
           step: Callable[[str], None] | None = None) -> int:
    """Stage the source (bronze is parsed once) and what of it is new; note the
    change, append, close the note (:mod:`tidewatch.sources.journal`).  What was
    staged is deleted: the source once the new rows are known, these at the end.

    ``step`` is called after each of these: ``noted``, ``appended``, ``closed``.
    Notes that an earlier merge left open are closed too: a table has one merge at
    a time, so their merges are over."""
    path = scratch_path(spark, f"{table}-merge")
    try:
        return _staged_merge(spark, layout, table, source, keys, changes, path, step)
    finally:
        drop_scratch(path)


def _staged_merge(spark: SparkSession, layout: Layout, table: str, source: DataFrame,
                  keys: list[str], changes: Callable[[DataFrame], DataFrame], path: str,
                  step: Callable[[str], None] | None) -> int:
    tell = step or (lambda name: None)
    source.write.parquet(f"{path}/source")
    staged = spark.read.schema(source.schema).parquet(f"{path}/source")
    delta = silver_delta(spark, layout, table, staged, keys)
    delta.write.parquet(f"{path}/delta")
    delta = spark.read.schema(delta.schema).parquet(f"{path}/delta")
    drop_scratch(f"{path}/source")
    left, inserted, own = journal.open_notes(spark, layout, table), 0, []
    if not delta.isEmpty():
        own = [journal.open_note(spark, layout, table, changes(delta))]
        tell("noted")
        inserted = append_day_partitioned(delta, getattr(layout, table), "ingested_at", keys[-1])
        tell("appended")
    if table == "silver_snapshots":
        kept = moments.exists(spark, layout)
        if inserted:
            note_newest(layout, delta)
            if kept:
                moments.add(spark, layout, own[0], delta)
        if left and kept:
            moments.renew(spark, layout, max(left + own),
                          journal.lows_of(spark, layout, table, left))
        if left:  # what dead merges may have appended without saying so
            lows = journal.lows_of(spark, layout, table, left).groupBy("asset_symbol").agg(
                F.min("low").alias("_low"))
            first = lows.agg(F.min("_low")).first()[0]
            if first is not None:
                rows = read_table(spark, layout, table).where(
                    F.col(DAY) >= F.to_date(F.lit(str(first)))).join(lows, "asset_symbol")
                note_newest(layout, rows.where("ingested_at >= _low").select(
                    "asset_symbol", "ingested_at"))
    journal.close_notes(spark, layout, table, left + own)
    if own and table == "silver_snapshots" and kept:
        moments.fold(spark, layout, own[0])
    tell("closed")
    return inserted


def run_silver_trades(spark: SparkSession, layout: Layout, hours=None,
                      keys: list[str] = TRADE_KEYS, strict: bool = True,
                      step: Callable[[str], None] | None = None, rejects: bool = False) -> int:
    """One merge: append the new rows; returns how many were inserted.  An
    interrupted merge is repaired by running again (the anti-join skips
    whatever already landed).

    With ``rejects``, rows that cannot be typed do not fail the merge: they go to
    ``silver/rejects`` with a reason, the others are merged.  A rerun replaces the
    rejects of the bronze hours that still have some, so it repeats none."""
    if rejects:
        bronze = where_hours(read_bronze_trades(spark, layout.bronze_trades), hours)
        good, bad = quarantine_trades(bronze)
        (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*S.PARTITION_COLS).parquet(layout.silver_rejects))
        source = dedupe_first(good, keys, ["ingested_at", "trade_time"])
    else:
        source = trade_source(spark, layout, hours, keys, strict)
    return _merge(spark, layout, "silver_trades", source, keys, trade_changes, step)


def read_trade_rejects(spark: SparkSession, layout: Layout) -> DataFrame:
    """``reason`` and the bronze text of the trades that a merge set aside."""
    fields = [f for f in S.BRONZE_TRADES.fields if f.name not in S.PARTITION_COLS]
    fields += [T.StructField(c, T.StringType()) for c in S.PARTITION_COLS]
    schema = T.StructType([T.StructField("reason", T.StringType()), *fields])
    return spark.read.schema(schema).parquet(layout.silver_rejects)


def run_silver_snapshots(spark: SparkSession, layout: Layout, hours=None,
                         keys: list[str] = SNAPSHOT_KEYS, strict: bool = True,
                         step: Callable[[str], None] | None = None) -> int:
    return _merge(spark, layout, "silver_snapshots",
                  snapshot_source(spark, layout, hours, keys, strict), keys, snapshot_changes, step)


def silver_trades_for_gold(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_table(spark, layout, "silver_trades").drop("part_day")


def silver_snapshots_for_gold(spark: SparkSession, layout: Layout) -> DataFrame:
    """With the day column, by which a bounded read skips folders."""
    return (read_table(spark, layout, "silver_snapshots")
            .select("asset_symbol", "ingested_at",
                    F.col("current_price").cast("double").alias("current_price"), DAY))
