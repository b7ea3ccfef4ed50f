"""Stored slot moments: per asset and ten-minute group of snapshots the newest
time, count, mean and M2 of the price (:func:`~tidewatch.operators.baseline.slot_moments`),
kept by the snapshot merge, so that a baseline reads raw snapshots only at the
low edge of its frame.

A merge adds the moments of the rows it inserted under its number in the change
journal; parts of a group are merged by the formula of Chan et al.  The journal
also says what not to trust: groups from the oldest row of an *open* note on may
lack rows that are in the table.  The next merge computes these groups again from
the table (``whole``), which replaces what older numbers said about them.

The state exists from :func:`start` on.  Rows that get into silver by another way
than the merge are not in it; run :func:`start` again after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.time import ceil_to_grid_micros, ntz_micros
from tidewatch.operators.baseline import SLOT, slot_moments
from tidewatch.sources import journal
from tidewatch.sources.partials import PartialStore
from tidewatch.sources.tables import DAY, Layout, read_table

TABLE = "silver_snapshots"
#: Merges between two folds of the stored batches.
FOLD_EVERY = 32
_GROUP = ["asset_symbol", "slot_end"]
MOMENTS = T.StructType([
    T.StructField("asset_symbol", T.StringType()), T.StructField("slot_end", T.LongType()),
    T.StructField("newest", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType()),
    T.StructField("seq", T.LongType()), T.StructField("whole", T.BooleanType())])


def merge_moments(parts: DataFrame) -> DataFrame:
    """One row per group: its last ``whole`` row and the parts after it, pooled."""
    group = Window.partitionBy(*_GROUP)
    last = F.max(F.when(F.col("whole"), F.col("seq"))).over(group)
    n = F.col("n").cast("double")
    valid = (parts.withColumn("_last", last)
             .where("_last is null or seq > _last or (whole and seq = _last)")
             .withColumn("_mean", F.coalesce(F.try_divide(
                 F.sum(n * F.col("mean")).over(group), F.sum(n).over(group)), F.lit(0.0))))
    apart = F.col("mean") - F.col("_mean")
    return valid.groupBy(*_GROUP).agg(
        F.max("newest").alias("newest"), F.sum("n").alias("n"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + n * apart * apart).alias("m2"),
        F.max("seq").alias("seq"), F.lit(True).alias("whole")).select(*MOMENTS.names)


def store(spark: SparkSession, layout: Layout) -> PartialStore:
    return PartialStore(spark, layout.silver_moments, MOMENTS, merge_moments)


def exists(spark: SparkSession, layout: Layout) -> bool:
    return store(spark, layout).folded() >= 0


def _add(spark: SparkSession, layout: Layout, seq: int, moments: DataFrame, whole: bool) -> None:
    store(spark, layout).add(2 * seq + whole, moments.withColumn("seq", F.lit(seq).cast("long"))
                             .withColumn("whole", F.lit(whole)))


def start(spark: SparkSession, layout: Layout) -> None:
    """Compute the state from the whole table (while no merge runs)."""
    seq = max([journal.last_number(spark, layout, TABLE), (store(spark, layout).folded() + 1) // 2])
    _add(spark, layout, seq, slot_moments(read_table(spark, layout, TABLE)), True)
    store(spark, layout).fold(2 * seq + 1)


def add(spark: SparkSession, layout: Layout, seq: int, inserted: DataFrame) -> None:
    """The moments of the rows that merge ``seq`` has appended."""
    _add(spark, layout, seq, slot_moments(inserted), False)


def renew(spark: SparkSession, layout: Layout, seq: int, lows: DataFrame) -> None:
    """Compute the groups of ``lows`` (``asset_symbol``, ``low``) from there on
    again from the table; they replace those of numbers up to ``seq``."""
    lows = _from(lows)
    first = lows.agg(F.min("_from")).first()[0]
    if first is None:
        return
    rows = read_table(spark, layout, TABLE).where(
        F.col(DAY) >= F.to_date(F.timestamp_micros(F.lit(first - SLOT)))).select(
        "asset_symbol", "ingested_at", "current_price").join(lows, "asset_symbol")
    rows = rows.where(ntz_micros("ingested_at") > F.col("_from") - SLOT)
    _add(spark, layout, seq, slot_moments(rows), True)


def fold(spark: SparkSession, layout: Layout, seq: int) -> None:
    """Fold now and then; for a merge whose notes are all closed."""
    kept = store(spark, layout)
    if 2 * seq + 1 - kept.folded() >= 2 * FOLD_EVERY:
        kept.fold(2 * seq + 1)


def _from(lows: DataFrame) -> DataFrame:
    """``asset_symbol``, ``_from``: end of the first group that holds the asset's low."""
    return lows.where("low is not null").groupBy("asset_symbol").agg(
        F.min(ceil_to_grid_micros(ntz_micros("low"), SLOT)).alias("_from"))


def read(spark: SparkSession, layout: Layout, snapshots: DataFrame | None = None) -> DataFrame:
    """The moments of every group; those that an open note may have changed are
    computed from ``snapshots`` (default: the table)."""
    kept = store(spark, layout).rows().drop("seq", "whole")
    opened = journal.open_notes(spark, layout, TABLE)
    if not opened:
        return kept
    lows = _from(journal.lows_of(spark, layout, TABLE, opened))
    rows = (read_table(spark, layout, TABLE) if snapshots is None else snapshots).select(
        "asset_symbol", "ingested_at", "current_price").join(lows, "asset_symbol").where(
        ntz_micros("ingested_at") > F.col("_from") - SLOT)
    trusted = kept.join(lows, "asset_symbol", "left").where(
        "_from is null or slot_end < _from").drop("_from")
    return trusted.unionByName(slot_moments(rows))
