"""Gold as a stream over silver.

A micro-batch is the rows that new files of the two silver tables bring.  It says
which windows they touch; those are scored from the tables (not from the batch,
so old rows of a window count too) and upserted.  A window's score depends only on
what is in silver, so batches may come in any order, a replayed batch gives the
same rows, and a batch that fails part-way is made up for by its replay.

The checkpoint knows which silver files gold has seen, so this form needs no
journal; run either this stream or the incremental job on a gold table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch import schemas as S
from tidewatch.plans import gold as G
from tidewatch.plans import silver as SV
from tidewatch.sources.tables import add_day, with_day

TRIGGER_SECONDS = 15 * 60


def touched_rows(spark: SparkSession, layout, max_files_per_trigger: int | None = None) -> DataFrame:
    """``source``, ``asset_symbol``, ``at``: every row that arrives in silver."""
    def stream(table: str, schema, ts: str) -> DataFrame:
        r = spark.readStream.schema(with_day(schema))
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.parquet(getattr(layout, table)).select(
            F.lit(table).alias("source"), "asset_symbol", F.col(ts).alias("at"))

    return stream("silver_trades", S.SILVER_TRADES, "trade_time").unionByName(
        stream("silver_snapshots", S.SILVER_SNAPSHOTS, "ingested_at"))


def score_batch(layout, staging: str, before_commit: Callable[[int], None] | None = None, **kw):
    """The ``foreachBatch`` sink; ``before_commit`` is called after the upsert."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.where("asset_symbol is not null and at is not null").persist()
        try:
            if batch.isEmpty():
                return
            trades = batch.where("source = 'silver_trades'").withColumnRenamed("at", "trade_time")
            snapshots = batch.where("source = 'silver_snapshots'").withColumnRenamed(
                "at", "ingested_at")
            scored = G.score_lows(spark, layout, SV.trade_changes(trades),
                                  SV.snapshot_changes(snapshots), exact_decimal=True, **kw)
            # each attempt has a folder of its own
            G.upsert_rows(spark, layout, add_day(G.typed_gold(scored), "window_start"),
                          f"{staging}/batch-{batch_id:010d}-{uuid.uuid4().hex[:8]}")
            if before_commit:
                before_commit(batch_id)
        finally:
            batch.unpersist()
    return sink


def start_gold_stream(spark: SparkSession, layout, checkpoint: str, staging: str,
                      available_now: bool = False, max_files_per_trigger: int | None = None,
                      before_commit: Callable[[int], None] | None = None, **kw) -> StreamingQuery:
    """Keep the gold table up to date with the silver tables.

    ``max_files_per_trigger`` bounds the files that each table gives a micro-batch."""
    w = (touched_rows(spark, layout, max_files_per_trigger).writeStream
         .foreachBatch(score_batch(layout, staging, before_commit, **kw))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now \
        else w.trigger(processingTime=f"{TRIGGER_SECONDS} seconds")
    return w.start()
