"""Replay of rejected stream records with an attempt counter.

A run takes every reject that has neither landed nor run out of attempts, gives
it to ``mend`` and decodes it again.  What decodes now lands in bronze trades, what
does not counts one attempt more, and after ``max_attempts`` a record is kept apart
as exhausted, with its data, and not tried again.

Outcomes are a table, one folder per run (``run=<n>``); rejects themselves stay as
they are.  A run that died is started again under its number and time: it sees the
outcomes of earlier runs only and overwrites what it had landed, so nothing lands
twice.  Equal rejects (sequence number and data) are one record; of mended records
with one trade id, the smallest sequence number lands.  Runs go one at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.dedupe import dedupe_first
from tidewatch.session import scratch_path
from tidewatch.sources.landing import files_for, land_jsonl
from tidewatch.sources.rejects import decode_records

MAX_ATTEMPTS = 3
LANDED, FAILED, EXHAUSTED = "landed", "failed", "exhausted"
OUTCOMES = T.StructType([T.StructField("record", T.StringType()),
                         T.StructField("sequence_number", T.StringType()),
                         T.StructField("attempt", T.IntegerType()),
                         T.StructField("outcome", T.StringType()),
                         T.StructField("data", T.StringType()),  # of exhausted records
                         T.StructField("run", T.IntegerType())])
_REJECT = "sequence_number string, data string"


def _read(reader, schema, path: str, spark: SparkSession) -> DataFrame:
    try:
        return reader(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def outcomes(spark: SparkSession, layout) -> DataFrame:
    """One row per attempt of a record."""
    return _read(spark.read.schema(OUTCOMES).parquet, OUTCOMES, layout.bronze_reject_outcomes, spark)


def pending(spark: SparkSession, layout, run: int, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """``record``, ``sequence_number``, ``data``, ``attempt`` that run ``run`` has to make."""
    seen = (outcomes(spark, layout).where(F.col("run") < run).groupBy("record").agg(
        F.max("attempt").alias("before"), F.max(F.col("outcome") == LANDED).alias("landed")))
    rejects = _read(spark.read.schema(_REJECT).json, _REJECT, layout.bronze_rejects, spark)
    record = F.sha2(F.to_json(F.struct("sequence_number", "data")), 256)
    return (rejects.select(record.alias("record"), "sequence_number", "data")
            .dropDuplicates(["record"]).join(seen, "record", "left")
            .select("record", "sequence_number", "data", F.coalesce("landed", F.lit(False)).alias("landed"),
                    (F.coalesce("before", F.lit(0)) + 1).alias("attempt"))
            .where(~F.col("landed") & (F.col("attempt") <= max_attempts)).drop("landed"))


def replay_rejects(spark: SparkSession, layout, run: int, now: dt.datetime,
                   mend: Callable[[DataFrame], DataFrame] | None = None,
                   max_attempts: int = MAX_ATTEMPTS) -> dict[str, int]:
    """One replay; returns how many records ended how.  ``mend`` changes ``data`` of a
    frame and keeps its other columns and rows; ``now`` stamps what lands."""
    todo = pending(spark, layout, run, max_attempts).withColumn("original", F.col("data"))
    tried = decode_records(mend(todo) if mend else todo)
    outcome = F.when(~F.col("is_rejected"), LANDED).when(
        F.col("attempt") >= max_attempts, EXHAUSTED).otherwise(FAILED)
    staged = scratch_path(spark, "reject-replay")
    tried.withColumn("outcome", outcome).write.parquet(staged)  # mended and decoded once
    tried = spark.read.parquet(staged)
    told = {r.outcome: r["count"] for r in tried.groupBy("outcome").count().collect()}
    if told.get(LANDED):
        utc = now if now.tzinfo is None else now.astimezone(dt.timezone.utc)
        good = tried.where(F.col("outcome") == LANDED).select("trade.*", "sequence_number")
        good = dedupe_first(good, ["trade_id"], ["sequence_number"]).drop("sequence_number")
        land_jsonl(good.withColumn("ingested_at", F.lit(utc.strftime("%Y-%m-%dT%H:%M:%S.%f+00:00"))),
                   layout.bronze_trades, f"replay-{run:06d}", files=files_for(told[LANDED]))
    kept = F.when(F.col("outcome") == EXHAUSTED, F.col("original")).alias("data")
    (tried.select("record", "sequence_number", "attempt", "outcome", kept)
     .write.mode("overwrite").parquet(f"{layout.bronze_reject_outcomes}/run={run}"))
    return told
