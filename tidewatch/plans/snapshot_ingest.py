"""Snapshot ingest batch: a landed market-API response → bronze snapshots.

The response (a JSON array, or JSON lines) is read with the declared bronze
schema — undeclared keys such as ``roi`` / ``image`` are dropped, missing
keys are null — stamped with one ``ingested_at`` and landed under the hour
partition of that stamp.  An empty response writes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewatch import schemas as S
from tidewatch.sources.landing import land_snapshots

RESPONSE_SCHEMA = T.StructType(
    [f for f in S.BRONZE_SNAPSHOTS.fields
     if f.name not in S.PARTITION_COLS + ["ingested_at", "_ingested_at"]])


def read_response(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return spark.read.schema(RESPONSE_SCHEMA).option("multiLine", multiline).json(path)


def ingest_snapshots(spark: SparkSession, response_path: str, bronze_path: str,
                     now: dt.datetime | None = None, multiline: bool = True,
                     compression: str | None = None) -> dict:
    return land_snapshots(read_response(spark, response_path, multiline),
                          bronze_path, now, compression)
