"""Window-size diagnostic: trades per (asset, window) for several candidate
window sizes, with the first and last (truncated) window of each asset
dropped, summarised as min / avg / max per asset and size.

Trades are counted once, at the greatest common divisor of the candidate
sizes; the few counts are then rolled up to every size.  The edge windows
come from the counts, by an aggregate joined back — no sort per group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.time import MICROS_PER_MINUTE, ntz_micros

# The candidate window sizes in minutes.
CANDIDATE_MINUTES = [5, 10, 15, 20]


def window_size_diagnostic(trades: DataFrame, by: str = "asset_symbol",
                           ts: str = "trade_time",
                           sizes: list[int] = CANDIDATE_MINUTES) -> DataFrame:
    unit = math.gcd(*sizes) * MICROS_PER_MINUTE
    fine = trades.groupBy(by, F.floor(ntz_micros(ts) / unit).cast("long").alias("_u")).agg(
        F.count(F.lit(1)).alias("_c"))
    counts = (fine.withColumn("window_minutes", F.explode(F.array(*[F.lit(m) for m in sizes])))
              .groupBy("window_minutes", by, F.floor(
                  F.col("_u") * unit / (F.col("window_minutes") * MICROS_PER_MINUTE))
                  .cast("long").alias("_b"))
              .agg(F.sum("_c").alias("_n")))
    edges = counts.groupBy("window_minutes", by).agg(
        F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
    inner = (counts.join(edges, ["window_minutes", by])
             .where((F.col("_b") > F.col("_lo")) & (F.col("_b") < F.col("_hi"))))
    return inner.groupBy("window_minutes", by).agg(
        F.min("_n").alias("min_trades"), F.avg("_n").alias("avg_trades"),
        F.max("_n").alias("max_trades"), F.count(F.lit(1)).alias("windows"))
