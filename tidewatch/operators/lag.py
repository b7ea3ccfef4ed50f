"""Consumer-lag breach report (batch form of the lag alarm).

Lag of a record = arrival time - event time.  Per one-minute period (by
arrival) the maximum lag is taken; a period breaches when it exceeds the
threshold; the alarm fires in a period that breaches right after a period
that also breached.  Periods without data never breach.

Adjacent periods are paired with an equi-join on ``minute - 1`` over the
per-minute table (size bounded by the time span), not a global ``lag()``
window, which would put every row in one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.time import ntz_micros

# Alarm threshold and period.
LAG_THRESHOLD_MS = 60_000
PERIOD = "1 minute"
CONSECUTIVE = 2


def lag_per_period(df: DataFrame, event_ts: str, arrival_ts: str,
                   period: str = PERIOD) -> DataFrame:
    lag_ms = ((ntz_micros(arrival_ts) - ntz_micros(event_ts)) / 1000).cast("long")
    return (df.groupBy(F.window(arrival_ts, period).start.alias("minute"))
              .agg(F.max(lag_ms).alias("max_lag_ms")))


def lag_breaches(df: DataFrame, event_ts: str = "trade_time",
                 arrival_ts: str = "arrived_at",
                 threshold_ms: int = LAG_THRESHOLD_MS,
                 consecutive: int = CONSECUTIVE) -> DataFrame:
    """Periods where the alarm fires (the last of ``consecutive`` breaching
    ones), with this and the previous max lag."""
    per = lag_per_period(df, event_ts, arrival_ts)
    breach = per.where(F.col("max_lag_ms") > threshold_ms)
    fired = breach
    for back in range(1, consecutive):
        before = breach.select(
            F.timestamp_add("MINUTE", F.lit(back), F.col("minute")).alias("minute"),
            F.col("max_lag_ms").alias("prev_max_lag_ms"))
        fired = (fired.join(before, "minute") if back == 1
                 else fired.join(before.select("minute"), "minute", "left_semi"))
    return fired
