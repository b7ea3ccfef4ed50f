"""Z-score, anomaly flag and usable-baseline filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the sigma threshold (strict ``>``), meant to be tuned.
DEFAULT_THRESHOLD = 3.0


def with_zscore(df: DataFrame, value: str = "vwap", mean: str = "baseline_mean",
                std: str = "baseline_stddev", threshold: float = DEFAULT_THRESHOLD,
                z_col: str = "z_score", flag_col: str = "is_anomaly") -> DataFrame:
    """``z = (value - mean) / std`` in double; ``|z| > threshold`` strictly;
    a null z (no baseline, null VWAP, zero stddev) gives ``false``."""
    z = F.try_divide(F.col(value).cast("double") - F.col(mean).cast("double"),
                     F.col(std).cast("double"))
    return (df.withColumn(z_col, z)
              .withColumn(flag_col, F.coalesce(F.abs(F.col(z_col)) > F.lit(threshold),
                                                F.lit(False))))


def usable_baseline(df: DataFrame, std: str = "baseline_stddev") -> DataFrame:
    """Keep windows with ``stddev > 0``: drops windows without any baseline
    and single-snapshot baselines (null stddev)."""
    return df.where(F.col(std) > 0)
