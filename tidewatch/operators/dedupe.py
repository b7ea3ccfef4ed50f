"""Key uniqueness inside one source (first record per key wins).

Written as an aggregate, not a ``row_number`` window: ``min_by`` combines on
the map side, so a key that holds a large share of the rows is reduced in
every map task before the shuffle instead of being sorted in one task.
Rows with a null key are all kept (a null key never matches in a merge): a
per-row tag joins their key, so the input is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` tuple; ties are
    decided by the remaining columns, so the choice never depends on the
    order of arrival."""
    others = [c for c in df.columns if c not in keys]
    null_key = F.greatest(F.lit(False), *[F.col(k).isNull() for k in keys])
    tag = F.when(null_key, F.monotonically_increasing_id())
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in others if c not in order])
    return (df.withColumn("_tag", tag).groupBy(*keys, "_tag")
            .agg(F.min(rank).alias("_first"))
            .select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c)
                      for c in df.columns]))
