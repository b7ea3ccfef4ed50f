"""Table merges expressed as joins (Parquet has no MERGE in Spark).

* insert-only: add source rows whose key is absent from the target; existing
  rows never change; a rerun adds nothing; a null key never matches, so such
  rows are inserted every time (plain equality, as in SQL MERGE).
* upsert: matched target rows are replaced by the source row, unmatched
  source rows are inserted, target rows without a source row are kept.  The
  source must hold a key once (a repeated one would be inserted twice, where
  SQL MERGE refuses); ``dedupe_first`` makes it so.

Only the key columns of the target are read to find matches, and they are
first reduced to the keys present in the source with a left-semi join: when
the source batch is small, AQE broadcasts its keys and the big target is
scanned in place without being shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.time import micros_to_ntz, ntz_micros


#: Key ranges that a look-up in the target is split into, and the equal steps of
#: the source's key span that they are made of.
KEY_RANGES, KEY_STEPS = 16, 4096


def key_ranges(source: DataFrame, key: str, ranges: int = KEY_RANGES) -> list[tuple]:
    """At most ``ranges`` disjoint intervals that hold every ``key`` of the source,
    parted at its widest gaps: the many new keys are one, a few late ones apart.

    One aggregation by equal steps of the key span (an action; about
    ``KEY_STEPS`` rows come to the driver).  Keys are whole numbers or times."""
    number = _key_number(source, key)
    low, high = source.agg(F.min(number), F.max(number)).first()
    if low is None:
        return []
    step = (high - low) // KEY_STEPS + 1
    parts = sorted((r.low, r.high) for r in source.where(F.col(key).isNotNull()).groupBy(
        F.floor((number.cast("double") - float(low)) / float(step)).alias("part")).agg(
        F.min(number).alias("low"), F.max(number).alias("high")).collect())
    gaps = sorted(range(1, len(parts)), key=lambda i: parts[i - 1][1] - parts[i][0])[:ranges - 1]
    starts = [0, *sorted(gaps), len(parts)]
    return [(parts[i][0], parts[j - 1][1]) for i, j in zip(starts, starts[1:])]


def _key_number(df: DataFrame, key: str):
    return ntz_micros(key) if isinstance(df.schema[key].dataType, T.TimestampNTZType) else F.col(key)


def within_key_range(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose ``key`` lies in one of the source's :func:`key_ranges`
    (between its smallest and largest for other types of key).

    The bounds are read from the source (an action; meant for a staged source) and
    reach the scan as literals, so files and row groups outside are skipped.  When all
    ranges are single keys (a look-up of a few), the Bloom filters of the silver tables
    skip row groups too; beside a wider range Parquet does not use them.  Rows left out
    cannot match."""
    kind = source.schema[key].dataType
    if not isinstance(kind, (T.IntegralType, T.TimestampNTZType)):
        low, high = source.agg(F.min(key), F.max(key)).first()
        return target.where(F.col(key).between(low, high) if low is not None else F.lit(False))
    literal = (lambda n: micros_to_ntz(F.lit(n))) if isinstance(kind, T.TimestampNTZType) else F.lit
    wanted = F.lit(False)
    for low, high in key_ranges(source, key):
        wanted |= (F.col(key) == literal(low) if low == high
                   else F.col(key).between(literal(low), literal(high)))
    return target.where(wanted)


def matched_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target keys that also occur in the source."""
    src_keys = source.select(*keys)
    return target.select(*keys).join(src_keys, keys, "left_semi")


def rows_to_insert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key is not in the target (insert-only merge delta)."""
    return source.join(matched_keys(target, source, keys), keys, "left_anti")


def merge_insert_only(target: DataFrame, source: DataFrame,
                      keys: list[str]) -> DataFrame:
    """Content of the target after an insert-only merge."""
    return target.unionByName(rows_to_insert(target, source, keys))


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Content of the target after an upsert (no delete branch)."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))
