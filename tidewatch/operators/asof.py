"""Backward as-of left join: for each left row, the newest right row of the
same key with ``right_ts <= left_ts`` (inclusive); unmatched left rows keep
null payload.  Right rows with a null key never match (plain equality).

The reference decorrelates this into ``JOIN ... ON ts <= ts`` plus
``ROW_NUMBER() = 1``, which materialises every earlier right row per left
row (quadratic).  Here it is linear:

``asof_join_plain``
    Union both sides, sort by (key, time, side) with right rows first at
    equal times, and carry the last right payload forward
    (``last(..., ignorenulls)`` over a running frame).  One partition per key.

``asof_join_bucketed`` (used by the gold plan)
    Same carry-forward, but partitioned by (key, slot), a slot being ten
    minutes, so a hot (key, day) is spread over 144 partitions.  Left rows
    before the first right row of their slot take a carry-in in two levels: the
    last right row of an earlier slot of the same day (a table of at most 144
    cells per key and day), else that of an earlier day (one cell per key and
    day).  Only these cells are carried, never raw rows, and no task holds
    a key's whole history of slots.  With ``right_grid`` set (left times all lie
    on that grid, e.g. window ends), right rows are first reduced to the newest
    one per (key, grid point) by a map-side-combined ``max_by`` aggregate; a day
    then is bounded by the grid and is one slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.time import (
    MICROS_PER_DAY, MICROS_PER_MINUTE, ceil_to_grid_micros, ntz_micros,
)

SLOT = 10 * MICROS_PER_MINUTE


def _sides(left: DataFrame, right: DataFrame, by: str, left_ts: str,
           right_key, payload: list[str]):
    lrow = F.struct(*[F.col(c) for c in left.columns])
    rrow = F.struct(*[F.col(c) for c in payload])
    lt = left.select(F.col(by).alias("_by"), ntz_micros(left_ts).alias("_key"),
                     F.lit(1).alias("_side"), lrow.alias("_l"))
    rt = (right.where(F.col(by).isNotNull())
          .select(F.col(by).alias("_by"), right_key.alias("_key"),
                  F.lit(0).alias("_side"), rrow.alias("_r")))
    return lt, rt


def _union(lt: DataFrame, rt: DataFrame) -> DataFrame:
    """Both sides in one frame; each side's struct is null on the other."""
    return lt.unionByName(rt, allowMissingColumns=True)


def asof_join_plain(left: DataFrame, right: DataFrame, by: str, left_ts: str,
                    right_ts: str, payload: list[str]) -> DataFrame:
    lt, rt = _sides(left, right, by, left_ts, ntz_micros(right_ts), payload)
    w = (Window.partitionBy("_by").orderBy("_key", "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = _union(lt, rt).select(
        "_side", "_l", F.last("_r", ignorenulls=True).over(w).alias("_m"))
    return u.where(F.col("_side") == 1).select(
        *[F.col(f"_l.{c}").alias(c) for c in left.columns],
        *[F.col(f"_m.{c}").alias(c) for c in payload])


def _before(cells: DataFrame, value: str, within: list[str], order: str) -> DataFrame:
    """``_in``: the last non-null ``value`` of the cells before each one."""
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("_in", F.last(value, ignorenulls=True).over(w))


def asof_join_bucketed(left: DataFrame, right: DataFrame, by: str,
                       left_ts: str, right_ts: str, payload: list[str],
                       bucket: int = MICROS_PER_DAY,
                       right_grid: int | None = None, slot: int = SLOT) -> DataFrame:
    rkey = ntz_micros(right_ts)
    if right_grid:
        # newest right row per (key, grid point at or after it)
        g = ceil_to_grid_micros(rkey, right_grid)
        right = (right.where(F.col(by).isNotNull())
                 .groupBy(F.col(by), g.alias("_g"))
                 .agg(F.max_by(F.struct(*[F.col(c) for c in payload]), rkey).alias("_p"))
                 .select(by, "_g", *[F.col(f"_p.{c}").alias(c) for c in payload]))
        rkey = F.col("_g")
        slot = bucket
    lt, rt = _sides(left, right, by, left_ts, rkey, payload)
    cell = F.floor(F.col("_key") / F.lit(slot)).cast("long")
    lt, rt = lt.withColumn("_s", cell), rt.withColumn("_s", cell)

    w = (Window.partitionBy("_by", "_s").orderBy("_key", "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    win = (_union(lt, rt)
           .select("_by", "_s", "_key", "_side", "_l",
                   F.last("_r", ignorenulls=True).over(w).alias("_m")))
    inb = win.where(F.col("_side") == 1).select("_by", "_s", "_l", "_m")

    # carry-in: the running value at the end of each (key, slot) is that slot's
    # last right row.  The aggregate reads the window output, already
    # partitioned by (key, slot): no second shuffle of rows.
    cells = win.groupBy("_by", "_s").agg(
        F.max_by("_m", F.struct("_key", "_side")).alias("_lr"))
    if slot == bucket:
        carry = _before(cells, "_lr", ["_by"], "_s").select("_by", "_s", F.col("_in").alias("_c"))
    else:
        cells = cells.withColumn("_b", F.floor(F.col("_s") * F.lit(slot) / F.lit(bucket)).cast("long"))
        in_day = _before(cells, "_lr", ["_by", "_b"], "_s")
        last = F.max_by("_lr", F.when(F.col("_lr").isNotNull(), F.col("_s"))).alias("_lr")
        days = _before(cells.groupBy("_by", "_b").agg(last), "_lr", ["_by"], "_b").select(
            "_by", "_b", F.col("_in").alias("_day_in"))
        carry = in_day.join(days, ["_by", "_b"], "left").select(
            "_by", "_s", F.coalesce("_in", "_day_in").alias("_c"))

    out = inb.join(carry, ["_by", "_s"], "left")
    m = F.coalesce(F.col("_m"), F.col("_c"))
    return out.select(*[F.col(f"_l.{c}").alias(c) for c in left.columns],
                      *[m[c].alias(c) for c in payload])


def asof_join(left, right, by, left_ts, right_ts, payload, form="bucketed", **kw):
    if form == "plain":
        return asof_join_plain(left, right, by, left_ts, right_ts, payload)
    return asof_join_bucketed(left, right, by, left_ts, right_ts, payload, **kw)
