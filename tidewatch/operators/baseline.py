"""Moving baseline: mean and sample stddev over a RANGE frame
``[t - 6 h, t]`` per asset (both ends inclusive, peers included).

Three physical forms with identical results:

``moving_stats_plain``
    One window partitioned by asset, ordered by exact microseconds.  Simple,
    but a whole asset lands in one task and Spark's sliding frame re-scans its
    buffer for every row (cost rows x frame rows).  Kept as the reference form.

``moving_stats_halo``
    Rows are bucketed by (asset, bucket of ``bucket`` micros); each row is also
    copied into the following bucket(s) whose start lies within the frame, so
    every bucket holds its full look-back.  One shuffle, by (asset, bucket);
    copies are dropped after.  Inside a bucket time is cut into blocks as long
    as the frame: the frame of a row at ``t`` is the rows of its own block up to
    ``t`` (prefix) and those of the block before from ``t - frame`` on (suffix,
    through a probe at that time).  Both are running windows over sorted rows,
    merged as below, so work per task is linear in one bucket plus its halo.

``moving_stats_sliced`` (used by the gold plan)
    The frame of a row at ``t`` in slot ``k`` (slot width ``w``, frame ``m*w``)
    is: rows of slot ``k`` up to ``t`` (prefix, peers included), all rows of
    slots ``k-m+1 .. k-1``, and rows of slot ``k-m`` from ``t - frame`` on
    (suffix).  Prefix and suffix are running (not sliding) windows over one
    slot each; the middle merges at most ``m-1`` per-slot summaries.  The three
    parts are combined with the k-way (Chan) merge of count, mean and M2,
    which is numerically stable.  Every task holds one slot of one asset, and
    the cost is linear in the rows.

``baseline_at_grid`` (used by the gold plan)
    The same decomposition evaluated only at the newest row of each grid
    group — the only rows an as-of join on grid times can pick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.time import (
    MICROS_PER_HOUR, MICROS_PER_MINUTE, ceil_to_grid_micros, micros_to_ntz, ntz_micros,
)

FRAME = 6 * MICROS_PER_HOUR
SLOT = 10 * MICROS_PER_MINUTE
HALO_BUCKET = 24 * MICROS_PER_HOUR


def moving_stats_plain(df: DataFrame, by: str = "asset_symbol",
                       ts: str = "ingested_at", value: str = "current_price",
                       frame: int = FRAME, mean_col: str = "baseline_mean",
                       std_col: str = "baseline_stddev") -> DataFrame:
    w = (Window.partitionBy(by).orderBy(ntz_micros(ts))
         .rangeBetween(-frame, Window.currentRow))
    return df.select("*", F.avg(value).over(w).alias(mean_col),
                     F.stddev_samp(value).over(w).alias(std_col))


def moving_stats_halo(df: DataFrame, by: str = "asset_symbol",
                      ts: str = "ingested_at", value: str = "current_price",
                      frame: int = FRAME, bucket: int = HALO_BUCKET,
                      mean_col: str = "baseline_mean",
                      std_col: str = "baseline_stddev") -> DataFrame:
    cols = df.columns
    t = ntz_micros(ts)
    home = F.floor(t / F.lit(bucket)).cast("long")
    # buckets b > home whose start b*bucket lies within `frame` after t
    last = F.floor((t + F.lit(frame)) / F.lit(bucket)).cast("long")
    tagged = df.select("*", t.alias("_t"), home.alias("_home"),
                       F.floor(t / F.lit(frame)).cast("long").alias("_k"),
                       F.col(value).cast("double").alias("_v"),
                       F.sequence(home, F.greatest(home, last)).alias("_bks"))
    copies = tagged.select("*", F.explode("_bks").alias("_bk")).drop("_bks").repartition(by, "_bk")

    # prefix of the own block, up to and including peers of t
    wp = (Window.partitionBy(by, "_bk", "_k").orderBy("_t")
          .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    with_prefix = copies.select("*", *_moments("_v", wp, "_pre"), F.min("_v").over(wp).alias("_pre_low"),
                                F.max("_v").over(wp).alias("_pre_high"))

    # suffix of the block before: each row of the bucket itself also sends a
    # probe there; ordered newest first, a running frame covers rows >= probe
    sent = with_prefix.select("*", F.explode(
        F.when(F.col("_bk") == F.col("_home"), F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))).alias("_probe"))
    sent = sent.withColumns({"_k": F.col("_k") - F.col("_probe"),
                             "_t": F.col("_t") - F.col("_probe") * F.lit(frame),
                             "_v": F.when(F.col("_probe") == 0, F.col("_v"))})
    ws = (Window.partitionBy(by, "_bk", "_k").orderBy(F.col("_t").desc())
          .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    both = sent.select("*", *_moments("_v", ws, "_suf"), F.min("_v").over(ws).alias("_suf_low"),
                       F.max("_v").over(ws).alias("_suf_high")).where(F.col("_probe") == 1)
    n, mean, m2 = _combine(["_pre", "_suf"])
    # the means of two parts of equal values may differ in the last digit
    low = F.least("_pre_low", "_suf_low")
    flat = (low == F.greatest("_pre_high", "_suf_high")) & (F.abs(low) < float("inf"))
    return both.select(
        *cols,
        F.when(n > 0, mean).alias(mean_col),
        F.when(n > 1, F.when(flat, F.lit(0.0)).otherwise(
            F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1)))).alias(std_col))


def _day_buckets(df: DataFrame, key: str, reach: int,
                 bucket: int = HALO_BUCKET) -> DataFrame:
    """Rows tagged with ``_bk`` (bucket copies) and ``_hb`` (home bucket) so a
    look-back frame of ``reach`` (same unit as ``key``) over ``key`` can be
    evaluated per (partition key, bucket): each row is also copied into the
    later buckets whose start lies within ``reach`` after it.  Evaluate the
    window partitioned by ``_bk`` as well, then keep ``_bk == _hb``."""
    home = F.floor(F.col(key) / F.lit(bucket)).cast("long")
    last = F.floor((F.col(key) + F.lit(reach)) / F.lit(bucket)).cast("long")
    return (df.withColumn("_hb", home)
              .withColumn("_bk", F.explode(F.sequence(home, F.greatest(home, last)))))


def _moments(value: str, w: Window, prefix: str) -> list[Column]:
    """count, mean and M2 (sum of squared deviations) of the non-null values
    over ``w``, as three columns; an empty frame gives (0, 0.0, 0.0)."""
    n = F.count(value).over(w)
    return [n.alias(f"{prefix}_n"),
            F.coalesce(F.avg(value).over(w), F.lit(0.0)).alias(f"{prefix}_mean"),
            F.coalesce(F.var_pop(value).over(w) * n, F.lit(0.0)).alias(f"{prefix}_m2")]


def _combine(parts: list[str]) -> tuple[Column, Column, Column]:
    """k-way merge of (n, mean, M2) parts (Chan et al.): the pooled mean is
    the weighted mean, and M2 adds each part's n * (mean_i - mean)^2 — no
    difference of large sums, so it stays exact to rounding."""
    n = " + ".join(f"{p}_n" for p in parts)
    mean = "try_divide({}, CAST({} AS DOUBLE))".format(
        " + ".join(f"{p}_n * {p}_mean" for p in parts), n)
    m2 = " + ".join(f"{p}_m2 + {p}_n * ({p}_mean - {mean}) * ({p}_mean - {mean})"
                    for p in parts)
    return F.expr(n), F.expr(mean), F.expr(m2)


# second pass over pooled slot summaries: sum of n_i * (mean_i - mean)^2
_SPREAD = "aggregate(_parts, 0D, (acc, x) -> acc + x.n * (x.mean - {m}) * (x.mean - {m}))"


def moving_stats_sliced(df: DataFrame, by: str = "asset_symbol",
                        ts: str = "ingested_at", value: str = "current_price",
                        frame: int = FRAME, slot: int = SLOT,
                        mean_col: str = "baseline_mean",
                        std_col: str = "baseline_stddev") -> DataFrame:
    if frame % slot:
        raise ValueError("frame must be a whole number of slots")
    m = frame // slot
    cols = df.columns
    base = df.select("*", ntz_micros(ts).alias("_t"),
                     F.floor(ntz_micros(ts) / F.lit(slot)).cast("long").alias("_k"),
                     F.col(value).cast("double").alias("_v"))

    # 1. prefix of the own slot, up to and including peers of t
    wp = (Window.partitionBy(by, "_k").orderBy("_t")
          .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    with_prefix = base.select(*cols, "_k", "_t", *_moments("_v", wp, "_pre"))

    # 2. per-slot summaries, then the pooled summary of the m-1 slots before
    #    each slot (a sliding frame over a table of assets x slots rows)
    slots = base.groupBy(by, "_k").agg(
        F.count("_v").alias("n"),
        F.coalesce(F.avg("_v"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop("_v") * F.count("_v"), F.lit(0.0)).alias("m2"))
    # look-back over the slot table, per (key, day) with a halo of m-1 slots
    slots = _day_buckets(slots.withColumn("_ks", F.col("_k") * slot), "_ks",
                         (m - 1) * slot)
    wm = (Window.partitionBy(by, "_bk").orderBy("_k")
          .rangeBetween(-(m - 1), -1))
    pooled = slots.select(
        by, "_k", "_bk", "_hb",
        F.sum("n").over(wm).alias("_mid_n"),
        F.sum(F.col("n") * F.col("mean")).over(wm).alias("_s"),
        F.sum("m2").over(wm).alias("_w2"),
        F.collect_list(F.struct("n", "mean")).over(wm).alias("_parts"))
    mid_mean = F.try_divide(F.col("_s"), F.col("_mid_n").cast("double"))
    middle = pooled.where(F.col("_bk") == F.col("_hb")).select(
        F.col(by).alias("_mby"), F.col("_k").alias("_mk"),
        F.coalesce(F.col("_mid_n"), F.lit(0)).alias("_mid_n"),
        F.coalesce(mid_mean, F.lit(0.0)).alias("_mid_mean"),
        F.coalesce(F.col("_w2") + F.expr(_SPREAD.format(m="try_divide(_s, CAST(_mid_n AS DOUBLE))")),
                   F.lit(0.0)).alias("_mid_m2"))

    # 3. suffix of slot k-m from t - frame on: each row sends a probe into
    #    slot k-m; ordered newest first, a running frame covers rows >= probe
    pre_cols = ["_pre_n", "_pre_mean", "_pre_m2"]
    probes = with_prefix.select(
        *cols, *pre_cols, F.col("_k").alias("_home"),
        (F.col("_k") - m).alias("_slot"), (F.col("_t") - frame).alias("_t"),
        F.lit(None).cast("double").alias("_v"))
    reals = base.select(
        *[(F.col(c) if c == by else F.lit(None).cast(df.schema[c].dataType)).alias(c)
          for c in cols],
        *[F.lit(None).cast(with_prefix.schema[c].dataType).alias(c) for c in pre_cols],
        F.lit(None).cast("long").alias("_home"), F.col("_k").alias("_slot"),
        "_t", "_v")
    ws = (Window.partitionBy(by, "_slot").orderBy(F.col("_t").desc())
          .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    suffixed = (probes.unionByName(reals)
                .select("*", *_moments("_v", ws, "_suf"))
                .where(F.col("_home").isNotNull()))

    # 4. prefix + middle + suffix
    joined = suffixed.join(
        middle, F.col(by).eqNullSafe(F.col("_mby")) & (F.col("_home") == F.col("_mk")),
        "left").fillna(0, subset=["_mid_n"]).fillna(0.0, subset=["_mid_mean", "_mid_m2"])
    n, mean, m2 = _combine(["_pre", "_mid", "_suf"])
    return joined.select(
        *cols,
        F.when(n > 0, mean).alias(mean_col),
        F.when(n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1))).alias(std_col))


def slot_moments(df: DataFrame, by: str = "asset_symbol", ts: str = "ingested_at",
                 value: str = "current_price", grid: int = SLOT) -> DataFrame:
    """Summary of each group ``(slot_end - grid, slot_end]`` of a key: ``newest``
    time (micros), count ``n`` of the non-null values, their ``mean`` and ``m2``
    (sum of squared deviations).  Summaries of parts of a group can be merged, so
    they can be stored (:mod:`tidewatch.sources.moments`)."""
    t = ntz_micros(ts)
    rows = (df.where(F.col(by).isNotNull() & F.col(ts).isNotNull())
            .select(by, t.alias("_t"), ceil_to_grid_micros(t, grid).alias("slot_end"),
                    F.col(value).cast("double").alias("_v")))
    return rows.groupBy(by, "slot_end").agg(
        F.max("_t").alias("newest"),
        F.count("_v").alias("n"),
        F.coalesce(F.avg("_v"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop("_v") * F.count("_v"), F.lit(0.0)).alias("m2"))


def baseline_at_grid(df: DataFrame, by: str = "asset_symbol",
                     ts: str = "ingested_at", value: str = "current_price",
                     frame: int = FRAME, grid: int = SLOT,
                     point_col: str = "grid_point", mean_col: str = "baseline_mean",
                     std_col: str = "baseline_stddev", moments: DataFrame | None = None,
                     points: DataFrame | None = None) -> DataFrame:
    """Moving stats at the newest row of each grid group only.

    Group ``e`` holds the rows with ``ts`` in ``(e - grid, e]`` (``e`` on the
    grid), so the newest row of group ``e`` is exactly the row an as-of join
    picks for a probe time ``e``.  For that row (time ``t_p``) the frame
    ``[t_p - frame, t_p]`` is: its whole own group, the ``frame/grid - 1``
    groups before it in full, and the rows of group ``e - frame`` from
    ``t_p - frame`` on.  So only that low edge needs the rows, through an
    equi-join with one probe per (key, group) and a partial aggregate;
    everything else is a partially aggregated group summary.  Output: one row per (key, group) with
    ``point_col`` (TIMESTAMP_NTZ of ``e``) and the frame's mean and stddev.

    ``moments``: the group summaries (:func:`slot_moments`), when they are stored;
    then ``df`` need only hold the rows of the low edges.  ``points``
    (key, ``slot_end``): only these groups are scored.
    """
    if frame % grid:
        raise ValueError("frame must be a whole number of grid steps")
    m = frame // grid
    t = ntz_micros(ts)
    rows = (df.where(F.col(by).isNotNull() & F.col(ts).isNotNull())
            .select(F.col(by).alias("_by"), t.alias("_t"), ceil_to_grid_micros(t, grid).alias("_e"),
                    F.col(value).cast("double").alias("_v")))

    # own group, whole (its newest row is the one scored)
    if moments is None:
        moments = slot_moments(df, by, ts, value, grid)
    groups = moments.select(
        F.col(by).alias("_by"), F.col("slot_end").alias("_e"), F.col("newest").alias("_tp"),
        F.col("n").alias("_own_n"), F.col("mean").alias("_own_mean"), F.col("m2").alias("_own_m2"))

    # the m-1 groups before, pooled; per (key, day) with a halo of m-1 groups
    groups = _day_buckets(groups, "_e", (m - 1) * grid)
    wm = (Window.partitionBy("_by", "_bk").orderBy("_e")
          .rangeBetween(-(m - 1) * grid, -grid))
    part = F.struct(F.col("_own_n").alias("n"), F.col("_own_mean").alias("mean"))
    pooled = groups.select(
        "*",
        F.sum("_own_n").over(wm).alias("_mid_n"),
        F.sum(F.col("_own_n") * F.col("_own_mean")).over(wm).alias("_s"),
        F.sum("_own_m2").over(wm).alias("_w2"),
        F.collect_list(part).over(wm).alias("_parts"))
    mid_mean = F.try_divide(F.col("_s"), F.col("_mid_n").cast("double"))
    pooled = pooled.where(F.col("_bk") == F.col("_hb")).select(
        "_by", "_e", "_tp", "_own_n", "_own_mean", "_own_m2",
        F.coalesce(F.col("_mid_n"), F.lit(0)).alias("_mid_n"),
        F.coalesce(mid_mean, F.lit(0.0)).alias("_mid_mean"),
        F.coalesce(F.col("_w2") + F.expr(_SPREAD.format(m="try_divide(_s, CAST(_mid_n AS DOUBLE))")),
                   F.lit(0.0)).alias("_mid_m2"))

    if points is not None:
        pooled = pooled.join(points.select(F.col(by).alias("_by"), F.col("slot_end").alias("_e")),
                             ["_by", "_e"], "left_semi")

    # low edge: rows of group e - frame with ts >= t_p - frame.  Each group
    # receives exactly one probe, so this is an equi-join on (key, group) plus
    # a filter and a partial aggregate — no window and no sort.  The probe
    # table has one row per (key, group): AQE broadcasts it when its measured
    # size allows, and then the snapshot rows are not shuffled at all.
    probes = pooled.select("_by", (F.col("_e") - frame).alias("_g"),
                           (F.col("_tp") - frame).alias("_p"),
                           F.col("_e").alias("_home"))
    edge = (rows.withColumnRenamed("_e", "_g").join(probes, ["_by", "_g"])
            .where(F.col("_t") >= F.col("_p"))
            .groupBy("_by", F.col("_home").alias("_e"))
            .agg(F.count("_v").alias("_suf_n"),
                 F.coalesce(F.avg("_v"), F.lit(0.0)).alias("_suf_mean"),
                 F.coalesce(F.var_pop("_v") * F.count("_v"), F.lit(0.0)).alias("_suf_m2")))

    joined = pooled.join(edge, ["_by", "_e"], "left").fillna(
        0, subset=["_suf_n"]).fillna(0.0, subset=["_suf_mean", "_suf_m2"])
    n, mean, m2 = _combine(["_own", "_mid", "_suf"])
    return joined.select(
        F.col("_by").alias(by),
        micros_to_ntz(F.col("_e")).alias(point_col),
        F.when(n > 0, mean).alias(mean_col),
        F.when(n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1))).alias(std_col))


def moving_stats(df: DataFrame, form: str = "sliced", **kw) -> DataFrame:
    return {"plain": moving_stats_plain, "halo": moving_stats_halo,
            "sliced": moving_stats_sliced}[form](df, **kw)
