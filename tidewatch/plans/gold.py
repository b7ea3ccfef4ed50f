"""Gold anomaly plan: VWAP windows ⟕as-of⟕ moving baseline → z-score → flag.

``score_windows`` is a pure DataFrame plan (no action).  ``run_gold`` upserts
it into the day-partitioned gold table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.time import (
    MICROS_PER_DAY, MICROS_PER_MINUTE, ceil_to_grid_micros, floor_to_grid_micros, micros_to_ntz, ntz_micros,
)
from tidewatch.operators.asof import asof_join
from tidewatch.operators.baseline import FRAME, SLOT, baseline_at_grid, moving_stats
from tidewatch.operators.score import DEFAULT_THRESHOLD, usable_baseline, with_zscore
from tidewatch.operators.vwap import tumbling_vwap

WINDOW_MINUTES = 10
GOLD_KEYS = ["asset_symbol", "window_start"]
GOLD_COLS = ["asset_symbol", "window_start", "window_end", "vwap", "volume",
             "trade_count", "baseline_mean", "baseline_stddev", "z_score",
             "is_anomaly"]


def baseline(snapshots: DataFrame, form: str = "sliced", frame: int = FRAME,
             slot: int = SLOT) -> DataFrame:
    """Per snapshot: moving mean and stddev of ``current_price`` over the
    preceding six hours (inclusive)."""
    s = snapshots.select("asset_symbol", "ingested_at", "current_price")
    kw = {"frame": frame}
    if form == "sliced":
        kw["slot"] = slot
    return moving_stats(s, form=form, by="asset_symbol", ts="ingested_at",
                        value="current_price", **kw)


def windows_with_baseline(trades: DataFrame, snapshots: DataFrame,
                          baseline_form: str = "grid",
                          asof_form: str = "bucketed",
                          exact_decimal: bool = False,
                          window_minutes: int = WINDOW_MINUTES,
                          moments: DataFrame | None = None,
                          points: DataFrame | None = None) -> DataFrame:
    """VWAP windows with the baseline of the newest snapshot at or before the
    window end.

    ``baseline_form="grid"`` (default): baselines are computed only for the
    newest snapshot of each window-end grid group
    (:func:`~tidewatch.operators.baseline.baseline_at_grid`); the as-of join
    then runs between two tables of at most assets x grid points rows,
    carried forward per (asset, day).  ``moments`` and ``points`` are those of
    ``baseline_at_grid``.  Other forms compute a baseline for every snapshot first.
    """
    w = tumbling_vwap(trades, width=f"{window_minutes} minutes",
                      exact_decimal=exact_decimal)
    if baseline_form == "grid":
        b = baseline_at_grid(
            snapshots.select("asset_symbol", "ingested_at", "current_price"),
            grid=window_minutes * MICROS_PER_MINUTE, moments=moments, points=points)
        # already one row per (asset, grid point): no further reduction
        return asof_join(w, b, by="asset_symbol", left_ts="window_end",
                         right_ts="grid_point",
                         payload=["baseline_mean", "baseline_stddev"],
                         form=asof_form)
    b = baseline(snapshots, form=baseline_form)
    kw = {}
    if asof_form == "bucketed":
        # window ends lie on the window grid: reduce snapshots to one per point
        kw["right_grid"] = window_minutes * MICROS_PER_MINUTE
    return asof_join(w, b, by="asset_symbol", left_ts="window_end",
                     right_ts="ingested_at",
                     payload=["baseline_mean", "baseline_stddev"],
                     form=asof_form, **kw)


def ntz_literal_micros(value) -> int:
    """Microseconds since the epoch of a naive (UTC wall-clock) datetime, an
    aware datetime, or an int already in micros."""
    if isinstance(value, int):
        return value
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (value - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def score_windows(trades: DataFrame, snapshots: DataFrame,
                  threshold: float = DEFAULT_THRESHOLD, **kw) -> DataFrame:
    """Scored windows with a usable baseline (``stddev > 0``)."""
    j = windows_with_baseline(trades, snapshots, **kw)
    return with_zscore(usable_baseline(j), threshold=threshold).select(*GOLD_COLS)


def rescoring_cuts(trade_lows: DataFrame, snapshot_lows: DataFrame,
                   window_minutes: int = WINDOW_MINUTES) -> DataFrame:
    """``asset_symbol``, ``cut``: for every asset with new rows, the smallest
    window end (micros) whose score they can change.

    ``*_lows``: ``asset_symbol``, ``low`` = the oldest trade time, or snapshot
    time, among the asset's new rows.  A trade changes the window it lies in;
    a snapshot at ``t`` is picked by, or lies in the frame of, windows ending
    at or after ``t`` only."""
    grid = window_minutes * MICROS_PER_MINUTE
    low = ntz_micros("low")
    ends = trade_lows.where("low is not null").select(
        "asset_symbol", (floor_to_grid_micros(low, grid) + grid).alias("_end")).unionByName(
        snapshot_lows.where("low is not null").select(
            "asset_symbol", ceil_to_grid_micros(low, grid).alias("_end")))
    return ends.groupBy("asset_symbol").agg(F.min("_end").alias("cut"))


def score_touched(trades: DataFrame, snapshots: DataFrame, cuts: DataFrame,
                  window_minutes: int = WINDOW_MINUTES, frame: int = FRAME, **kw) -> DataFrame:
    """Exactly the rows of :func:`score_windows` with ``window_end >= cut`` of
    their asset (:func:`rescoring_cuts`), reading only what they depend on.

    An asset needs its trades from one window before its cut on, and its
    snapshots from one frame before the earliest snapshot that a window may
    pick: its newest one at or before the cut, however old.  Assets without a
    cut are not read, so an idle asset does not widen the others' range.  The
    smallest of the bounds is also a literal on the time column, which the
    scans use to skip files and row groups."""
    grid = window_minutes * MICROS_PER_MINUTE
    cuts = cuts.select(F.col("asset_symbol").alias("_a"), F.col("cut").alias("_cut"))
    t, s = ntz_micros("trade_time"), ntz_micros("ingested_at")
    newest = (snapshots.select("asset_symbol", "ingested_at")
              .join(cuts, F.col("asset_symbol") == F.col("_a"))
              .where(s <= F.col("_cut")).groupBy("_a").agg(F.max(s).alias("_last")))
    lows = cuts.join(newest, "_a", "left").select(
        "_a", "_cut",
        (F.coalesce(ceil_to_grid_micros(F.col("_last"), grid), F.col("_cut")) - frame - grid)
        .alias("_low"))
    bounds = lows.agg(F.min("_cut"), F.min("_low")).first()  # two numbers
    if bounds[0] is None:
        return score_windows(trades.where(F.lit(False)), snapshots.where(F.lit(False)),
                             window_minutes=window_minutes, **kw)
    first_trade, first_snapshot = (micros_to_ntz(F.lit(x)) for x in (bounds[0] - grid, bounds[1]))
    some_trades = (trades.where(F.col("trade_time") >= first_trade)
                   .join(cuts, F.col("asset_symbol") == F.col("_a"))
                   .where(t >= F.col("_cut") - grid).select(*trades.columns))
    some_snapshots = (snapshots.where(F.col("ingested_at") > first_snapshot)
                      .join(lows, F.col("asset_symbol") == F.col("_a"))
                      .where(s > F.col("_low")).select(*snapshots.columns))
    # the first window of an asset may miss trades; it ends before the cut
    out = score_windows(some_trades, some_snapshots, window_minutes=window_minutes, **kw)
    return (out.join(cuts, F.col("asset_symbol") == F.col("_a"))
            .where(ntz_micros("window_end") >= F.col("_cut")).select(*out.columns))


def score_windows_since(trades: DataFrame, snapshots: DataFrame, since,
                        window_minutes: int = WINDOW_MINUTES,
                        frame: int = FRAME, **kw) -> DataFrame:
    """The rows of :func:`score_windows` whose ``window_end >= since``
    (``since`` floored to the window grid), for every asset: what changes
    when all new rows are *timed* at or after ``since``.  New rows that may be
    older (late arrivals) need :func:`score_touched`."""
    grid = window_minutes * MICROS_PER_MINUTE
    cut = (ntz_literal_micros(since) // grid) * grid
    assets = trades.select("asset_symbol").where("asset_symbol is not null").distinct()
    return score_touched(trades, snapshots, assets.withColumn("cut", F.lit(cut)),
                         window_minutes, frame, **kw)


_LAST = (1 << 63) - 1


def changed_windows(trade_lows: DataFrame, slot: int, window_minutes: int = WINDOW_MINUTES) -> DataFrame:
    """``asset_symbol``, ``window_end`` (micros): windows that meet the slots of
    ``slot`` micros beginning at ``low``."""
    grid, low = window_minutes * MICROS_PER_MINUTE, ntz_micros("low")
    ends = F.sequence(floor_to_grid_micros(low, grid) + grid,
                      floor_to_grid_micros(low + (slot - 1), grid) + grid, F.lit(grid).cast("long"))
    return trade_lows.where("low is not null").select(
        "asset_symbol", F.explode(ends).alias("window_end")).distinct()


def score_changed(trades: DataFrame, snapshots: DataFrame, windows: DataFrame, cuts: DataFrame,
                  newest: DataFrame, window_minutes: int = WINDOW_MINUTES, frame: int = FRAME,
                  moments: DataFrame | None = None, **kw) -> DataFrame:
    """Exactly the rows of :func:`score_windows` for ``windows``
    (:func:`changed_windows`) and for all windows of an asset from its ``cut`` on
    (:func:`rescoring_cuts` of new snapshots), reading only what they depend on.

    Trades: those of the windows, and from a cut on.  Snapshots of an asset: from
    one frame before the earliest snapshot that one of its windows may pick, to
    its last window.  That snapshot comes from ``newest`` (``asset_symbol``,
    ``last``: the newest snapshot of each day), not from the snapshots: the newest
    day's last one at or before the asset's first window end, or the beginning of
    that window end's day.  ``newest`` may lack snapshots that lie less than a
    window before the first window end or after it (of a merge that is not
    closed): those are read anyway.

    With ``moments`` (stored group summaries, :mod:`tidewatch.sources.moments`; their
    groups must be the windows' grid), only the groups at the low edges of the frames
    are read of the snapshots; when no snapshot is new, only those of the picked ones."""
    grid = window_minutes * MICROS_PER_MINUTE
    windows = windows.select(F.col("asset_symbol").alias("_a"), F.col("window_end").alias("_e"))
    cuts = cuts.select(F.col("asset_symbol").alias("_a"), F.col("cut").alias("_cut"))
    spans = (windows.select("_a", F.col("_e").alias("_first"), F.col("_e").alias("_last"))
             .unionByName(cuts.select("_a", F.col("_cut").alias("_first"),
                                      F.lit(_LAST).alias("_last")))
             .groupBy("_a").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last")))
    day = F.floor(F.col("_first") / MICROS_PER_DAY).cast("long") * MICROS_PER_DAY
    last = ntz_micros("last")
    picks = (newest.join(spans.select("_a", "_first"), F.col("asset_symbol") == F.col("_a"))
             .groupBy("_a").agg(
                 F.max(F.when(last <= F.col("_first"), last)).alias("_pick"),
                 F.max(F.when(F.floor(last / MICROS_PER_DAY) * MICROS_PER_DAY == day, day))
                 .alias("_day")))
    pick = F.coalesce(F.col("_pick"), F.col("_day"), F.col("_first") - grid)
    spans = spans.join(picks, "_a", "left").select(
        "_a", "_first", "_last",
        (ceil_to_grid_micros(F.least(pick, F.col("_first")), grid) - frame - grid).alias("_low"))
    bounds = spans.agg(F.min("_first"), F.min("_low"), F.max("_last")).first()  # three numbers
    if bounds[0] is None:
        return score_windows(trades.where(F.lit(False)), snapshots.where(F.lit(False)),
                             window_minutes=window_minutes, **kw)

    def within(df: DataFrame, ts: str, low: int) -> DataFrame:
        """Literal bounds, which the scan uses to skip files and row groups."""
        df = df.where(F.col(ts) >= micros_to_ntz(F.lit(low)))
        return df if bounds[2] == _LAST else df.where(F.col(ts) <= micros_to_ntz(F.lit(bounds[2])))

    t = ntz_micros("trade_time")
    some_trades = (
        within(trades, "trade_time", bounds[0] - grid)
        .withColumn("_end", floor_to_grid_micros(t, grid) + grid)
        .join(windows.select(F.col("_a").alias("_w"), F.col("_e").alias("_hit")),
              (F.col("asset_symbol") == F.col("_w")) & (F.col("_end") == F.col("_hit")), "left")
        .join(cuts, F.col("asset_symbol") == F.col("_a"), "left")
        .where(F.col("_hit").isNotNull() | (t >= F.col("_cut") - grid))
        .select(*trades.columns))
    s = ntz_micros("ingested_at")
    if moments is not None:
        end = F.col("slot_end")
        moments = (moments.where(end > bounds[1])
                   .join(spans, F.col("asset_symbol") == F.col("_a"))
                   .where((end > F.col("_low")) & (end <= F.col("_last"))))
        if bounds[2] == _LAST:  # new snapshots: every group from the first pick on
            points = moments.where(end >= F.col("_low") + frame + grid)
        else:  # only what the windows pick
            points = asof_join(
                windows.select(F.col("_a").alias("asset_symbol"),
                               micros_to_ntz(F.col("_e")).alias("window_end")),
                moments.select("asset_symbol", "slot_end", micros_to_ntz(end).alias("_at")),
                by="asset_symbol", left_ts="window_end", right_ts="_at", payload=["slot_end"],
            ).where("slot_end is not null")
        moments = moments.drop(*spans.columns)
        points = points.select("asset_symbol", "slot_end").distinct()
        low, high = points.agg(F.min("slot_end"), F.max("slot_end")).first()  # two numbers
        low, high = (bounds[1], bounds[1]) if low is None else (low - frame - grid, high - frame)
        some_snapshots = low_edges(snapshots, low, high)
        return score_windows(some_trades, some_snapshots, window_minutes=window_minutes,
                             moments=moments, points=points, **kw)
    some_snapshots = within(snapshots, "ingested_at", bounds[1])
    if "part_day" in snapshots.columns:  # the day of ingested_at: whole folders are skipped
        some_snapshots = some_snapshots.where(
            F.col("part_day") >= F.to_date(micros_to_ntz(F.lit(bounds[1]))))
        if bounds[2] != _LAST:
            some_snapshots = some_snapshots.where(
                F.col("part_day") <= F.to_date(micros_to_ntz(F.lit(bounds[2]))))
    some_snapshots = (some_snapshots.join(spans, F.col("asset_symbol") == F.col("_a"))
                      .where((s > F.col("_low")) & (s <= F.col("_last")))
                      .select(*snapshots.columns))
    return score_windows(some_trades, some_snapshots, window_minutes=window_minutes, **kw)


def low_edges(snapshots: DataFrame, low: int, high: int) -> DataFrame:
    """Snapshots in ``(low, high]`` (micros), by literal bounds on time and day."""
    first, last = micros_to_ntz(F.lit(low)), micros_to_ntz(F.lit(high))
    out = snapshots.where((F.col("ingested_at") > first) & (F.col("ingested_at") <= last))
    if "part_day" in snapshots.columns:
        out = out.where((F.col("part_day") >= F.to_date(first)) & (F.col("part_day") <= F.to_date(last)))
    return out


def typed_gold(scored: DataFrame) -> DataFrame:
    """Gold table types: money as DECIMAL(38,8), z as DECIMAL(18,8).  The flag
    is computed from the unrounded double z; a |z| too large for
    DECIMAL(18,8) is stored as null instead of failing the job."""
    money = "decimal(38,8)"
    return scored.select(
        "asset_symbol", "window_start", "window_end",
        F.col("vwap").cast(money).alias("vwap"),
        F.col("volume").cast(money).alias("volume"),
        F.col("trade_count").cast("long").alias("trade_count"),
        F.col("baseline_mean").cast(money).alias("baseline_mean"),
        F.col("baseline_stddev").cast(money).alias("baseline_stddev"),
        F.col("z_score").try_cast("decimal(18,8)").alias("z_score"),
        "is_anomaly")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for hash comparison with an SQL oracle."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t in ("double", "float") or t.startswith("decimal"):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def gold_source(spark, layout, incremental: bool = False, window_minutes: int = WINDOW_MINUTES,
                moments: bool = False, **kw) -> DataFrame:
    """The typed gold rows of one run (pure plan): all windows, or the
    ``incremental`` ones that unconsumed notes of the journal touch, however old
    the merged rows are (:func:`score_changed`), with stored ``moments`` if asked for."""
    from tidewatch.plans import silver as SV
    from tidewatch.sources import journal
    from tidewatch.sources.tables import add_day

    kw = {"window_minutes": window_minutes, "exact_decimal": True} | kw
    if not incremental:
        scored = score_windows(SV.silver_trades_for_gold(spark, layout),
                               SV.silver_snapshots_for_gold(spark, layout), **kw)
    else:
        trade_lows = journal.lows_of(spark, layout, "silver_trades")
        snapshot_lows = journal.lows_of(spark, layout, "silver_snapshots")
        scored = score_lows(spark, layout, trade_lows, snapshot_lows, moments=moments, **kw)
    return add_day(typed_gold(scored), "window_start")


def score_lows(spark, layout, trade_lows: DataFrame, snapshot_lows: DataFrame,
               window_minutes: int = WINDOW_MINUTES, moments: bool = False, **kw) -> DataFrame:
    """The windows that new silver rows touch (:func:`silver.trade_changes`,
    :func:`silver.snapshot_changes`), scored from the silver tables, with the stored
    slot moments if asked for (ten-minute windows only, as their groups are)."""
    from tidewatch.plans import silver as SV
    from tidewatch.sources import moments as stored
    if moments and (window_minutes * MICROS_PER_MINUTE != SLOT or not stored.exists(spark, layout)):
        raise ValueError("slot moments are not stored for these windows; see sources/moments.py: start")
    return score_changed(
        SV.silver_trades_for_gold(spark, layout), SV.silver_snapshots_for_gold(spark, layout),
        changed_windows(trade_lows, SV.SLOT, window_minutes),
        rescoring_cuts(trade_lows.where(F.lit(False)), snapshot_lows, window_minutes),
        SV.read_newest(spark, layout), window_minutes,
        moments=stored.read(spark, layout) if moments else None, **kw)


def run_gold(spark, layout, staging: str, incremental: bool = False, **kw) -> dict:
    """Recompute from silver — all windows, or the ``incremental`` ones that
    merges have touched since the journal was last consumed
    (:func:`gold_source`) — then upsert into gold by (asset_symbol,
    window_start) and store how far the journal is consumed.

    The journal is read before silver, so what it calls settled is in the rows
    read; it is consumed after the rows are in gold, so a run that dies is made
    up for by the next one.  See :func:`upsert_rows` for the upsert."""
    from tidewatch.sources import journal

    marks = journal.settled(spark, layout)
    report = upsert_rows(spark, layout, gold_source(spark, layout, incremental, **kw), staging)
    journal.consume(spark, layout, marks)
    journal.compact(spark, layout)
    return report


def upsert_rows(spark, layout, rows: DataFrame, staging: str) -> dict:
    """Upsert typed gold rows (with their day) into the gold table.

    They are written to ``staging`` once; everything after reads them from
    there.  Affected days = their day partitions, which become literals of the
    gold scan.  The days' new content (kept target rows + source rows) is
    written to ``staging`` too and then swapped in with a dynamic day
    overwrite, so no plan overwrites a path it reads.  If the swap is
    interrupted, rerunning :func:`swap_in_staging` with the same staging folder
    finishes it; recomputing alone could lose kept-but-stale rows.

    As in the table merge of the reference, gold rows without a source row
    stay.  The report counts flagged rows whose z-score is too large for the
    stored type."""
    from tidewatch import schemas as S
    from tidewatch.sources.tables import DAY, with_day

    at, content = f"{staging}/rows", f"{staging}/content"
    schema = with_day(S.GOLD_ANOMALIES)
    rows.write.mode("errorifexists").partitionBy(DAY).parquet(at)
    source = spark.read.schema(schema).parquet(at)
    days = [r[0] for r in source.select(DAY).distinct().collect()]  # one per day
    if not days:
        return {"statusCode": 200, "days": 0, "z_not_stored": 0}
    gold_content(spark, layout, source, days).write.mode("errorifexists").option(
        "partitionOverwriteMode", "static").partitionBy(DAY).parquet(content)
    unstored = source.where("is_anomaly and z_score is null").count()
    return swap_in_staging(spark, layout, staging) | {"days": len(days), "z_not_stored": unstored}


def gold_content(spark, layout, source: DataFrame, days: list) -> DataFrame:
    """New content of the affected gold days (literal day filter on the scan)."""
    from tidewatch.operators.merge import merge_upsert
    from tidewatch.sources.tables import DAY, read_table

    target = read_table(spark, layout, "gold_anomalies")
    return merge_upsert(target.where(F.col(DAY).isin(days)), source, GOLD_KEYS)


def swap_in_staging(spark, layout, staging: str) -> dict:
    from tidewatch.sources.tables import overwrite_days, with_day
    from tidewatch import schemas as S
    staged = spark.read.schema(with_day(S.GOLD_ANOMALIES)).parquet(f"{staging}/content")
    overwrite_days(staged, layout.gold_anomalies)
    return {"statusCode": 200}
