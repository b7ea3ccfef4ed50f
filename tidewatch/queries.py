"""Registered queries (Spark) and their SQL oracles (DuckDB dialect).

Each query takes ``(spark, sf_dir)``, reads the driver tables in full and
returns a DataFrame; the oracle with the same key computes the same rows in
plain SQL over the same tables.  Computed columns carry the same alias on both
sides; floating values are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas as S
from tidewatch.operators.asof import asof_join
from tidewatch.operators.baseline import moving_stats
from tidewatch.operators.score import with_zscore
from tidewatch.operators.vwap import tumbling_vwap
from tidewatch.plans import gold as G
from tidewatch.session import scratch_path
from tidewatch.sources import testdata as TD

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TD.load(spark, sf_dir, "events")


# ---------------------------------------------------------------- SQL pieces
SQL_TRADES = """
trades AS (
  SELECT event_id AS trade_id,
         upper(event_type) || 'USDT' AS symbol,
         event_type AS asset_symbol,
         value AS price,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS DOUBLE) AS quantity,
         ts AS trade_time
  FROM events
)"""

SQL_SNAPS = """
snaps AS (
  SELECT event_type AS asset_symbol, value AS current_price, ts AS ingested_at
  FROM events
)"""

SQL_BASELINE = """
baseline AS (
  SELECT asset_symbol, ingested_at, current_price,
         avg(current_price) OVER w AS baseline_mean,
         stddev_samp(current_price) OVER w AS baseline_stddev
  FROM snaps
  WINDOW w AS (PARTITION BY asset_symbol ORDER BY ingested_at
               RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)
)"""

SQL_AGG = """
agg AS (
  SELECT asset_symbol,
         time_bucket(INTERVAL 10 MINUTE, trade_time) AS window_start,
         time_bucket(INTERVAL 10 MINUTE, trade_time) + INTERVAL 10 MINUTE AS window_end,
         sum(price * quantity) / sum(quantity) AS vwap,
         sum(quantity) AS volume,
         count(*) AS trade_count
  FROM trades GROUP BY 1, 2, 3
)"""

SQL_JOINED = """
joined AS (
  SELECT a.*, b.baseline_mean, b.baseline_stddev
  FROM agg a ASOF LEFT JOIN baseline b
    ON a.asset_symbol = b.asset_symbol AND a.window_end >= b.ingested_at
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SQL_GOLD_SELECT = """
SELECT asset_symbol, window_start, window_end,
       round(vwap, 6) AS vwap, round(volume, 6) AS volume, trade_count,
       round(baseline_mean, 6) AS baseline_mean,
       round(baseline_stddev, 6) AS baseline_stddev,
       round((vwap - baseline_mean) / baseline_stddev, 6) AS z_score,
       coalesce(abs((vwap - baseline_mean) / baseline_stddev) > 3, false) AS is_anomaly
FROM joined WHERE baseline_stddev > 0"""

GOLD_SQL = _with(SQL_TRADES, SQL_SNAPS, SQL_BASELINE, SQL_AGG, SQL_JOINED) + SQL_GOLD_SELECT


# ---------------------------------------------------------------- gold
def _gold(spark, sf_dir, **kw) -> DataFrame:
    ev = _events(spark, sf_dir)
    return G.rounded(G.score_windows(TD.trades(ev), TD.snapshots(ev), **kw))


@register("gold_anomalies", GOLD_SQL)
def gold_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-6 flagship: baselines only at the as-of-picked snapshots (grid
    form), as-of carry-forward over the grid tables."""
    return _gold(spark, sf_dir)


@register("gold_anomalies_sliced", GOLD_SQL)
def gold_anomalies_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-6 with a baseline for every snapshot (sliced form) and the
    grid-reduced, day-bucketed as-of join."""
    return _gold(spark, sf_dir, baseline_form="sliced", asof_form="bucketed")


@register("gold_anomalies_plain", GOLD_SQL)
def gold_anomalies_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-6 in the reference's shape — a baseline for every snapshot, then
    every window joined as-of to it — with the bounded forms: day buckets
    with a six-hour halo for the baseline, day-bucketed as-of with carry-in."""
    return _gold(spark, sf_dir, baseline_form="halo", asof_form="bucketed")


@register("gold_incremental_upsert", GOLD_SQL)
def gold_incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-6 incremental (bounded recompute): gold as it stood before the
    middle of the data span, upserted with an incremental run from that cut,
    equals the full recompute."""
    from tidewatch.functions.time import ntz_micros
    from tidewatch.operators.merge import merge_upsert
    ev = _events(spark, sf_dir)
    lo, hi = ev.agg(F.min(ntz_micros("ts")), F.max(ntz_micros("ts"))).first()
    cut = (lo + hi) // 2
    before = ev.where(ntz_micros("ts") < F.lit(cut))
    stale = G.score_windows(TD.trades(before), TD.snapshots(before)) \
        .where(ntz_micros("window_end") < F.lit(cut))
    fresh = G.score_windows_since(TD.trades(ev), TD.snapshots(ev), cut)
    return G.rounded(merge_upsert(stale, fresh, G.GOLD_KEYS))


def _sql_arrived(ctes: str, every: int, hours: int) -> str:
    """The same relation over the events that had arrived at the cut."""
    late = f"CASE WHEN event_id % {every} = 0 THEN {hours * 3_600_000_000} ELSE 0 END"
    return ctes.replace("FROM events", f"FROM events, cut WHERE epoch_us(ts) + {late} < c")


# as a full recompute merged into the same stale gold: rows never go
GOLD_LATE_SQL = f"""
WITH cut AS (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 AS c FROM events),
now_gold AS ({GOLD_SQL}),
stale AS ({_with(_sql_arrived(SQL_TRADES, 7, 10), _sql_arrived(SQL_SNAPS, 11, 3),
                 SQL_BASELINE, SQL_AGG, SQL_JOINED)} {SQL_GOLD_SELECT})
SELECT * FROM now_gold
UNION ALL
SELECT * FROM stale s WHERE NOT EXISTS (
  SELECT 1 FROM now_gold n
  WHERE n.asset_symbol = s.asset_symbol AND n.window_start = s.window_start)"""


@register("gold_incremental_late", GOLD_LATE_SQL)
def gold_incremental_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-6 incremental with late arrivals: every seventh trade arrives ten
    hours and every eleventh snapshot three hours after its own time.  Gold as
    it stood at a cut in *arrival* time, upserted with the windows that the
    rows arriving after it touch, equals the same gold upserted with a full
    recompute."""
    from tidewatch.functions.time import ntz_micros
    from tidewatch.operators.merge import merge_upsert
    ev = _events(spark, sf_dir)
    lo, hi = ev.agg(F.min(ntz_micros("ts")), F.max(ntz_micros("ts"))).first()
    cut = F.lit((lo + hi) // 2)
    trade, snap = ntz_micros(TD.trade_arrival()) < cut, ntz_micros(TD.snapshot_arrival()) < cut
    stale = G.score_windows(TD.trades(ev.where(trade)), TD.snapshots(ev.where(snap)))

    def lows(df: DataFrame, ts: str) -> DataFrame:
        return df.groupBy("asset_symbol").agg(F.min(ts).alias("low"))

    cuts = G.rescoring_cuts(lows(TD.trades(ev.where(~trade)), "trade_time"),
                            lows(TD.snapshots(ev.where(~snap)), "ingested_at"))
    fresh = G.score_touched(TD.trades(ev), TD.snapshots(ev), cuts)
    return G.rounded(merge_upsert(stale, fresh, G.GOLD_KEYS))


# ---------------------------------------------------------------- baseline
SQL_BASELINE_SELECT = """
SELECT asset_symbol, ingested_at, current_price,
       round(baseline_mean, 6) AS baseline_mean,
       round(baseline_stddev, 6) AS baseline_stddev
FROM baseline"""

BASELINE_SQL = _with(SQL_SNAPS, SQL_BASELINE) + SQL_BASELINE_SELECT


def _baseline(spark, sf_dir, form):
    s = TD.snapshots(_events(spark, sf_dir))
    return G.rounded(moving_stats(s, form=form))


@register("moving_baseline", BASELINE_SQL)
def moving_baseline(spark, sf_dir):
    """WIN-1/2 through the operator's default form (``moving_stats``: sliced,
    one 10-minute slot of one asset per task)."""
    s = TD.snapshots(_events(spark, sf_dir))
    return G.rounded(moving_stats(s))


@register("baseline_halo", BASELINE_SQL)
def baseline_halo(spark, sf_dir):
    """WIN-1/2, day buckets with a six-hour halo."""
    return _baseline(spark, sf_dir, "halo")


@register("baseline_sliced", BASELINE_SQL)
def baseline_sliced(spark, sf_dir):
    """WIN-1/2, ten-minute slots: prefix + merged middle + suffix."""
    return _baseline(spark, sf_dir, "sliced")


# ---------------------------------------------------------------- vwap
VWAP_SQL = _with(SQL_TRADES, SQL_AGG) + """
SELECT asset_symbol, window_start, window_end, round(vwap, 6) AS vwap,
       round(volume, 6) AS volume, trade_count FROM agg"""


@register("vwap_windows", VWAP_SQL)
def vwap_windows(spark, sf_dir):
    """AGG-1..4 in double precision."""
    return G.rounded(tumbling_vwap(TD.trades(_events(spark, sf_dir))))


# ---------------------------------------------------------------- as-of
ASOF_SQL = _with(SQL_TRADES, SQL_SNAPS, SQL_BASELINE, SQL_AGG, SQL_JOINED) + """
SELECT asset_symbol, window_start, window_end, trade_count,
       round(baseline_mean, 6) AS baseline_mean,
       round(baseline_stddev, 6) AS baseline_stddev
FROM joined"""


def _asof(spark, sf_dir, grid: bool):
    ev = _events(spark, sf_dir)
    w = tumbling_vwap(TD.trades(ev)).select(
        "asset_symbol", "window_start", "window_end", "trade_count")
    b = moving_stats(TD.snapshots(ev), form="sliced")
    kw = {"right_grid": 10 * 60 * 1_000_000} if grid else {}
    j = asof_join(w, b, "asset_symbol", "window_end", "ingested_at",
                  ["baseline_mean", "baseline_stddev"], form="bucketed", **kw)
    return G.rounded(j)


@register("asof_baseline", ASOF_SQL)
def asof_baseline(spark, sf_dir):
    """JON-3/4, WIN-3, FLT-4: general as-of (any left times) — union +
    carry-forward per (asset, day) with a carry-in table for earlier days;
    every window kept, matched or not."""
    return _asof(spark, sf_dir, grid=False)


@register("asof_bucketed", ASOF_SQL)
def asof_bucketed(spark, sf_dir):
    """JON-3 on grid times: snapshots first reduced to the newest per
    (asset, window-end point) by a map-side-combined aggregate."""
    return _asof(spark, sf_dir, grid=True)


# ---------------------------------------------------------------- z-score
ZSCORE_SQL = _with(SQL_TRADES, SQL_SNAPS, SQL_BASELINE, SQL_AGG, SQL_JOINED) + """
SELECT asset_symbol, window_start,
       round((vwap - baseline_mean) / nullif(baseline_stddev, 0), 6) AS z_score,
       coalesce(abs((vwap - baseline_mean) / nullif(baseline_stddev, 0)) > 3, false)
         AS is_anomaly
FROM joined"""


@register("zscore_flag", ZSCORE_SQL)
def zscore_flag(spark, sf_dir):
    """PRJ-9/10 on every window, including those without a usable baseline
    (null z → flag false; zero stddev → null z, no error)."""
    ev = _events(spark, sf_dir)
    j = G.windows_with_baseline(TD.trades(ev), TD.snapshots(ev))
    return G.rounded(with_zscore(j).select("asset_symbol", "window_start",
                                           "z_score", "is_anomaly"))


# ---------------------------------------------------------------- typing
from tidewatch.operators import projections as P  # noqa: E402
from tidewatch.operators.dedupe import dedupe_first  # noqa: E402
from tidewatch.operators.diagnostic import window_size_diagnostic  # noqa: E402
from tidewatch.operators.lag import lag_breaches as _lag_breaches  # noqa: E402
from tidewatch.operators.merge import merge_insert_only, merge_upsert  # noqa: E402
from tidewatch.sources.rejects import decode_records  # noqa: E402

SQL_SILVER_TRADES = """
SELECT event_id AS trade_id,
       upper(event_type) || 'USDT' AS symbol,
       upper(event_type) AS asset_symbol,
       CAST(CAST(value AS VARCHAR) AS DECIMAL(38,8)) AS price,
       CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS DECIMAL(38,8)) AS quantity,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS trade_time,
       user_id % 2 = 0 AS is_buyer_maker,
       ts AS ingested_at
FROM events"""


@register("silver_trades_typed", SQL_SILVER_TRADES)
def silver_trades_typed(spark, sf_dir):
    """PRJ-4/6/8, FUN-1/3/5/6/7: bronze text → silver types."""
    return P.type_trades(TD.bronze_trades(_events(spark, sf_dir)))


_MONEY = {"current_price": "value", "market_cap": "value * 1000.0",
          "fully_diluted_valuation": "value * 1100.0", "total_volume": "value * 10.0",
          "high_24h": "value + 1.0", "low_24h": "value - 1.0", "price_change_24h": "value - 2.0",
          "market_cap_change_24h": "value * 3.0", "circulating_supply": "value * 7.0",
          "total_supply": "value * 8.0", "max_supply": "value * 9.0", "ath": "value + 100.0",
          "atl": "value / 10.0"}
_PERCENT = {"price_change_percentage_24h": "value / 100.0",
            "market_cap_change_percentage_24h": "value / 50.0",
            "ath_change_percentage": "value / 200.0", "atl_change_percentage": "value / 4.0",
            "price_change_percentage_1h_in_currency": "value / 1000.0",
            "price_change_percentage_24h_in_currency": "value / 500.0",
            "price_change_percentage_7d_in_currency": "value / 20.0"}


def _sql_snapshots(source: str) -> str:
    """All silver snapshot columns over an ``events``-like relation."""
    money = ", ".join(f"CAST({x} AS DECIMAL(38,8)) AS {n}" for n, x in _MONEY.items())
    percent = ", ".join(f"CAST({x} AS DECIMAL(18,8)) AS {n}" for n, x in _PERCENT.items())
    return f"""
SELECT event_type AS id, event_type AS symbol, upper(event_type) AS asset_symbol,
       upper(event_type[1]) || lower(event_type[2:]) AS name,
       {money}, {percent},
       CAST(user_id % 100 + 1 AS INTEGER) AS market_cap_rank,
       ts - INTERVAL 30 DAY AS ath_date, date_trunc('second', ts) AS atl_date,
       date_trunc('millisecond', ts) AS last_updated, ts AS ingested_at
FROM {source}"""


@register("silver_snapshots_typed", _sql_snapshots("events"))
def silver_snapshots_typed(spark, sf_dir):
    """PRJ-5/7, FUN-2/5/8: snapshot typing, all columns."""
    return P.type_snapshots(TD.bronze_snapshots(_events(spark, sf_dir)))


@register("typing_rejects", """
SELECT event_id, CASE WHEN event_id % 19 = 0 THEN 'trade_id' WHEN event_id % 13 = 0 THEN 'price'
                      WHEN event_id % 17 = 0 THEN 'ingested_at' END AS reason
FROM events""")
def typing_rejects(spark, sf_dir):
    """SNK-4, FUN-5: rows with a bad price, a bad time or no key are set aside
    with a reason, the others are typed."""
    good, bad = P.quarantine_trades(TD.flawed_bronze_trades(_events(spark, sf_dir)))
    return good.select(F.col("trade_id").alias("event_id"),
                       F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("event_id", "reason"))


@register("legacy_column_fallback", """
SELECT event_id AS trade_id, ts AS ingested_at, event_id % 7 = 0 AS used_legacy
FROM events""")
def legacy_column_fallback(spark, sf_dir):
    """PRJ-8: ``COALESCE(ingested_at, _ingested_at)``."""
    b = TD.bronze_trades(_events(spark, sf_dir))
    return b.select("trade_id", P.ingest_time().alias("ingested_at"),
                    F.col("ingested_at").isNull().alias("used_legacy"))


@register("normalize_raw_trades", """
SELECT event_id AS trade_id, upper(event_type) || 'USDT' AS symbol,
       CAST(value AS VARCHAR) AS price,
       CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS VARCHAR) AS quantity,
       epoch_us(ts) // 1000 AS trade_time, user_id % 2 = 0 AS is_buyer_maker
FROM events""")
def normalize_raw_trades(spark, sf_dir):
    """SRC-8, FLT-1, PRJ-1: envelope unwrap, event-type filter, renames."""
    raw = P.parse_raw_events(TD.raw_trade_events(_events(spark, sf_dir)))
    return P.normalize_trades(P.keep_trade_events(raw))


@register("partition_key", """
SELECT event_id AS trade_id, upper(event_type) || 'USDT-' || event_id AS partition_key
FROM events""")
def partition_key_query(spark, sf_dir):
    """PRJ-2, FUN-13: ``symbol-tradeId`` distribution key, hash-partitioned on it."""
    t = TD.trades(_events(spark, sf_dir))
    return P.with_partition_key(t, spark.sparkContext.defaultParallelism).select(
        "trade_id", "partition_key")


# ---------------------------------------------------------------- merges
SQL_MERGE_ROLES = """
mx AS (SELECT max(trade_id) AS m FROM trades),
target AS (SELECT t.* FROM trades t, mx WHERE t.trade_id * 10 < mx.m * 6),
source AS (SELECT t.* REPLACE (price + 1 AS price) FROM trades t, mx
           WHERE t.trade_id * 10 >= mx.m * 4)"""


def _trade_roles(spark, sf_dir):
    t = TD.trades(_events(spark, sf_dir)).select(
        "trade_id", "symbol", "asset_symbol", "price", "quantity", "trade_time")
    return TD.merge_roles(t, id_col="trade_id", value_col="price")


@register("merge_insert_only_single", _with(SQL_TRADES, SQL_MERGE_ROLES) + """
SELECT * FROM target
UNION ALL
SELECT * FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.trade_id = s.trade_id)""")
def merge_insert_only_single(spark, sf_dir):
    """JON-1: insert-only merge on ``trade_id``."""
    target, source = _trade_roles(spark, sf_dir)
    return merge_insert_only(target, source, ["trade_id"])


@register("merge_upsert", _with(SQL_TRADES, SQL_MERGE_ROLES) + """
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM source s WHERE s.asset_symbol = t.asset_symbol AND s.trade_id = t.trade_id)
UNION ALL
SELECT * FROM source""")
def merge_upsert_query(spark, sf_dir):
    """JON-5: upsert on a composite key; target-only rows kept."""
    target, source = _trade_roles(spark, sf_dir)
    return merge_upsert(target, source, ["asset_symbol", "trade_id"])


@register("merge_source_dedup", _with(SQL_TRADES, SQL_MERGE_ROLES) + """,
replayed AS (
  SELECT *, 0 AS seq FROM source
  UNION ALL
  SELECT * REPLACE (price + 100 AS price), 1 AS seq FROM source WHERE trade_id % 10 = 1),
firsts AS (
  SELECT * EXCLUDE (rn, seq) FROM (
    SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY seq) AS rn FROM replayed)
  WHERE rn = 1)
SELECT * FROM target
UNION ALL
SELECT * FROM firsts s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.trade_id = s.trade_id)""")
def merge_source_dedup(spark, sf_dir):
    """JON-6 + JON-1: repeats inside the source removed (first wins), then merged."""
    target, source = _trade_roles(spark, sf_dir)
    replayed = TD.with_replays(source, id_col="trade_id", value_col="price")
    firsts = dedupe_first(replayed, ["trade_id"], ["seq"]).drop("seq")
    return merge_insert_only(target, firsts, ["trade_id"])


SQL_SNAP_ROLES = """
mx AS (SELECT max(event_id) AS m FROM events),
snap_t AS (SELECT e.* FROM events e, mx WHERE e.event_id * 10 < mx.m * 6),
snap_s AS (SELECT e.* REPLACE (value + 1 AS value) FROM events e, mx
           WHERE e.event_id * 10 >= mx.m * 4),
typed_t AS (""" + _sql_snapshots("snap_t") + """),
typed_s AS (""" + _sql_snapshots("snap_s") + """)"""


@register("merge_insert_only_composite", _with(SQL_SNAP_ROLES) + """
SELECT * FROM typed_t
UNION ALL
SELECT * FROM typed_s s WHERE NOT EXISTS (
  SELECT 1 FROM typed_t t WHERE t.id = s.id AND t.last_updated = s.last_updated)""")
def merge_insert_only_composite(spark, sf_dir):
    """JON-2: insert-only merge of typed snapshots on ``(id, last_updated)``."""
    t_ev, s_ev = TD.merge_roles(_events(spark, sf_dir))
    target = P.type_snapshots(TD.bronze_snapshots(t_ev))
    source = P.type_snapshots(TD.bronze_snapshots(s_ev))
    return merge_insert_only(target, source, ["id", "last_updated"])


# ---------------------------------------------------------------- decimal VWAP
@register("vwap_decimal", """
WITH typed AS (
  SELECT upper(event_type) AS asset_symbol,
         make_timestamp((epoch_us(ts) // 1000) * 1000) AS trade_time,
         CAST(CAST(value AS DECIMAL(18,2)) * 100 AS HUGEINT) * 1000000
           + (event_id * 104729) % 1000000 AS p,
         CASE WHEN event_id % 5 = 0 THEN CAST(20000000000 + event_id AS HUGEINT) * 100000000
              ELSE 0 END + (event_id * 7919) % 100000000 AS q
  FROM events)
SELECT asset_symbol, time_bucket(INTERVAL 10 MINUTE, trade_time) AS window_start,
       CAST((2 * sum(p * q) + sum(q)) // (2 * sum(q)) AS VARCHAR) AS vwap_e8,
       CAST(sum(q) AS VARCHAR) AS volume_e8, count(*) AS trade_count
FROM typed GROUP BY 1, 2""")
def vwap_decimal(spark, sf_dir):
    """AGG-2 with T1: exact decimal VWAP from silver-typed trades with
    eight-digit prices, tiny quantities and quantities above 1e10; compared to
    the last of the eight digits (as units of 1e-8)."""
    typed = P.type_trades(TD.fine_bronze_trades(_events(spark, sf_dir)))
    return _units_of_1e8(tumbling_vwap(typed, exact_decimal=True))


def _units_of_1e8(w: DataFrame) -> DataFrame:
    def units(c: str):
        return F.replace(F.col(c).cast("string"), F.lit("."), F.lit("")).cast(
            "decimal(38,0)").cast("string").alias(f"{c}_e8")

    return w.select("asset_symbol", "window_start", units("vwap"), units("volume"), "trade_count")


@register("vwap_partials_merged", ORACLES["vwap_decimal"])
def vwap_partials_merged(spark, sf_dir):
    """AGG-1..4 incrementally: trades arrive in four batches that share all
    windows; the first two are folded into a base, the third comes after the
    fourth and is sent twice, and a late replay of the first adds nothing.  The
    stored sums give the exact VWAP without a second look at any trade."""
    from tidewatch.operators.vwap import add_partials, vwap_of_partials, window_partials
    from tidewatch.sources.partials import PartialStore
    typed = P.type_trades(TD.fine_bronze_trades(_events(spark, sf_dir)))
    part = F.pmod("trade_id", F.lit(4))
    batches = [window_partials(typed.where(part == i)) for i in range(4)]
    store = PartialStore(spark, scratch_path(spark, "partials"), batches[0].schema, add_partials)
    for number in (0, 1):
        store.add(number, batches[number])
    store.fold(1)
    for number in (3, 2, 2, 0):
        store.add(number, batches[number])
    return _units_of_1e8(vwap_of_partials(store.rows()))


# ---------------------------------------------------------------- diagnostic
@register("window_size_diagnostic", _with(SQL_TRADES) + """,
sizes AS (SELECT unnest([5, 10, 15, 20]) AS window_minutes),
counts AS (
  SELECT window_minutes, asset_symbol,
         floor(epoch_us(trade_time) / (window_minutes * 60000000)) AS b, count(*) AS n
  FROM trades, sizes GROUP BY ALL),
edges AS (SELECT window_minutes, asset_symbol, min(b) AS lo, max(b) AS hi
          FROM counts GROUP BY ALL)
SELECT c.window_minutes, c.asset_symbol, min(n) AS min_trades,
       round(avg(n), 6) AS avg_trades, max(n) AS max_trades, count(*) AS windows
FROM counts c JOIN edges e USING (window_minutes, asset_symbol)
WHERE b > lo AND b < hi GROUP BY ALL""")
def window_size_diagnostic_query(spark, sf_dir):
    """AGG-5, WIN-4."""
    return G.rounded(window_size_diagnostic(TD.trades(_events(spark, sf_dir))))


# ---------------------------------------------------------------- lag report
@register("lag_breaches", """
WITH t AS (SELECT ts AS trade_time, ts + to_seconds(user_id) AS arrived_at
           FROM events),
per AS (SELECT date_trunc('minute', arrived_at) AS minute,
               max((epoch_us(arrived_at) - epoch_us(trade_time)) // 1000) AS max_lag_ms
        FROM t GROUP BY 1),
b AS (SELECT * FROM per WHERE max_lag_ms > 60000)
SELECT cur.minute, cur.max_lag_ms, prev.max_lag_ms AS prev_max_lag_ms
FROM b cur JOIN b prev ON prev.minute = cur.minute - INTERVAL 1 MINUTE""")
def lag_breaches_query(spark, sf_dir):
    """STR-7: two consecutive one-minute periods with max lag > 60 s."""
    return _lag_breaches(TD.trade_arrivals(_events(spark, sf_dir)))


# ---------------------------------------------------------------- dead letter
@register("dead_letter_split", """
WITH recs AS (
  SELECT event_id, 0 AS copy FROM events
  UNION ALL
  SELECT event_id, 1 AS copy FROM events WHERE event_id % 10 = 1)
SELECT printf('%012d-%d', event_id, copy) AS sequence_number,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id END AS trade_id,
       event_id % 11 = 0 AS is_rejected
FROM recs""")
def dead_letter_split(spark, sf_dir):
    """SNK-4, STR-5, SRC-7: undecodable records set aside, the rest go on."""
    d = decode_records(TD.stream_records(_events(spark, sf_dir)))
    return d.select("sequence_number", F.col("trade.trade_id").alias("trade_id"),
                    "is_rejected")


# ---------------------------------------------------------------- streaming
from tidewatch.sources.bronze import read_bronze_trades  # noqa: E402
from tidewatch.sources.tables import Layout  # noqa: E402
from tidewatch.streaming.ingest import read_records, start_ingest, stored_counters  # noqa: E402

SQL_LANDED = """
SELECT DISTINCT event_id AS trade_id, upper(event_type) || 'USDT' AS symbol,
       CAST(value AS VARCHAR) AS price,
       CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS VARCHAR) AS quantity,
       epoch_us(ts) // 1000 AS trade_time, user_id % 2 = 0 AS is_buyer_maker
FROM events WHERE event_id % 11 <> 0"""

def _stream_run(spark, sf_dir, sendings: list, fail_once: bool = False,
                ordered: bool = False, counters: bool = False) -> DataFrame:
    """Ingest ``sendings`` (records, arrival time) one after the other, each by
    a run of the same query; the first run may fail once after its good rows
    have landed.  Returns what has landed, or the stored batch counters."""
    root = scratch_path(spark, "stream")
    src, layout, ckpt = f"{root}/source", Layout(f"{root}/lake"), f"{root}/checkpoint"
    schema = T.StructType(S.STREAM_RECORD.fields + [T.StructField("arrived_at", T.StringType())])
    failed = []

    def fail(batch_id):
        if fail_once and not failed:
            failed.append(batch_id)
            raise RuntimeError("injected sink failure")

    def run():
        records = read_records(spark, src, schema=schema).withColumn(
            "arrived_at", F.to_timestamp("arrived_at"))
        start_ingest(spark, records, layout, ckpt, available_now=True, arrival_col="arrived_at",
                     between_writes=fail, ordered=ordered,
                     counters=stored_counters(spark, f"{root}/counters") if counters else None,
                     state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()

    for records, arrived_at in sendings:
        (records.drop("event_id").withColumn("arrived_at", F.lit(f"{arrived_at}+00:00"))
         .write.mode("append").json(src))
        try:
            run()
        except StreamingQueryException:
            if len(failed) != 1:
                raise
            run()
    if counters:
        return spark.read.schema("batch long, records long, rejected long, landed boolean, "
                                 "error string").json(f"{root}/counters")
    return _landed_trades(spark, layout)


def _landed_trades(spark, layout) -> DataFrame:
    return read_bronze_trades(spark, layout.bronze_trades).select(
        "trade_id", "symbol", "price", "quantity", "trade_time", "is_buyer_maker")


@register("stream_dedup_ttl", SQL_LANDED.replace("SELECT DISTINCT", "SELECT") + """
UNION ALL
SELECT event_id, upper(event_type) || 'USDT', CAST(CAST(value AS DECIMAL(18,2)) + 200 AS VARCHAR),
       CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS VARCHAR),
       epoch_us(ts) // 1000, user_id % 2 = 0
FROM events WHERE event_id % 10 = 1 AND event_id % 11 <> 0""")
def stream_dedup_ttl(spark, sf_dir):
    """JOB-7, STR-1/2/3/6, SNK-1/3/4: a repeat with another price one hour
    later is dropped (the first wins); once arrivals have run past the six
    hours, another repeat is accepted; malformed records go to rejects."""
    ev = _events(spark, sf_dir)
    part, again = F.col("event_id") % 5, F.col("event_id") % 10 == 1
    return _stream_run(spark, sf_dir, [
        (TD.stream_copy(ev.where(part < 3), 0), "2026-06-10T00:00:00"),
        (TD.stream_copy(ev.where(again), 1), "2026-06-10T01:00:00"),
        (TD.stream_copy(ev.where(part == 3), 0), "2026-06-10T13:00:00"),
        (TD.stream_copy(ev.where(part == 4), 0), "2026-06-10T13:10:00"),
        (TD.stream_copy(ev.where(again), 2), "2026-06-10T13:20:00")])


def _sql_counted(sending: int, rows: str, landed: bool) -> str:
    return f"""
SELECT {sending} AS sending, {landed} AS landed, {not landed} AS failed, count(*) AS records,
       count(*) FILTER (event_id % 11 = 0) AS rejected FROM events WHERE {rows}"""


@register("stream_batch_counters", " UNION ALL ".join([
    _sql_counted(1, "event_id % 5 < 3", False), _sql_counted(1, "event_id % 5 < 3", True),
    _sql_counted(2, "event_id % 5 >= 3", True)]))
def stream_batch_counters(spark, sf_dir):
    """AGG-6, SNK-3: stored counters of every attempt of a batch.  The first sending
    fails after part of its write and is replayed; the second holds all records, and
    those of the first are dropped before they are counted."""
    ev = _events(spark, sf_dir)
    told = _stream_run(spark, sf_dir, [
        (TD.stream_copy(ev.where(F.col("event_id") % 5 < 3), 0), "2026-06-10T00:00:00"),
        (TD.stream_copy(ev, 0), "2026-06-10T01:00:00")], fail_once=True, counters=True)
    first = told.agg(F.min("batch")).first()[0]  # one number
    return told.select(
        F.when(F.col("batch") == first, 1).otherwise(2).alias("sending"), "landed",
        F.col("error").isNotNull().alias("failed"), "records", "rejected")


@register("stream_first_wins_ordered", ORACLES["stream_dedup_ttl"])
def stream_first_wins_ordered(spark, sf_dir):
    """STR-1/2 with a defined winner: one micro-batch holds two differing copies
    of every trade in different files and the smaller sequence number wins;
    a repeat one microsecond before six hours is dropped, one at six hours is
    accepted."""
    ev = _events(spark, sf_dir)
    again = ev.where(F.col("event_id") % 10 == 1)
    return _stream_run(spark, sf_dir, [
        (TD.stream_copy(ev, 1).unionByName(TD.stream_copy(ev, 0)), "2026-06-10T00:00:00"),
        (TD.stream_copy(again, 3), "2026-06-10T05:59:59.999999"),
        (TD.stream_copy(again, 2), "2026-06-10T06:00:00")], ordered=True)


@register("stream_record_bounded", SQL_LANDED.replace("FROM events", ", true AS within_bound FROM events"))
def stream_record_bounded(spark, sf_dir):
    """SRC-6, STR-6: landed files of any size are cut into files of 500 records
    and no micro-batch of the ingest holds more; the shards of the cut stream are
    ingested side by side."""
    from tidewatch.streaming.ingest import (
        BATCH_RECORDS, SHARDS, await_all, start_sharded_ingest, start_split)
    root = scratch_path(spark, "bounded")
    layout, told = Layout(f"{root}/lake"), []
    TD.stream_copy(_events(spark, sf_dir), 0).drop("event_id").write.json(f"{root}/source")
    start_split(spark, f"{root}/source", f"{root}/cut", f"{root}/cut-checkpoint",
                available_now=True, shards=SHARDS).awaitTermination()
    await_all(start_sharded_ingest(
        spark, f"{root}/cut", layout, f"{root}/checkpoint", max_files_per_trigger=1,
        available_now=True, counters=lambda shard: told.append, state_partitions=1))
    bound = max((t["records"] for t in told), default=0) <= BATCH_RECORDS
    return _landed_trades(spark, layout).withColumn("within_bound", F.lit(bound))


@register("rejects_replay", """
SELECT printf('%012d-0', event_id) AS sequence_number,
       CASE WHEN event_id % 22 = 0 THEN 'landed' ELSE 'exhausted' END AS outcome,
       CASE WHEN event_id % 22 = 0 THEN 2 ELSE 3 END AS attempts,
       CASE WHEN event_id % 22 = 0 THEN 1 ELSE 0 END AS landed_rows,
       CASE WHEN event_id % 22 = 0 THEN CAST(value AS VARCHAR) END AS price
FROM events WHERE event_id % 11 = 0""")
def rejects_replay(spark, sf_dir):
    """SNK-4: rejected records are tried again.  The first run mends nothing, the
    second (sent twice) mends every other record, which lands once; the rest
    runs out of its three attempts, and a fourth run finds nothing to do."""
    import datetime as dt
    from tidewatch.sources.reject_replay import outcomes, replay_rejects
    from tidewatch.sources.rejects import split_bad
    ev, layout = _events(spark, sf_dir), Layout(scratch_path(spark, "replay"))
    bad = split_bad(decode_records(TD.stream_copy(ev, 0)))[1].drop("event_id")
    land_jsonl(bad.withColumn("ingested_at", F.lit("2026-06-10T00:00:00+00:00")),
               layout.bronze_rejects, "0")
    better = TD.stream_copy(ev.where(F.col("event_id") % 22 == 0), 0, mended=True).select(
        "sequence_number", F.col("data").alias("_better"))

    def mend(df: DataFrame) -> DataFrame:
        return df.join(better, "sequence_number", "left").withColumn(
            "data", F.coalesce("_better", "data")).drop("_better")

    for run, how in ((1, None), (2, mend), (2, mend), (3, None), (4, mend)):
        replay_rejects(spark, layout, run, dt.datetime(2026, 6, 10, run), how)
    last = outcomes(spark, layout).groupBy("sequence_number").agg(
        F.max_by("outcome", "attempt").alias("outcome"), F.max("attempt").alias("attempts"))
    landed = read_bronze_trades(spark, layout.bronze_trades).groupBy(
        F.format_string("%012d-0", F.col("trade_id")).alias("sequence_number")).agg(
        F.count(F.lit(1)).cast("int").alias("landed_rows"), F.max("price").alias("price"))
    return last.join(landed, "sequence_number", "left").select(
        "sequence_number", "outcome", "attempts",
        F.coalesce("landed_rows", F.lit(0)).alias("landed_rows"), "price")


@register("stream_retry_atomic", SQL_LANDED)
def stream_retry_atomic(spark, sf_dir):
    """STR-4: the sink fails after the good rows of the first batch landed and
    before its rejects did; the restarted query replays the batch with the old
    dedup state and every trade lands exactly once."""
    ev = _events(spark, sf_dir)
    return _stream_run(spark, sf_dir, [
        (TD.stream_copy(ev, 0), "2026-06-10T00:00:00"),
        (TD.stream_copy(ev.where(F.col("event_id") % 10 == 1), 1), "2026-06-10T01:00:00")],
        fail_once=True)


# ---------------------------------------------------------------- bronze / jobs
from tidewatch.plans import runner as R  # noqa: E402
from tidewatch.plans import silver as SV  # noqa: E402
from tidewatch.sources.bronze import hours_to_process, where_hours  # noqa: E402
from tidewatch.sources.landing import land_jsonl  # noqa: E402
from tidewatch.sources.tables import create_tables, read_table  # noqa: E402


def _land_bronze(spark, sf_dir, root: str, snapshots: bool = True,
                 trades: bool = True) -> Layout:
    """Land the bronze text forms as JSON lines under the hour partitions of
    their arrival stamp (one landing batch)."""
    ev = _events(spark, sf_dir)
    layout = Layout(root)
    stamp = F.coalesce(F.col("ingested_at"), F.col("_ingested_at"))
    tables = [(TD.bronze_trades(ev), layout.bronze_trades)] if trades else []
    if snapshots:
        tables.append((TD.bronze_snapshots(ev), layout.bronze_snapshots))
    for df, path in tables:
        land_jsonl(df.drop("year", "month", "day", "hour"), path, "backfill", stamp,
                   compression="gzip")
    return layout


SQL_LAST_TWO_HOURS = """
WITH t AS (
  SELECT event_id AS trade_id, upper(event_type) || 'USDT' AS symbol,
         CAST(value AS VARCHAR) AS price,
         strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
         strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
  FROM events),
m AS (SELECT max(ts) AS mx FROM events),
h AS (SELECT strftime(mx, '%Y') AS y, strftime(mx, '%m') AS mo,
             strftime(mx, '%d') AS d, strftime(mx, '%H') AS hr FROM m
      UNION ALL
      SELECT strftime(mx - INTERVAL 1 HOUR, '%Y'), strftime(mx - INTERVAL 1 HOUR, '%m'),
             strftime(mx - INTERVAL 1 HOUR, '%d'), strftime(mx - INTERVAL 1 HOUR, '%H') FROM m)
SELECT t.* FROM t JOIN h ON t.year = h.y AND t.month = h.mo AND t.day = h.d AND t.hour = h.hr"""


@register("hour_partition_filter", SQL_LAST_TWO_HOURS)
def hour_partition_filter(spark, sf_dir):
    """SRC-1/3/4, FLT-2, FUN-11, SNK-1, JOB-3: land bronze trades as JSON lines
    under string hour partitions, then read back only the latest hour of data
    and the hour before (partition-pruned scan)."""
    root = scratch_path(spark, "bronze")
    layout = _land_bronze(spark, sf_dir, root, snapshots=False)
    now = _events(spark, sf_dir).agg(F.max("ts")).first()[0]
    hours = hours_to_process(now)
    bronze = where_hours(read_bronze_trades(spark, layout.bronze_trades), hours)
    return bronze.select("trade_id", "symbol", "price", "year", "month", "day", "hour")


def _backfill(spark, sf_dir, trades: bool) -> DataFrame:
    """A backfill run twice, then an incremental run over the latest two hours:
    only the first may add rows."""
    layout = _land_bronze(spark, sf_dir, scratch_path(spark, "silver"), snapshots=not trades,
                          trades=trades)
    create_tables(spark, layout)
    inserted = []

    def merge(hours):
        job = SV.run_silver_trades if trades else SV.run_silver_snapshots
        inserted.append(job(spark, layout, hours))

    R.run({"backfill": True}, merge)
    R.run({"backfill": True}, merge)
    R.run({}, merge, now=_events(spark, sf_dir).agg(F.max("ts")).first()[0])
    if any(inserted[1:]):
        raise AssertionError(f"a repeated merge added rows: {inserted}")
    return read_table(spark, layout, "silver_trades" if trades else "silver_snapshots").drop(
        "part_day")


@register("silver_trades_backfill", SQL_SILVER_TRADES)
def silver_trades_backfill(spark, sf_dir):
    """JOB-2/4, JOB-1 mode switch: landed bronze trades merged into silver."""
    return _backfill(spark, sf_dir, trades=True)


@register("silver_snapshots_backfill", "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ("
          "PARTITION BY id, last_updated ORDER BY ingested_at, name, current_price) AS rn FROM ("
          + _sql_snapshots("events") + ")) WHERE rn = 1")
def silver_snapshots_backfill(spark, sf_dir):
    """JOB-2/5: landed bronze snapshots merged into silver on (id, last_updated)."""
    return _backfill(spark, sf_dir, trades=False)


SQL_GOLD_TYPED = _with(
    SQL_TRADES.replace("value AS price", "CAST(CAST(value AS VARCHAR) AS DECIMAL(38,8)) AS price")
              .replace("CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS DOUBLE)",
                       "CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS DECIMAL(38,8))")
              .replace("ts AS trade_time", "make_timestamp((epoch_us(ts) // 1000) * 1000) AS trade_time")
              .replace("event_type AS asset_symbol", "upper(event_type) AS asset_symbol"),
    SQL_SNAPS.replace("event_type AS asset_symbol", "upper(event_type) AS asset_symbol"),
    SQL_BASELINE,
    SQL_AGG.replace("sum(price * quantity) / sum(quantity) AS vwap",
                    "CAST(sum(price * quantity) / sum(quantity) AS DECIMAL(38,8)) AS vwap"),
    SQL_JOINED) + """
SELECT asset_symbol, window_start, window_end,
       CAST(vwap AS VARCHAR) AS vwap, CAST(CAST(volume AS DECIMAL(38,8)) AS VARCHAR) AS volume,
       trade_count, CAST(CAST(baseline_mean AS DECIMAL(38,8)) AS VARCHAR) AS baseline_mean,
       CAST(CAST(baseline_stddev AS DECIMAL(38,8)) AS VARCHAR) AS baseline_stddev,
       CAST(CAST((CAST(vwap AS DOUBLE) - baseline_mean) / baseline_stddev AS DECIMAL(18,8))
            AS VARCHAR) AS z_score,
       coalesce(abs((CAST(vwap AS DOUBLE) - baseline_mean) / baseline_stddev) > 3, false)
         AS is_anomaly
FROM joined WHERE baseline_stddev > 0"""


@register("gold_upsert_job", SQL_GOLD_TYPED)
def gold_upsert_job(spark, sf_dir):
    """JOB-5/6, JON-5, SNK-5/6, SRC-9 end to end: bronze → silver (trades and
    snapshots) → gold upsert, run twice; the gold table equals one full
    recompute."""
    root = scratch_path(spark, "gold")
    layout = _land_bronze(spark, sf_dir, root)
    create_tables(spark, layout)
    SV.run_silver_trades(spark, layout)
    SV.run_silver_snapshots(spark, layout)
    for i in range(2):
        G.run_gold(spark, layout, f"{root}/staging-{i}")
    from tidewatch.sources.tables import read_anomalies
    return _gold_text(read_anomalies(spark, layout))


def _gold_text(gold: DataFrame) -> DataFrame:
    """Decimals as text: all eight digits are compared."""
    return gold.withColumns({c: F.col(c).cast("string") for c, kind in gold.dtypes
                             if kind.startswith("decimal")})


class _MergeDied(Exception):
    pass


_SQL_GOLD_EARLY = SQL_GOLD_TYPED.replace(
    "ts AS ingested_at\n  FROM events", "ts AS ingested_at\n  FROM events WHERE event_id % 4 <> 2")
# gold rows never go: a window that late snapshots leave without a baseline keeps its old row
SQL_GOLD_LATE_TYPED = f"""
WITH now_gold AS ({SQL_GOLD_TYPED}),
before AS ({_SQL_GOLD_EARLY})
SELECT * FROM now_gold
UNION ALL
SELECT * FROM before b WHERE NOT EXISTS (
  SELECT 1 FROM now_gold n
  WHERE n.asset_symbol = b.asset_symbol AND n.window_start = b.window_start)"""


@register("gold_incremental_journal", SQL_GOLD_LATE_TYPED)
def gold_incremental_journal(spark, sf_dir):
    """JOB-4/5/6, JON-5 through the jobs and the change journal.  Every third
    trade and every fourth snapshot come late, all over history: the merge of
    those trades dies after its append (gold runs before and after the rerun),
    and a gold run falls into the middle of the merge of the snapshots."""
    return _gold_after_late_rows(spark, sf_dir)


@register("gold_incremental_moments", SQL_GOLD_LATE_TYPED)
def gold_incremental_moments(spark, sf_dir):
    """WIN-1/2 stored: the same runs with the slot moments that the snapshot merge
    keeps; the gold run inside that merge does not trust the open note's groups."""
    return _gold_after_late_rows(spark, sf_dir, moments=True)


def _gold_after_late_rows(spark, sf_dir, moments: bool = False) -> DataFrame:
    from tidewatch.sources.moments import start
    from tidewatch.sources.tables import read_anomalies
    root = scratch_path(spark, "journal")
    layout = Layout(f"{root}/lake")
    create_tables(spark, layout)
    ev = _events(spark, sf_dir)
    late_trade, late_snap = F.col("event_id") % 3 == 1, F.col("event_id") % 4 == 2
    runs = iter(range(10))

    def land(trades: DataFrame | None, snapshots: DataFrame | None, hour: int) -> None:
        stamp = F.lit(f"2026-06-10T{hour:02d}:05:00+00:00")  # all of a landing in one hour
        for df, path in ((trades, layout.bronze_trades), (snapshots, layout.bronze_snapshots)):
            if df is not None:
                land_jsonl(df.drop("year", "month", "day", "hour"), path, f"landing-{hour}", stamp,
                           compression="gzip", records_per_file=RECORDS_PER_FILE)

    def gold(incremental: bool = True) -> None:
        G.run_gold(spark, layout, f"{root}/staging-{next(runs)}", incremental,
                   moments=moments and incremental)

    def dies(step: str) -> None:
        if step == "appended":
            raise _MergeDied

    land(TD.bronze_trades(ev.where(~late_trade)), TD.bronze_snapshots(ev.where(~late_snap)), 14)
    SV.run_silver_trades(spark, layout)
    SV.run_silver_snapshots(spark, layout)
    if moments:
        start(spark, layout)
    gold(incremental=False)
    land(TD.bronze_trades(ev.where(late_trade)), None, 15)
    try:
        SV.run_silver_trades(spark, layout, step=dies)
    except _MergeDied:
        gold()
    SV.run_silver_trades(spark, layout)  # adds no row, closes the note
    land(None, TD.bronze_snapshots(ev.where(late_snap)), 16)
    SV.run_silver_snapshots(spark, layout, step=lambda step: gold() if step == "noted" else None)
    gold()
    return _gold_text(read_anomalies(spark, layout))


@register("baseline_stored_moments", _with(SQL_SNAPS, SQL_BASELINE) + """
SELECT asset_symbol, grid_point, round(b.m, 6) AS baseline_mean, round(b.s, 6) AS baseline_stddev
FROM (SELECT asset_symbol,
             make_timestamp(CAST(ceil(epoch_us(ingested_at) / 600000000.0) AS BIGINT) * 600000000)
               AS grid_point,
             arg_max({'m': baseline_mean, 's': baseline_stddev}, ingested_at) AS b
      FROM baseline GROUP BY 1, 2)""")
def baseline_stored_moments(spark, sf_dir):
    """WIN-1/2 from stored slot moments: the moving baseline at the newest snapshot
    of every ten minutes.  Snapshots come in four parts that share all groups: one
    is the first state, one is merged and sent again, one dies before its moments
    are stored and its groups are computed anew, one comes after that."""
    from tidewatch.operators.baseline import baseline_at_grid
    from tidewatch.sources import journal, moments
    from tidewatch.sources.tables import append_day_partitioned
    layout = Layout(scratch_path(spark, "moments"))
    create_tables(spark, layout)
    typed = TD.snapshots(_events(spark, sf_dir)).withColumn(
        "current_price", F.col("current_price").cast("decimal(38,8)"))
    ticket = F.pmod(F.xxhash64("asset_symbol", "ingested_at", "current_price"), F.lit(4))
    for part in range(4):
        rows = typed.where(ticket == part)
        seq = journal.open_note(spark, layout, "silver_snapshots", SV.snapshot_changes(rows))
        append_day_partitioned(rows, layout.silver_snapshots, "ingested_at")
        if part == 0:
            moments.start(spark, layout)
        elif part == 2:
            moments.renew(spark, layout, seq, journal.lows_of(spark, layout, "silver_snapshots", [seq]))
        else:
            for _ in range(2):
                moments.add(spark, layout, seq, rows)
        journal.close_notes(spark, layout, "silver_snapshots", [seq])
    moments.store(spark, layout).fold(2 * seq - 1)  # without the last part
    return G.rounded(baseline_at_grid(read_table(spark, layout, "silver_snapshots"),
                                      moments=moments.read(spark, layout)))


@register("bronze_compaction", """
SELECT event_id AS trade_id, upper(event_type) || 'USDT' AS symbol, CAST(value AS VARCHAR) AS price,
       '14' AS hour FROM events""")
def bronze_compaction(spark, sf_dir):
    """SNK-1: an hour landed in four batches is compacted after three of them; one
    of these is landed again (and adds nothing), the fourth comes late, the hour is
    compacted again and what it replaced is deleted."""
    from tidewatch.sources.compaction import compact_hour, purge
    path = scratch_path(spark, "compaction")
    trades = TD.bronze_trades(_events(spark, sf_dir)).drop("year", "month", "day", "hour")
    hour = {"year": "2026", "month": "06", "day": "10", "hour": "14"}

    def land(part: int) -> None:
        land_jsonl(trades.where(F.pmod("trade_id", F.lit(4)) == part), path, f"batch-{part}",
                   F.lit("2026-06-10T14:05:00+00:00"), files=2)

    for part in (0, 1, 2):
        land(part)
    compact_hour(spark, path, hour)
    for part in (1, 3):
        land(part)
    compact_hour(spark, path, hour)
    purge(spark, path, hour)
    land(2)
    return read_bronze_trades(spark, path).select("trade_id", "symbol", "price", "hour")


@register("gold_stream", SQL_GOLD_TYPED)
def gold_stream(spark, sf_dir):
    """JOB-6, JON-5 as a stream over silver (``streaming/gold.py``): three
    batches of rows out of order, late snapshots among them; the second batch
    fails after its upsert and is replayed."""
    from tidewatch.sources.tables import append_day_partitioned, read_anomalies
    from tidewatch.streaming.gold import start_gold_stream
    root = scratch_path(spark, "gold-stream")
    layout = Layout(f"{root}/lake")
    create_tables(spark, layout)
    ev = _events(spark, sf_dir)
    failed = []

    def fail(batch_id: int) -> None:
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("injected failure after the upsert")

    def run() -> None:
        start_gold_stream(spark, layout, f"{root}/checkpoint", f"{root}/staging",
                          available_now=True, before_commit=fail).awaitTermination()

    for part in (2, 0, 1):
        rows = ev.where(F.col("event_id") % 3 == part)
        snapshots = P.type_snapshots(TD.bronze_snapshots(rows))
        SV.note_newest(layout, snapshots)
        append_day_partitioned(snapshots, layout.silver_snapshots, "ingested_at")
        append_day_partitioned(P.type_trades(TD.bronze_trades(rows)), layout.silver_trades,
                               "ingested_at")
        try:
            run()
        except StreamingQueryException:
            if len(failed) != 1:
                raise
            run()
    return _gold_text(read_anomalies(spark, layout))


# ---------------------------------------------------------------- snapshot ingest
from tidewatch.functions.time import iso_to_ntz  # noqa: E402
from tidewatch.plans.snapshot_ingest import ingest_snapshots  # noqa: E402
from tidewatch.sources.landing import RECORDS_PER_FILE  # noqa: E402
from tidewatch.sources.bronze import read_bronze_snapshots  # noqa: E402

INGEST_CLOCK = "2026-06-10T14:30:00+00:00"   # the landing clock of this query


@register("snapshot_ingest_batch", f"""
SELECT event_type AS id, value AS current_price,
       date_trunc('millisecond', ts) AS last_updated,
       '{INGEST_CLOCK}' AS ingested_at, '2026' AS year, '06' AS month, '10' AS day,
       '14' AS hour
FROM events""")
def snapshot_ingest_batch(spark, sf_dir):
    """JOB-8, SNK-2/3, SRC-2/3/5, PRJ-3: market responses (JSON lines with
    undeclared keys) are stamped with one ingest time, landed and read back
    through the bronze snapshot table within the visible year range."""
    import datetime as dt
    root = scratch_path(spark, "snapshots")
    resp = TD.bronze_snapshots(_events(spark, sf_dir)).drop(
        "ingested_at", "_ingested_at", "year", "month", "day", "hour")
    resp = resp.withColumn("roi", F.lit(None).cast("string")).withColumn(
        "image", F.concat(F.lit("https://img/"), F.col("id")))
    resp.write.option("maxRecordsPerFile", RECORDS_PER_FILE).json(
        f"{root}/response", compression="gzip")
    now = dt.datetime.fromisoformat(INGEST_CLOCK)
    # the second landing lies outside the visible years
    for clock in (now, now.replace(year=2031)):
        ingest_snapshots(spark, f"{root}/response", f"{root}/bronze", clock, multiline=False,
                         compression="gzip")
    got = read_bronze_snapshots(spark, f"{root}/bronze", year_range=(2026, 2030))
    return got.select("id", "current_price",
                      iso_to_ntz("last_updated").alias("last_updated"),
                      "ingested_at", "year", "month", "day", "hour")


# ---------------------------------------------------------------- bulk rows
@register("vwap_lineitem_daily", """
SELECT l_returnflag || l_linestatus AS asset_symbol, date_trunc('day', l_shipdate)::TIMESTAMP AS window_start,
       date_trunc('day', l_shipdate)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
       CAST(floor(sum(l_extendedprice / l_quantity * l_quantity) / sum(l_quantity) * 1e6 + 0.3)
            AS BIGINT) AS vwap_e6,
       round(sum(l_quantity), 6) AS volume, count(*) AS trade_count
FROM lineitem GROUP BY ALL""")
def vwap_lineitem_daily(spark, sf_dir):
    """AGG-1..4 over bulk rows: daily VWAP of every line item by status."""
    rows = TD.load(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("asset_symbol"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("trade_time"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"))
    # quotients of small whole quantities often lie halfway between two rounded
    # values, so the digits are cut elsewhere
    return G.rounded(tumbling_vwap(rows, width="1 day")
                     .withColumn("vwap_e6", F.floor(F.col("vwap") * 1e6 + 0.3).cast("long"))
                     .drop("vwap"))


@register("merge_lineitem_upsert", """
WITH mx AS (SELECT max(l_orderkey) AS m FROM lineitem),
roles AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, m FROM lineitem, mx),
target AS (SELECT * EXCLUDE (m) FROM roles WHERE l_orderkey * 10 < m * 6),
source AS (SELECT * EXCLUDE (m) REPLACE (l_quantity + 1 AS l_quantity) FROM roles
           WHERE l_orderkey * 10 >= m * 4)
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM source s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
UNION ALL
SELECT * FROM source""")
def merge_lineitem_upsert(spark, sf_dir):
    """JON-5 over bulk rows: upsert of line items on (order, line number)."""
    rows = TD.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    target, source = TD.merge_roles(rows, id_col="l_orderkey", value_col="l_quantity")
    return merge_upsert(target, source, ["l_orderkey", "l_linenumber"])
