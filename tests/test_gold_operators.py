"""VWAP windows, moving baseline forms, as-of join forms, scoring."""
import re
import datetime as dt
import decimal
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.asof import asof_join
from tidewatch.operators.baseline import moving_stats
from tidewatch.operators.score import usable_baseline, with_zscore
from tidewatch.operators.vwap import tumbling_vwap
from tidewatch.plans.gold import score_windows

D = decimal.Decimal
T0 = dt.datetime(2026, 7, 16, 14, 0)


def at(**kw):
    return T0 + dt.timedelta(**kw)


def snaps_df(spark, rows):
    return spark.createDataFrame(rows, "asset_symbol string, ingested_at timestamp_ntz, "
                                       "current_price double")


def trades_df(spark, rows):
    return spark.createDataFrame(rows, "asset_symbol string, trade_time timestamp_ntz, "
                                       "price double, quantity double")


# ------------------------------------------------------------------ VWAP
def test_boundary_trade_opens_next_window(spark):
    df = trades_df(spark, [("BTC", at(minutes=40), 10.0, 1.0),
                           ("BTC", at(minutes=39, seconds=59, microseconds=999000), 20.0, 1.0)])
    got = {r["window_start"]: r["trade_count"] for r in tumbling_vwap(df).collect()}
    assert got == {at(minutes=30): 1, at(minutes=40): 1}


def test_vwap_volume_count(spark):
    df = trades_df(spark, [("BTC", at(minutes=1), 10.0, 1.0), ("BTC", at(minutes=2), 20.0, 3.0)])
    r = tumbling_vwap(df).first()
    assert r["vwap"] == pytest.approx(17.5) and r["volume"] == 4.0 and r["trade_count"] == 2
    assert r["window_end"] == at(minutes=10)


def test_exact_decimal_vwap(spark):
    df = spark.createDataFrame(
        [("BTC", at(minutes=1), D("41250.30000007"), D("0.00000003"))],
        "asset_symbol string, trade_time timestamp_ntz, price decimal(38,8), "
        "quantity decimal(38,8)")
    r = tumbling_vwap(df, exact_decimal=True).first()
    assert r["vwap"] == D("41250.30000007")


def test_zero_quantity_gives_null_vwap_not_error(spark):
    df = trades_df(spark, [("BTC", at(minutes=1), 10.0, 0.0)])
    assert tumbling_vwap(df).first()["vwap"] is None
    scored = with_zscore(tumbling_vwap(df).withColumn("baseline_mean", F.lit(1.0))
                         .withColumn("baseline_stddev", F.lit(1.0)))
    r = scored.first()
    assert r["z_score"] is None and r["is_anomaly"] is False


# ------------------------------------------------------------------ baseline
@pytest.mark.parametrize("form", ["plain", "halo", "sliced"])
def test_frame_edges_inclusive(spark, form):
    rows = [("BTC", at(hours=0), 1.0), ("BTC", at(hours=6), 3.0),
            ("ETH", at(hours=0), 1.0), ("ETH", at(hours=6, milliseconds=500), 3.0)]
    out = {(r["asset_symbol"], r["ingested_at"]): r
           for r in moving_stats(snaps_df(spark, rows), form=form).collect()}
    btc = out[("BTC", at(hours=6))]        # exactly 6 h before: included
    assert btc["baseline_mean"] == pytest.approx(2.0)
    assert btc["baseline_stddev"] == pytest.approx(math.sqrt(2.0))
    eth = out[("ETH", at(hours=6, milliseconds=500))]   # 6 h 0.5 s: excluded
    assert eth["baseline_mean"] == pytest.approx(3.0)
    assert eth["baseline_stddev"] is None


def _random_snaps(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        asset = rnd.choice(["A", "B", "C"])
        # clustered times with exact ties and slot/frame boundaries
        t = at(minutes=rnd.choice([0, 10, 20, 360, 370]) + rnd.randrange(0, 3000))
        if rnd.random() < 0.1:
            t = at(hours=rnd.randrange(0, 48))
        price = None if rnd.random() < 0.05 else round(rnd.uniform(1, 500), 2)
        rows.append((asset, t, price))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_baseline_forms_agree(spark, seed):
    df = snaps_df(spark, _random_snaps(seed))
    def key(r):
        return (r["asset_symbol"], r["ingested_at"], r["current_price"] or -1)
    plain = sorted(moving_stats(df, form="plain").collect(), key=key)
    for form in ("halo", "sliced"):
        other = sorted(moving_stats(df, form=form).collect(), key=key)
        assert len(other) == len(plain)
        for a, b in zip(plain, other):
            assert key(a) == key(b)
            for c in ("baseline_mean", "baseline_stddev"):
                if a[c] is None:
                    assert b[c] is None, (form, a, b)
                else:
                    assert b[c] == pytest.approx(a[c], rel=1e-9, abs=1e-9), (form, c, a, b)


# ------------------------------------------------------------------ as-of
def _asof_inputs(spark, seed):
    rnd = random.Random(seed)
    left = [(a, at(minutes=10 * k)) for a in "ABC" for k in range(0, 1000, 3)]
    right = []
    for _ in range(300):
        a = rnd.choice("ABCD")
        day = rnd.choice([0, 0, 1, 3, 6])      # days without any right row
        right.append((a, at(days=day, minutes=rnd.randrange(0, 1440)),
                      float(rnd.randrange(100))))
    right.append(("A", at(minutes=30), 999.0))  # exactly on a left time
    L = spark.createDataFrame(left, "asset_symbol string, window_end timestamp_ntz")
    R = spark.createDataFrame(right, "asset_symbol string, ingested_at timestamp_ntz, v double")
    return L, R, left, right


def _brute(left, right):
    out = {}
    for a, t in left:
        cands = [r for r in right if r[0] == a and r[1] <= t]
        out[(a, t)] = max(cands, key=lambda r: r[1])[2] if cands else None
    return out


@pytest.mark.parametrize("form,grid", [("plain", None), ("bucketed", None),
                                       ("bucketed", 600_000_000)])
def test_asof_matches_brute_force(spark, form, grid):
    L, R, left, right = _asof_inputs(spark, 7)
    # ties on ingested_at would make the pick arbitrary; keep right times unique
    seen, uniq = set(), []
    for r in right:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            uniq.append(r)
    R = spark.createDataFrame(uniq, R.schema)
    kw = {"right_grid": grid} if grid else {}
    got = asof_join(L, R, "asset_symbol", "window_end", "ingested_at", ["v"], form=form, **kw)
    res = {(r["asset_symbol"], r["window_end"]): r["v"] for r in got.collect()}
    assert res == _brute(left, uniq)
    assert res[("A", at(minutes=30))] == 999.0       # inclusive bound


@pytest.mark.parametrize("slot", [7 * 60_000_000, 600_000_000, 86_400_000_000])
def test_asof_of_one_hot_asset_in_slots(spark, slot):
    """One asset holds all rows; null times and keys, days and slots without rows."""
    rnd = random.Random(3)
    right = [("A", at(minutes=m, seconds=rnd.randrange(60)), float(m))
             for m in rnd.sample(range(0, 4320), 900) if not 1500 < m < 3100]
    left = [("A", at(seconds=rnd.randrange(-9000, 280_000))) for _ in range(700)]
    left = list(dict.fromkeys(left))
    L = spark.createDataFrame(left + [("Z", at()), (None, at())],
                              "asset_symbol string, window_end timestamp_ntz")
    R = spark.createDataFrame(right + [(None, at(days=-1), 5.0)],
                              "asset_symbol string, ingested_at timestamp_ntz, v double")
    got = asof_join(L, R, "asset_symbol", "window_end", "ingested_at", ["v"], slot=slot)
    res = {(r["asset_symbol"], r["window_end"]): r["v"] for r in got.collect()}
    assert res == _brute(left, right) | {("Z", at()): None, (None, at()): None}


def test_partial_store_folds_replays_and_late_batches(spark, tmp_dir):
    from tidewatch.operators.vwap import add_partials, vwap_of_partials, window_partials
    from tidewatch.sources.partials import PartialStore
    rnd = random.Random(5)
    rows = [(rnd.choice("AB"), at(seconds=rnd.randrange(3000)), D(rnd.randrange(1, 10**12)).scaleb(-8),
             D(rnd.randrange(1, 10**18)).scaleb(-8)) for _ in range(300)]
    schema = ("asset_symbol string, trade_time timestamp_ntz, price decimal(38,8), "
              "quantity decimal(38,8)")
    whole = spark.createDataFrame(rows, schema)
    parts = [window_partials(spark.createDataFrame(rows[i::3], schema)) for i in range(3)]
    store = PartialStore(spark, f"{tmp_dir}/store", parts[0].schema, add_partials)
    assert store.rows().count() == 0 and store.folded() == -1
    assert store.add(2, parts[2]) and store.add(0, parts[0]) and store.add(0, parts[0])
    store.fold(0)
    # a fold that died before its number was noted is not seen
    parts[1].write.parquet(f"{tmp_dir}/store/data/kind=base/number=1")
    assert not store.add(0, parts[0]) and store.add(1, parts[1])
    want = sorted(map(tuple, tumbling_vwap(whole, exact_decimal=True).collect()))
    assert sorted(map(tuple, vwap_of_partials(store.rows()).collect())) == want
    store.fold(2)
    assert sorted(map(tuple, vwap_of_partials(store.rows()).collect())) == want


# ------------------------------------------------------------------ score
def test_z_exactly_threshold_is_not_anomaly(spark):
    df = spark.createDataFrame([(13.0, 10.0, 1.0), (13.5, 10.0, 1.0), (None, 1.0, 1.0)],
                               "vwap double, baseline_mean double, baseline_stddev double")
    got = [r["is_anomaly"] for r in with_zscore(df).collect()]
    assert got == [False, True, False]


def test_usable_baseline_drops_zero_and_null(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,)], "baseline_stddev double")
    assert usable_baseline(df).count() == 1


@pytest.mark.parametrize("forms", [("plain", "plain"), ("sliced", "bucketed"),
                                   ("halo", "bucketed")])
def test_gold_edge_cases(spark, forms):
    bf, af = forms
    snaps = snaps_df(spark, [
        ("BTC", at(hours=-1), 100.0), ("BTC", at(minutes=-30), 110.0),
        ("BTC", at(minutes=10), 90.0),          # at the window end: picked
        ("ONE", at(minutes=-5), 5.0),            # single snapshot: null stddev
        ("FLAT", at(minutes=-20), 1.0), ("FLAT", at(minutes=-10), 1.0),
    ])
    trades = trades_df(spark, [
        ("BTC", at(minutes=1), 200.0, 1.0), ("BTC", at(minutes=2), 100.0, 1.0),
        ("ONE", at(minutes=1), 5.0, 1.0), ("FLAT", at(minutes=1), 1.0, 1.0),
        ("NONE", at(minutes=1), 1.0, 1.0),      # no snapshot at all
    ])
    got = score_windows(trades, snaps, baseline_form=bf, asof_form=af).collect()
    assert [r["asset_symbol"] for r in got] == ["BTC"]
    r = got[0]
    mean = (100 + 110 + 90) / 3
    std = math.sqrt(((100 - mean) ** 2 + (110 - mean) ** 2 + (90 - mean) ** 2) / 2)
    assert r["baseline_mean"] == pytest.approx(mean)
    assert r["baseline_stddev"] == pytest.approx(std)
    assert r["z_score"] == pytest.approx((150 - mean) / std)
    assert r["is_anomaly"] is True


def test_incremental_equals_full_from_the_cut(spark):
    from tidewatch.plans.gold import score_windows_since
    rnd = random.Random(11)
    snaps, trades = [], []
    for a in ("A", "B"):
        for k in range(400):
            if a == "B" and 100 < k < 380:
                continue            # B: last snapshot before the cut is days old
            snaps.append((a, at(minutes=17 * k + rnd.randrange(17)), rnd.uniform(90, 110)))
        for k in range(1200):
            trades.append((a, at(minutes=6 * k + rnd.randrange(6)), rnd.uniform(80, 120),
                           float(rnd.randrange(1, 5))))
    S, Tr = snaps_df(spark, snaps), trades_df(spark, trades)
    cut = at(minutes=17 * 300 + 3)
    full = {(r["asset_symbol"], r["window_start"]): r
            for r in score_windows(Tr, S).collect()
            if r["window_end"] >= at(minutes=(17 * 300 + 3) // 10 * 10)}
    inc = {(r["asset_symbol"], r["window_start"]): r
           for r in score_windows_since(Tr, S, cut).collect()}
    assert set(inc) == set(full) and any(k[0] == "B" for k in inc)
    for k, r in inc.items():
        assert r["z_score"] == pytest.approx(full[k]["z_score"], rel=1e-9)


@pytest.mark.parametrize("seed", [21, 22])
def test_grid_gold_matches_reference_shape_on_adversarial_data(spark, seed):
    """Grid baseline + bucketed as-of against one RANGE window per asset +
    union as-of, on snapshots placed on window ends, exactly 6 h apart, tied,
    null-priced, and with empty days."""
    rnd = random.Random(seed)
    snaps, trades = [], []
    for a in ("A", "B", "C"):
        for _ in range(250):
            day = rnd.choice([0, 0, 1, 2, 4])           # day 3 has nothing
            base = at(days=day)
            kind = rnd.random()
            if kind < 0.3:
                t = base + dt.timedelta(minutes=10 * rnd.randrange(144))   # on a window end
            elif kind < 0.4:
                t = base + dt.timedelta(minutes=10 * rnd.randrange(108), hours=6)
            else:
                t = base + dt.timedelta(seconds=rnd.randrange(86400),
                                        microseconds=rnd.choice([0, 1, 999999]))
            price = None if rnd.random() < 0.05 else float(rnd.randrange(9000, 11000)) / 100
            snaps.append((a, t, price))
            if rnd.random() < 0.1:
                snaps.append((a, t, price))              # exact tie, same price
        for _ in range(600):
            t = at(days=rnd.choice([0, 1, 2, 3, 4]), seconds=rnd.randrange(86400))
            trades.append((a, t, float(rnd.randrange(8000, 12000)) / 100,
                           float(rnd.randrange(1, 4))))
    S, Tr = snaps_df(spark, snaps), trades_df(spark, trades)
    def run(**kw):
        return {(r["asset_symbol"], r["window_start"]): r
                for r in score_windows(Tr, S, **kw).collect()}
    ref = run(baseline_form="plain", asof_form="plain")
    for kw in ({}, {"baseline_form": "sliced", "asof_form": "bucketed"},
               {"baseline_form": "halo", "asof_form": "bucketed"}):
        got = run(**kw)
        assert set(got) == set(ref), kw
        for k, r in got.items():
            for c in ("baseline_mean", "baseline_stddev", "z_score"):
                assert r[c] == pytest.approx(ref[k][c], rel=1e-9, abs=1e-9), (kw, k, c)
            assert r["is_anomaly"] == ref[k]["is_anomaly"]


def test_halo_windows_are_running(spark):
    """No frame slides (its buffer is aggregated again for every row), one shuffle."""
    from tidewatch.operators.baseline import moving_stats_halo
    s = spark.createDataFrame([("a", dt.datetime(2026, 1, 1), 1.0)],
                              "asset_symbol string, ingested_at timestamp_ntz, current_price double")
    plan = moving_stats_halo(s)._jdf.queryExecution().executedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]+), ([^)]+)\)", plan)
    assert frames and {f[1] for f in frames} == {"unboundedpreceding$()"}
    assert plan.count("Exchange") == 1


def test_gold_plain_is_linear_and_flat_frames_have_no_spread(spark):
    """JOB-6 in the plain shape slides no frame over rows, and a baseline of equal
    prices is dropped wherever the frame is cut."""
    start = dt.datetime(2026, 1, 1, 5, 30)
    snaps = snaps_df(spark, [("FLAT", start + dt.timedelta(minutes=7 * i), 0.1) for i in range(60)])
    trades = trades_df(spark, [("FLAT", start + dt.timedelta(minutes=11 * i), 0.3, 1.0)
                               for i in range(40)])
    got = score_windows(trades, snaps, baseline_form="halo", asof_form="bucketed")
    frames = re.findall(r"specifiedwindowframe\(RangeFrame, ([^,]+), ",
                        got._jdf.queryExecution().executedPlan().toString())
    assert frames and set(frames) == {"unboundedpreceding$()"}
    assert got.count() == 0
