"""Book, flow, window, bar, join and stateful operators against plain loops, with ties, nulls and split keys."""

import math
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from tideframe.config import FeatureConfig
from tideframe.operators import asof, bars, book, features, flow, rolling, split

BOOKS = "exchange string, symbol string, ts long, seq long, bids array<array<double>>, asks array<array<double>>"
SIMPLE = ("x", "BTC/USDT", 1_700_000_000_000, 1, [[50000.0, 1.0], [49990.0, 2.0], [49980.0, 3.0], [49970.0, 4.0], [49960.0, 5.0]], [[50010.0, 1.5], [50020.0, 2.5], [50030.0, 3.5], [50040.0, 4.5], [50050.0, 5.5]])


def test_golden_book(spark):
    d = spark.createDataFrame([SIMPLE], BOOKS)
    f = book.snapshot_features(d).first()
    assert f.mid_price == 50005 and f.spread == 10 and f.relative_spread == pytest.approx(10 / 50005)
    assert f.microprice == pytest.approx((50000 * 1.5 + 50010 * 1.0) / 2.5)
    assert f.imbalance_L1 == pytest.approx(-0.2) and f.bid_size_L0 == 1 and f.bid_size_L1 == 2
    assert f.bid_price_L7 is None and f.bid_size_L7 == 0
    assert f.vwap_bid_5 == pytest.approx(sum(p * s for p, s in SIMPLE[4]) / 15)
    assert f.bid_concentration == pytest.approx(55 / 225) and f.bid_50pct_depth_levels == 3
    assert f.bid_slope_simple == pytest.approx(40 / 15)
    r = book.research_features(d).first()
    assert r.bid_size_level_0 == 1 and r.bid_price_level_4 == 49960 and r.ask_size_level_4 == 5.5 and r.ask_price_level_5 is None
    n = book.normalise(d)
    assert book.snapshot_features(n).first().mid_price == 50005


@pytest.mark.parametrize("bids,asks", [([], []), (None, None), ([[100.0, 1.0]], []), ([[0.00001, 1e6]], [[0.00002, 1e6]]), ([[100.0, 0.0]], [[101.0, 0.0]]), ([[1e6, 0.001]], [[1000001.0, 0.001]])])
def test_odd_books(spark, bids, asks):
    d = spark.createDataFrame([("x", "s", 1, 1, bids, asks)], BOOKS)
    f = book.snapshot_features(d, 20, (5, 10, 25, 50, 100)).first()
    r = book.research_features(d).first()
    two = bool(bids) and bool(asks)
    assert (f.mid_price is not None) == two and (r.mid_price is not None) == two
    assert f.smart_bid_depth is not None and (f.imbalance_L1 is not None) == two
    assert f.bid_vol_band_0_5bps is not None and (f.imb_band_0_5bps is not None) == two
    if bids and bids[0][1] == 0:
        assert f.imbalance_L1 == 0 and f.book_pressure == 0 and f.microprice == f.mid_price and f.vwap_bid_5 is None


def random_books(n, keys=2, seed=3):
    r = random.Random(seed)
    out, t = [], 0
    for i in range(n):
        t += r.choice([0, 0, 200, 900, 2500])
        mid = 100 + r.randint(-3, 3) * 0.5
        side = lambda s: [[mid + s * 0.25 * (k + 1), float(r.randint(1, 9))] for k in range(r.choice([0, 1, 3, 5, 6]))]
        out.append(("x", f"s{r.randrange(keys)}", t, i, side(-1), side(1)))
    return out


def flow_loop(rows, levels=10, alpha=0.5):
    last, hist, out = {}, {}, {}
    for e, s, ts, seq, b, a in sorted(rows, key=lambda x: (x[1], x[2], x[3])):
        mid = (b[0][0] + a[0][0]) / 2 if b and a else None
        ret = ofi = multi = ml = 0.0
        p = last.get(s)
        if p and p[0] and mid:
            ret = math.log(mid / p[0])

            def lv(cur, prev, sign):
                o = []
                for (x, y), (u, v) in zip(cur[:levels], prev[:levels]):
                    o.append(y if (x - u) * sign > 0 else -v if (x - u) * sign < 0 else y - v)
                return o

            bl, al = lv(b, p[1], 1), lv(a, p[2], -1)
            ofi, multi = bl[0] - al[0], sum(bl) - sum(al)
            ml = sum(v * math.exp(-alpha * i) for i, v in enumerate(bl)) - sum(v * math.exp(-alpha * i) for i, v in enumerate(al))
        h = hist.setdefault(s, [])
        h.append((ts / 1000, mid))
        vel = acc = 0.0
        if len(h) > 1 and h[-1][0] > h[-2][0] and mid is not None and h[-2][1] is not None:
            vel = (mid - h[-2][1]) / (h[-1][0] - h[-2][0])
            if len(h) > 2 and h[-2][0] > h[-3][0] and h[-3][1] is not None:
                d1, d0 = h[-1][0] - h[-2][0], h[-2][0] - h[-3][0]
                acc = (vel - (h[-2][1] - h[-3][1]) / d0) / ((d1 + d0) / 2)
        last[s] = (mid, b, a)
        out[seq] = (ret, ofi, multi, ml, vel, acc, s, ts, mid)
    return out


@pytest.mark.parametrize("chunk", [split.ROWS_PER_CHUNK, 20])
def test_flow_equals_the_loop(spark, chunk):
    rows = random_books(200)
    d = book.normalise(spark.createDataFrame(rows, BOOKS))
    one = lambda s, f: F.get(F.col(s), F.lit(0))[f]
    d = d.withColumns({"best_bid": one("bids", "price"), "best_ask": one("asks", "price"), "bid_size": one("bids", "size"), "ask_size": one("asks", "size")})
    d = d.withColumn("mid_price", (F.col("best_bid") + F.col("best_ask")) / 2).withColumn("microprice", F.col("mid_price"))
    got = flow.snapshot_flow(d, ["exchange", "symbol"], rows_per_chunk=chunk).collect()
    want = flow_loop(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.log_return_step, r.ofi_step, r.ofi_multi, r.mlofi_decay, r.mid_velocity, r.mid_accel) == pytest.approx(want[r.seq][:6], abs=1e-9)


TICKS = "k string, ts long, seq long, x double, f double, g string, _x int"


def random_ticks(n=300, seed=5):
    r = random.Random(seed)
    out, t = [], 0
    for i in range(n):
        t += r.choice([0, 0, 0, 300, 1000, 4000])
        out.append(("hot" if r.random() < 0.7 else None if r.random() < 0.2 else "b", t, i, None if r.random() < 0.1 else 1e6 + r.randint(0, 50) * 1e-4, float(r.randint(-3, 3)), r.choice(["tight", "wide", "normal"]), 1))
    return out


def windows(rows, h, col, need=True):
    """Values of the window (t - h, t] of rows already seen, for each row by (ts, seq)."""
    q, out = {}, {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        w = q.setdefault(r[0], deque())
        while w and w[0][0] <= r[1] - h:
            w.popleft()
        if r[col] is not None or not need:
            w.append((r[1], r[col], r))
        out[r[2]] = [v for _, v, _ in w]
    return out


@pytest.mark.parametrize("chunk", [split.ROWS_PER_CHUNK, 25])
def test_rolling_statistics(spark, chunk):
    rows = random_ticks()
    d = spark.createDataFrame([r[:6] for r in rows], TICKS.rsplit(",", 1)[0])
    want = windows(rows, 5000, 3)
    # Key null is a key like any other.
    for r in rolling.rolling_sum(d, ["k"], "ts", "seq", "x", 5, "w", rows_per_chunk=chunk).collect():
        v = want[r.seq]
        assert r.w_n == len(v) and r.w_sum == pytest.approx(sum(v), rel=1e-9, abs=1e-6)
    got = rolling.rolling_moments(d, ["k"], "ts", "seq", "x", 5, "w", rows_per_chunk=chunk).collect()
    assert len(got) == len(rows)
    for r in got:
        v = want[r.seq]
        m = sum(v) / len(v) if v else 0
        var = sum((x - m) ** 2 for x in v) / (len(v) - 1) if len(v) > 1 else 0
        assert r.w_mean == pytest.approx(m) and r.w_var == pytest.approx(var, rel=1e-4, abs=1e-12)
    for r in rolling.percentile_rank(d, ["k"], "ts", "seq", "x", 5, (0.2, 0.8), "w", rows_per_chunk=chunk).collect():
        v = sorted(want[r.seq])
        assert r.w_rank == pytest.approx(0.5 if not v else 0.0 if r.x is None else sum(y < r.x for y in v) / len(v))
        assert r.w_p20 == (v[int(0.2 * (len(v) - 1))] if v else None)


@pytest.mark.parametrize("chunk", [split.ROWS_PER_CHUNK, 25])
def test_regimes_and_impact(spark, chunk):
    rows = random_ticks(seed=8)
    d = spark.createDataFrame([r[:6] for r in rows], TICKS.rsplit(",", 1)[0])
    prev, spans, want = {}, {}, {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        s = spans.setdefault(r[0], [])
        if r[0] in prev:
            s.append((r[1], r[1] - prev[r[0]][0], prev[r[0]][1]))
        prev[r[0]] = (r[1], r[5])
        live = [x for x in s if x[0] > r[1] - 9000]
        whole = sum(x[1] for x in live)
        want[r[2]] = sum(x[1] for x in live if x[2] == "tight") / whole if whole else 0
    got = rolling.regime_fractions(d, ["k"], "ts", "seq", "g", 9, ("tight", "wide"), rows_per_chunk=chunk).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.g_tight_frac == pytest.approx(want[r.seq])
    pair = windows([(r[0], r[1], r[2], (r[3], r[4])) for r in rows], 9000, 3)
    d = d.withColumn("x", F.col("x") - 1e6)
    for r in rolling.kyle_lambda(d, ["k"], "ts", "seq", "x", "f", 9, rows_per_chunk=chunk).collect():
        v = [(a - 1e6, b) for a, b in pair[r.seq] if a is not None]
        n = len(v)
        lam = 0.0
        if n >= 2:
            ma, mb = sum(a for a, _ in v) / n, sum(b for _, b in v) / n
            vb = sum(b * b for _, b in v) / n - mb * mb
            lam = (sum(a * b for a, b in v) / n - ma * mb) / vb if vb >= 1e-10 else 0.0
        assert r.kyle_lambda == pytest.approx(lam, abs=1e-9)


@pytest.mark.parametrize("chunk", [split.ROWS_PER_CHUNK, 100])
def test_running_variance_of_large_values(spark, chunk):
    rows = [("k", i, i, 1e6 + i * 1e-4, 0.0, "g") for i in range(1000)]
    d = rolling.welford(spark.createDataFrame(rows, TICKS.rsplit(",", 1)[0]), ["k"], "ts", "seq", "x", stretch=90, rows_per_chunk=chunk)
    v = [r[3] - 1e6 for r in rows]
    m = sum(v) / 1000
    assert d.filter("seq = 999").first().x_var == pytest.approx(sum((x - m) ** 2 for x in v) / 999, rel=1e-5)
    assert d.filter("seq = 0").first().x_var == 0


BAR_COLS = "k string, ts long, seq long, mid double, spread double, rel_spread double, ofi double, l1_imb double, log_ret double, mlofi double"


def test_golden_bars(spark):
    rows = [("a", 0, 0, 100.0, 10.0, None, 1.0, 0.5, 0.01, 1.0), ("a", 3000, 1, 105.0, 20.0, None, -0.5, None, -0.02, 2.0), ("a", 7000, 2, 102.0, 30.0, None, 0.0, 0.5, 0.03, 3.0), ("a", 10500, 3, 98.0, 1.0, None, 0.0, 0.0, 0.0, 4.0), ("b", 0, 0, 1.0, 1.0, None, 0.0, 0.0, 0.0, 0.0), ("b", 50000, 1, 1.0, 1.0, None, 0.0, 0.0, 0.0, 0.0)]
    got = {(r.k, r.bar_start): r for r in bars.time_bars(spark.createDataFrame(rows, BAR_COLS), ["k"], (10,)).collect()}
    assert set(got) == {("a", 0), ("b", 0)}  # open bars are left out, gaps make none
    b = got["a", 0]
    assert (b.open, b.high, b.low, b.close, b["count"]) == (100, 105, 100, 102, 3)
    assert b.mean_spread == 20 and b.sum_ofi == 0.5 and b.mean_relative_spread == 0 and b.mean_l1_imbalance == pytest.approx(1 / 3)
    assert b.realized_variance == pytest.approx(sum((x - 0.02 / 3) ** 2 for x in (0.01, -0.02, 0.03)) / 2)
    assert b.sum_mlofi_decay == 6 and b.close_step_mlofi == 4
    assert bars.time_bars(spark.createDataFrame([], BAR_COLS), ["k"], (10, 60)).count() == 0


def test_volume_clock_keeps_all_volume(spark):
    r = random.Random(9)
    rows, t = [], 0
    for i in range(300):
        t += r.choice([0, 1000, 4_000_000])
        rows.append((r.choice(["a", "a", "b"]), t, i, float(r.randint(90, 110)), r.choice([0.0, 0.7, 3.2, 11.0, 27.5, None]), r.choice(["buy", "SELL", "b", None])))
    d = spark.createDataFrame(rows, "k string, ts long, seq long, price double, volume double, side string")
    got = {(x.k, x.bucket): x for x in bars.volume_bars(d, ["k"], 10.0).collect()}
    want = {}
    for k in ("a", "b"):
        cur, n, start = None, 0, None
        for _, ts, _, p, v, s in sorted((x for x in rows if x[0] == k), key=lambda x: x[1:3]):
            left = round((v or 0) * 10)
            while left:
                if cur is None:
                    o = start or (p, ts)
                    cur = {"open": o[0], "st": o[1], "v": 0, "b": 0, "pv": 0.0, "n": 0, "h": o[0], "l": o[0]}
                take = min(left, 100 - cur["v"])
                left -= take
                cur["v"] += take
                cur["b"] += take if (s or "").upper() in ("BUY", "B") else 0
                cur["pv"] += p * take
                cur["n"] += 1
                cur["h"], cur["l"] = max(cur["h"], p), min(cur["l"], p)
                if cur["v"] == 100:
                    want[k, n] = (cur["open"], cur["h"], cur["l"], p, cur["b"] / 10, cur["pv"] / 100, cur["n"], cur["st"], ts)
                    cur, n, start = None, n + 1, (p, ts)
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        assert (g.open, g.high, g.low, g.close, g.buy_volume, g.vwap, g.trade_count, g.start_time, g.end_time) == pytest.approx(w)
    v = bars.vpin(d, ["k"], 10.0, 3).collect()
    assert len(v) == len(want) and all(0 <= x.vpin <= 1 and x.buy_volume + x.sell_volume == pytest.approx(10) for x in v)


def test_tick_rule(spark):
    rows = [("a", i, i, p, 1.0, None) for i, p in enumerate([5.0, 6.0, 6.0, 4.0])]
    d = bars.tick_side(spark.createDataFrame(rows, "k string, ts long, seq long, price double, volume double, side string"), ["k"], "ts", "seq", "price", None)
    assert [r._buy for r in d.orderBy("seq").collect()] == [0.5, 1.0, 0.5, 0.0]


@pytest.mark.parametrize("strict", [False, True])
def test_asof(spark, strict):
    r = random.Random(11)
    left = [(r.choice(["a", "b", None]), r.randint(0, 9_000_000), i, None) for i in range(200)]
    right = [(r.choice(["a", "b", None]), r.choice([x[1] for x in left]), float(i)) for i in range(40)]
    right = [(k, t, v) for (k, t), v in {(k, t): v for k, t, v in right}.items()]
    got = asof.asof_last(spark.createDataFrame(left, "k string, ts long, id long, v double"), spark.createDataFrame(right, "k string, ts long, v double"), ["k"], "ts", ["v"], strict=strict, tolerance=5_000_000).collect()
    assert len(got) == 200
    for x in got:
        c = [(t, v) for k, t, v in right if k == x.k and (t < x.ts or (t == x.ts and not strict))]
        want = max(c) if c and x.k is not None else None
        if x.k is not None:
            assert x.asof_v == (want[1] if want and x.ts - want[0] <= 5_000_000 else None)


@pytest.mark.parametrize("hot", [None, []])
def test_fill_forward(spark, hot):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), i * 1000, i, r.choice([None, None, float(i)])) for i in range(120)]
    got = {x.seq: x.v for x in asof.fill_forward(spark.createDataFrame(rows, "k string, ts long, seq long, v double"), ["k"], "ts", "seq", ["v"], stretch=7000, hot=hot).collect()}
    last = {}
    for k, _, seq, v in rows:
        last[k] = last.get(k) if v is None else v
        assert got[seq] == last[k]


def test_range_join(spark):
    pts = spark.createDataFrame([("a", i) for i in range(0, 100, 7)], "k string, t long")
    iv = spark.createDataFrame([("a", 10, 40, "x"), ("a", 40, 41, "y"), ("a", 60, 60, "z"), ("b", 0, 99, "w")], "k string, lo long, hi long, n string")
    got = sorted((r.t, r.n) for r in asof.range_join(pts, iv, ["k"], "t", "lo", "hi", 8).collect())
    assert got == [(t, "x") for t in range(14, 40, 7)]


def test_book_states_equal_a_dict(spark):
    r = random.Random(12)
    rows = [("e", "s", i // 2, r.choice(["bid", "offer", "ASK"]), float(r.randint(0, 9) + (10 if i % 3 else 0)), r.choice([0.0, 1.0, 2.0, None])) for i in range(400)]
    rows = list({(x[2], x[3].lower().replace("offer", "ask"), x[4]): x for x in rows}.values()) + [("e", "s", 7, None, 1.0, 1.0), ("e", "s", None, "bid", 1.0, 1.0)]
    d = spark.createDataFrame(rows, "exchange string, symbol string, sequence_num long, side string, price_level double, new_quantity double")
    got = {x.sequence_num: x for x in asof.book_states(d, ["exchange", "symbol"], width=16).collect()}
    sides = {"bid": {}, "ask": {}}
    for q in sorted({x[2] for x in rows if x[2] is not None}):
        for _, _, s, side, p, v in rows:
            if s == q and side:
                b = sides["bid" if side.lower() == "bid" else "ask"]
                b.pop(p, None) if v == 0.0 else b.__setitem__(p, v)
        g = got[q]
        if sides["bid"] and sides["ask"]:
            assert (g.best_bid, g.best_ask) == (max(sides["bid"]), min(sides["ask"])) and g.best_bid_size == sides["bid"][max(sides["bid"])]
        else:
            assert g.best_bid is None and g.mid_price is None


@pytest.mark.parametrize("parts", [1, 4, 60])
def test_downsampling_over_cut_keys(spark, parts):
    r = random.Random(13)
    rows, t = [], 0
    for i in range(500):
        t += r.choice([0, 100, 700, 1500])
        rows.append(("hot" if r.random() < 0.8 else r.choice(["b", None]), t if r.random() > 0.02 else None, i))
    got = {x.seq for x in features.downsample(spark.createDataFrame(rows, "k string, ts long, seq long"), ["k"], "ts", 1000, partitions=parts).collect()}
    want, last = set(), {}
    for k, ts, seq in sorted((x for x in rows if x[1] is not None), key=lambda x: x[1:]):
        if ts - last.get(k, 0) >= 1000:
            last[k] = ts
            want.add(seq)
    assert got == want


def test_running_asof_equals_stretches(spark):
    """With no hot key one running value does; null keys match nothing."""
    r = random.Random(5)
    key = lambda: r.choice(["a", "b", None])
    left = spark.createDataFrame([(key(), r.randrange(0, 20_000_000, 500_000), i) for i in range(80)], "k string, ts long, seq long")
    right = [(key(), r.randrange(0, 20_000_000, 500_000), i + 0.5) for i in range(40)]
    once = {(k, t): v for k, t, v in right}
    rows = spark.createDataFrame([(k, t, v) for (k, t), v in once.items()], "k string, ts long, v double")
    got = {x.seq: (x.asof_ts, x.asof_v) for x in asof.asof_last(left, rows, ["k"], "ts", ["v"], hot=[]).collect()}
    want = {}
    for x in left.collect():
        mine = max(((t, v) for (k, t), v in once.items() if k == x.k and t <= x.ts), default=(None, None)) if x.k is not None else (None, None)
        want[x.seq] = mine
    assert got == want


def test_feature_row_takes_its_trades_before_its_columns(spark):
    """No join of the row with anything, so neither is its width shuffled nor the kept rows broadcast."""
    side = [(10.0, 1.0), (9.0, 2.0)]
    b = spark.createDataFrame([("e", "s", 100_000 * i, i, side, [(11.0, 1.0)]) for i in range(1, 6)], "exchange string, symbol string, ts long, seq long, bids array<struct<price:double,size:double>>, asks array<struct<price:double,size:double>>")
    t = spark.createDataFrame([("e", "s", 100_000 * i - 1, i, "buy", 2.0) for i in range(1, 6)], "exchange string, symbol string, ts long, seq long, side string, amount double")
    f = features.hf_features(b, t, FeatureConfig(horizons=(60,)))
    assert "Join" not in f._jdf.queryExecution().executedPlan().toString()
    assert [(x.tfi_60s, x.trade_vol_60s) for x in f.collect()] == [(1.0, 2.0)] * 5


def test_kept_rows_are_not_broadcast(spark):
    """They may be as many as the rows, though a frame made by Python has no size that Spark knows."""
    rows = [(None if i % 3 == 0 else "a", i * 400, i, f"x{i}") for i in range(60)] + [("a", 400, 1, "again"), ("b", None, 7, "no time")]
    got = features.downsample(spark.createDataFrame(rows, "k string, ts long, seq long, v string"), ["k"], "ts", 1000)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    last, want = {}, []
    for k, ts, seq, v in sorted((r for r in rows if r[1] is not None), key=lambda r: (str(r[0]), r[1], r[2])):
        if ts - last.get(k, 0) >= 1000:
            last[k] = ts
            want.append((k, ts, seq, v))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_feature_rows_and_bars(spark):
    rows = random_books(120, 2, 21)
    r = random.Random(22)
    trades = [("x", f"s{r.randrange(2)}", r.randint(0, 90_000), 1000 + i, r.choice(["buy", "SELL", None]), r.choice([1.0, 2.5, None])) for i in range(80)]
    cfg = FeatureConfig(horizons=(5, 15), max_levels=6, bar_durations=(10,))
    b, t = spark.createDataFrame(rows, BOOKS), spark.createDataFrame(trades, "exchange string, symbol string, ts long, seq long, side string, amount double")
    f = features.hf_features(b, t, cfg, every_row=True)
    got = {x.seq: x for x in f.collect()}
    assert len(got) == len(rows)
    want = flow_loop(rows)
    ofi = windows([(want[x[3]][6], x[2], x[3], want[x[3]][1]) for x in rows], 5000, 3)
    ret = windows([(want[x[3]][6], x[2], x[3], want[x[3]][0]) for x in rows], 15000, 3)
    for s, g in got.items():
        assert g.ofi_sum_5s == pytest.approx(sum(ofi[s]), abs=1e-9)
        v = ret[s]
        m = sum(v) / len(v)
        assert g.rv_15s == pytest.approx(math.sqrt(sum((x - m) ** 2 for x in v) / (len(v) - 1)) if len(v) > 1 else 0, abs=1e-9)
        buys = sorted((q[2], q[3], q[5]) for q in trades if q[1] == g.symbol and q[4] == "buy" and q[5] and q[2] <= g.ts)
        sells = sorted((q[2], q[3], q[5]) for q in trades if q[1] == g.symbol and q[4] == "SELL" and q[5] and q[2] <= g.ts)
        part = [sum(a for tt, _, a in z if tt > z[-1][0] - 5000) if z else 0 for z in (buys, sells)]
        assert g.trade_vol_5s == pytest.approx(sum(part))
        assert g.spread_regime in ("tight", "normal", "wide") and 0 <= g.spread_percentile <= 1
    some = features.hf_features(b, None, cfg)
    assert 0 < some.count() < len(rows)
    bar = features.feature_bars(b, cfg).collect()
    assert bar and all(x.high is None or x.high >= x.low for x in bar)
    static = features.hf_features(b, None, FeatureConfig(horizons=(5,), use_dynamic_spread_regime=False, keep_raw_arrays=True))
    assert {x.spread_regime for x in static.select("spread_regime").collect()} <= {"tight", "wide"} and "bids" in static.columns
    assert features.hf_features(b.limit(0), t.limit(0), cfg).count() == 0


def test_levels_that_stand_for_long_are_covered_by_few_blocks(spark):
    """Two changes ten thousand million sequences apart."""
    rows = [("x", "s", 1, "bid", 10.0, 1.0), ("x", "s", 2, "ask", 11.0, 2.0), ("x", "s", 10**10, "bid", 9.0, 3.0), ("x", "s", 10**10 + 5, "bid", 10.0, 0.0)]
    d = spark.createDataFrame(rows, "exchange string, symbol string, sequence_num long, side string, price_level double, new_quantity double")
    got = {r.sequence_num: (r.best_bid, r.best_ask) for r in asof.book_states(d, ["exchange", "symbol"]).collect()}
    assert got == {1: (None, None), 2: (10.0, 11.0), 10**10: (10.0, 11.0), 10**10 + 5: (9.0, 11.0)}
    for r, spans in ((2, [(5, 6), (7, 300), (16, 32)]), (16, [(0, 10**10), (5, 6), (7, 300), (16, 32)])):
        b = asof._blocks(spark.createDataFrame(spans, "a long, b long"), "a", "b", 8, r).collect()
        assert len(b) < 400
        for lo, hi in spans:
            parts = sorted((x._b * r**x._lv, (x._b + 1) * r**x._lv) for x in b if (x.a, x[1]) == (lo, hi))
            assert parts[0][0] == lo and parts[-1][1] == hi and all(p[1] == q[0] for p, q in zip(parts, parts[1:]))


def test_splits_of_hot_keys_do_not_multiply_the_input(spark):
    from tideframe.operators import split

    d = spark.createDataFrame([("a", i, i) for i in range(300)] + [("b", 1, 1)], "k string, ts long, seq long").filter("ts >= 0")
    relations = lambda x: x._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    one = split.split_hot(d, ["k"], "ts", horizon=5, rows_per_chunk=50, bucket=10)
    two = split.split_hot(split.own(one), ["k"], "ts", last_rows=1, order=["seq"], rows_per_chunk=50, bucket=10)
    assert relations(two) <= relations(one) + 6 and split.own(two).count() == 301
