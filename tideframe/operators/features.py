"""The high-frequency feature row and the bars of each key, from books and trades."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideframe.config import FeatureConfig
from tideframe.functions import normal
from tideframe.operators import asof, bars, book, flow, rolling, split
from tideframe.operators.ordered import OrderedTable
from tideframe.session import materialise

BY = ["exchange", "symbol"]


def _sources(t: pa.Table, by: list[str]):
    """First row of each key in an ordered partition, with the end."""
    import numpy as np
    import pyarrow.compute as pc

    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for c in by:
        x = t[c].combine_chunks()
        if t.num_rows > 1:
            a, b = x.slice(1), x.slice(0, t.num_rows - 1)
            same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False) | (pc.is_null(a).to_numpy(zero_copy_only=False) & pc.is_null(b).to_numpy(zero_copy_only=False))
            new[1:] |= ~same
    heads = np.flatnonzero(new)
    return heads, np.concatenate([heads[1:], [t.num_rows]])


def _greedy(times, last: int, interval: int) -> list[int]:
    """Indices of the times kept, and so the last of them."""
    import numpy as np

    out, i = [], int(np.searchsorted(times, last + interval))
    while i < len(times):
        out.append(i)
        i = int(np.searchsorted(times, times[i] + interval))
    return out


def downsample(df: DataFrame, by: list[str], ts: str, interval_ms: int, seq: str = "seq", partitions: int | None = None) -> DataFrame:
    """Rows at least ``interval_ms`` after the last row kept of their key, greedily, from a last row at time 0. Rows without a time are left out."""
    return mark(df, chain(df, by, ts, interval_ms, seq, partitions), by, ts, seq).filter("_kept").drop("_kept")


def mark(df: DataFrame, kept: DataFrame, by: list[str], ts: str, seq: str = "seq", together: bool = False) -> DataFrame:
    """The rows with a time, and ``_kept``: whether ``kept``, the result of ``chain``, names them.

    The names go with the rows through one shuffle: they may be as many as the rows, and Spark takes a frame made by Python for
    a tiny one, which a join would broadcast. ``together``: rows of a key come to one partition, as the windows of a key need them.
    """
    null = {c: F.lit(None).cast(df.schema[c].dataType) for c in df.columns}
    name = null | {c: F.col(c) for c in by} | {ts: F.col("_t"), seq: F.col("_q").cast(df.schema[seq].dataType)}
    u = df.filter(F.col(ts).isNotNull()).withColumn("_m", F.lit(None).cast("boolean")).unionByName(kept.select(*[x.alias(c) for c, x in name.items()], F.lit(True).alias("_m")))
    w = W.partitionBy(*by, ts, F.col(seq).cast("long"))
    u = (u.repartition(*by) if together else u).withColumn("_kept", F.coalesce(F.max("_m").over(w), F.lit(False)))
    return u.filter("_m is null").drop("_m")


def chain(df: DataFrame, by: list[str], ts: str, interval_ms: int, seq: str = "seq", partitions: int | None = None) -> DataFrame:
    """Key, time ``_t`` and ``_q`` of the rows that ``downsample`` keeps.

    Each choice rests on the one before, yet a key may lie in many partitions: one that holds nothing else tells, for each of
    the few times at which a chain can enter it (those within one interval of its start), where that chain leaves it.
    The entries are then known for all partitions from these short tables.
    """
    narrow = df.filter(F.col(ts).isNotNull()).select(*by, F.col(ts).alias("_t"), F.col(seq).cast("long").alias("_q"))
    table = OrderedTable(narrow, [*by, "_t", "_q"], partitions, 0 if partitions else narrow.count())

    def edge(t: pa.Table) -> dict:
        import numpy as np

        heads, ends = _sources(t, by)
        name = lambda i: [str(t[c][int(i)].as_py()) for c in by]
        times = t["_t"].to_numpy()
        out = {"first": name(heads[0]), "last": name(heads[-1]), "whole": len(heads) == 1}
        if out["whole"]:
            u = np.unique(times)
            leave = np.arange(len(u))
            after = np.searchsorted(u, u + interval_ms)
            for i in range(len(u) - 1, -1, -1):
                if after[i] < len(u):
                    leave[i] = leave[after[i]]
            n = min(len(u), int(np.searchsorted(u, u[0] + interval_ms, "right")) + 1)
            out["ways"] = [[int(u[i]), int(u[leave[i]])] for i in range(n)]
        else:
            own = times[heads[-1] :]
            got = _greedy(own, 0, interval_ms)
            out["leaves"] = int(own[got[-1]]) if got else 0
        return out

    entries: dict[int, int] = {}
    key, last = None, 0
    edges = table.edges(edge)
    for p in sorted(edges):
        e = edges[p]
        entries[p] = last if e["first"] == key else 0
        if e["whole"]:
            way = next((w for w in e["ways"] if w[0] >= entries[p] + interval_ms), None)
            last = way[1] if way else entries[p]
        else:
            last = e["leaves"]
        key = e["last"]

    def choose(t: pa.Table, entry: int) -> pa.Table:
        heads, ends = _sources(t, by)
        times, keep = t["_t"].to_numpy(), []
        for k, (a, b) in enumerate(zip(heads.tolist(), ends.tolist())):
            keep += [a + i for i in _greedy(times[a:b], entry if k == 0 else 0, interval_ms)]
        return t.select([*by, "_t", "_q"]).take(pa.array(keep, pa.int64()))

    return table.scan(choose, narrow.schema, entries)


def trade_flow(trades: DataFrame, horizons: tuple[int, ...], by: list[str] = BY, hot: list | None = None) -> DataFrame:
    """Bought and sold volume of the last seconds at each trade; needs ts, seq, side and amount. Rows without time, side or amount are no trades."""
    s = normal.trade_side("side")
    t = trades.filter("ts is not null and amount is not null").withColumn("_s", s).filter(F.col("_s").isin("buy", "sell"))
    t = t.select(*by, "ts", "seq", F.when(F.col("_s") == "buy", F.col("amount")).otherwise(F.lit(0.0)).alias("_buy"), F.when(F.col("_s") == "sell", F.col("amount")).otherwise(F.lit(0.0)).alias("_sell"))
    # A buy evicts only buys: each side's window ends at that side's last trade.
    r = rolling.Rolling(by, parts=[split.CHUNK])
    hot = split.hot_keys(t, by) if hot is None else hot
    d = rolling.prepare(t, by, "ts", "seq", max(horizons), hot=hot)
    cols = {}
    for h in horizons:
        for k in ("buy", "sell"):
            cols[f"_{k}_{h}"] = r.add(F.col(f"_{k}"), h)
    d = d.withColumns(cols)
    names = [f"{k}_{h}" for h in horizons for k in ("buy", "sell")]
    d = split.own(d.withColumns({n: F.when(F.col(f"_{n.split('_')[0]}") > 0, F.col(f"_{n}")) for n in names})).select(*by, "ts", "seq", *names)
    d = asof.fill_forward(d, by, "ts", "seq", names, hot=hot)
    return d.withColumns({n: F.coalesce(n, F.lit(0.0)) for n in names})


def book_rows(books: DataFrame, cfg: FeatureConfig, by: list[str] = BY, hot: list | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Snapshot features and flow of each book, with the ``carry`` columns; needs ts, seq, bids, asks. One scan, one shuffle by key."""
    b = book.normalise(books.filter("ts is not null"))
    f = book.snapshot_features(b, cfg.max_levels, cfg.bands_bps, keep_raw_arrays=True, carry=[*by, "ts", "seq", *carry])
    f = f.withColumns({"bid_size": F.get("bids", F.lit(0))["size"], "ask_size": F.get("asks", F.lit(0))["size"]})
    f = flow.snapshot_flow(f, by, levels=min(cfg.ofi_levels, cfg.max_levels), alpha=cfg.ofi_decay_alpha, hot=hot)
    return f if cfg.keep_raw_arrays else f.drop("bids", "asks")


def hf_features(books: DataFrame, trades: DataFrame | None, cfg: FeatureConfig = FeatureConfig(), by: list[str] = BY, every_row: bool = False) -> DataFrame:
    """The feature row of each book that is emitted (all with ``every_row``).

    Which books are emitted rests on their times alone, and the flow of trades on the trades; both are found before the row has its
    many columns, so that these are not shuffled again.
    """
    if every_row:
        hot = split.hot_keys(books, by)
    else:
        # The books are asked four times: from a table, so that what made them runs once.
        books = materialise(books.filter("ts is not null").select(*by, "ts", "seq", "bids", "asks"), "books")
        hot = split.hot_keys(books, by)
        books = mark(books, chain(books, by, "ts", int(cfg.hf_emit_interval * 1000)), by, "ts", together=not hot)
    flows = []
    if trades is not None:
        hot_trades = split.hot_keys(trades, by)
        tf = trade_flow(trades, cfg.horizons, by, hot_trades)
        vals = [c for c in tf.columns if c not in (*by, "ts", "seq")]
        books = asof.asof_last(books.filter("ts is not null").select(*by, "ts", "seq", "bids", "asks", *([] if every_row else ["_kept"])), tf, by, "ts", vals, prefix="_t_", hot=[*hot, *hot_trades])
        flows = ["_t_ts", *[f"_t_{v}" for v in vals]]
    f = book_rows(books, cfg, by, hot, (*([] if every_row else ["_kept"]), *flows))
    r = rolling.Rolling(by)
    horizon = max(*cfg.horizons, cfg.depth_window, cfg.spread_regime_window, cfg.kyle_lambda_window, cfg.slope_window)
    f = split.split_hot(f, by, "ts", horizon=int(horizon * 1000), hot=hot)
    have05 = "bid_vol_band_0_5bps" in f.columns
    f = f.withColumn("_depth", F.col("bid_vol_band_0_5bps") + F.col("ask_vol_band_0_5bps") if have05 else F.lit(0.0))
    sums, out = {}, {}
    ret, ofi, ml = F.col("log_return_step"), F.col("ofi_step"), F.col("mlofi_decay")
    for h in cfg.horizons:
        sums |= {f"_n{h}": r.count(ret, h), f"_s{h}": r.add(ret, h), f"_ss{h}": r.add(ret * ret, h)}
        out[f"rv_{h}s"] = F.sqrt(r.variance_of(F.col(f"_n{h}"), F.col(f"_s{h}"), F.col(f"_ss{h}")))
        sums |= {f"ofi_sum_{h}s": r.add(ofi, h), f"mlofi_sum_{h}s": r.add(ml, h)}
    k = cfg.kyle_lambda_window
    sums |= {"_kn": r.count(ret, k), "_ka": r.add(ret, k), "_kb": r.add(ofi, k), "_kaa": r.add(ret * ret, k), "_kbb": r.add(ofi * ofi, k), "_kab": r.add(ret * ofi, k)}
    centred = {"_depth": cfg.depth_window, "bid_slope_regression": cfg.slope_window, "ask_slope_regression": cfg.slope_window, "cog_vs_mid": cfg.slope_window}
    f = f.withColumns({f"_c_{c}": r.centre(c) for c in centred})
    for c, h in centred.items():
        x = F.col(c) - F.col(f"_c_{c}")
        sums |= {f"_{c}_n": r.count(x, h), f"_{c}_s": r.add(x, h), f"_{c}_ss": r.add(x * x, h)}
    if cfg.use_dynamic_spread_regime:
        sums["_ranks"] = r.values("relative_spread", cfg.spread_regime_window)
    f = f.withColumns(sums)
    n = F.col("_kn")
    cov, va, vb = (F.when(n > 0, F.col(x) / n - F.col(y) / n * F.col(z) / n) for x, y, z in (("_kab", "_ka", "_kb"), ("_kaa", "_ka", "_ka"), ("_kbb", "_kb", "_kb")))
    out["kyle_lambda"] = F.when((n >= 2) & (vb >= rolling.FLOOR), cov / vb).otherwise(F.lit(0.0))
    out["kyle_lambda_r2"] = F.when((n >= 2) & (vb >= rolling.FLOOR) & (va >= rolling.FLOOR), cov * cov / (va * vb)).otherwise(F.lit(0.0))
    std = lambda c: F.sqrt(r.variance_of(F.col(f"_{c}_n"), F.col(f"_{c}_s"), F.col(f"_{c}_ss")))
    mean = lambda c: F.when(F.col(f"_{c}_n") > 0, F.col(f"_c_{c}") + F.col(f"_{c}_s") / F.col(f"_{c}_n")).otherwise(F.lit(0.0))
    out["depth_0_5bps_sigma"] = std("_depth")
    # On a row without a value the state of the last row with one is held.
    w, held = f"{cfg.slope_window}s", []
    for c, name in (("bid_slope_regression", "bid_slope"), ("ask_slope_regression", "ask_slope"), ("cog_vs_mid", "cog_momentum")):
        out |= {f"{name}_mean_{w}": F.when(F.col(c).isNotNull(), mean(c)), f"{name}_std_{w}": F.when(F.col(c).isNotNull(), std(c))}
        held += [f"{name}_mean_{w}", f"{name}_std_{w}"]
    rel = F.col("relative_spread")
    if cfg.use_dynamic_spread_regime:
        size = F.size("_ranks")
        rank = F.when(size > 0, F.coalesce(F.when(rel.isNotNull(), F.size(F.filter("_ranks", lambda v: v < rel))), F.lit(0)) / size).otherwise(F.lit(0.5))
        out["spread_percentile"] = rank
        out["spread_regime"] = F.when(rank <= cfg.spread_tight_percentile, "tight").when(rank >= cfg.spread_wide_percentile, "wide").otherwise(F.lit("normal"))
    else:
        out["spread_percentile"] = F.lit(None).cast("double")
        out["spread_regime"] = F.when(rel <= cfg.tight_spread_threshold, "tight").otherwise(F.lit("wide"))
    drop = [*[c for c in sums if c[0] == "_"], *[f"_c_{c}" for c in centred], "_depth"]
    f = asof.fill_forward(split.own(f.withColumns(out).drop(*drop)), by, "ts", "seq", held, hot=hot)
    f = f.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in held})
    f = rolling.since_last(f, by, "ts", "seq", "spread_regime", hot=hot)
    f = rolling.prepare(f, by, "ts", "seq", cfg.spread_regime_window, hot=hot)
    f = split.own(f.withColumns(rolling.time_shares(r, cfg.spread_regime_window, "spread_regime", ("tight", "wide"))).drop("_dt", "_pr"))
    t = F.timestamp_millis("ts")
    f = f.withColumns({
        "hour_of_day": F.hour(t), "day_of_week": F.weekday(t), "is_weekend": (F.weekday(t) >= 5).cast("int"), "minute_of_hour": F.minute(t), "date": F.date_format(t, "yyyy-MM-dd"), "mlofi_step": ml, "timestamp": F.col("ts"),
    })
    if trades is not None:
        vol = {}
        for h in cfg.horizons:
            live = (F.col("ts") - F.col("_t_ts") < h * 1000) if cfg.evict_on_snapshot else F.lit(True)
            b, s = (F.coalesce(F.when(live, F.col(f"_t_{k}_{h}")), F.lit(0.0)) for k in ("buy", "sell"))
            vol |= {f"tfi_{h}s": F.when(b + s > 0, (b - s) / (b + s)).otherwise(F.lit(0.0)), f"trade_vol_{h}s": b + s}
        f = f.withColumns(vol).drop(*flows)
    f = f.drop("bid_size", "ask_size")
    return f if every_row else f.filter("_kept").drop("_kept")


def feature_bars(books: DataFrame, cfg: FeatureConfig = FeatureConfig(), by: list[str] = BY, keep_open: bool = False) -> DataFrame:
    """Bars of the books at each duration."""
    f = book_rows(books, cfg, by, split.hot_keys(books, by))
    rows = f.select(*by, "ts", "seq", F.col("mid_price").alias("mid"), "spread", F.col("relative_spread").alias("rel_spread"), F.col("ofi_step").alias("ofi"), F.col("imbalance_L1").alias("l1_imb"), F.col("log_return_step").alias("log_ret"), F.col("mlofi_decay").alias("mlofi"))
    return bars.time_bars(rows, by, cfg.bar_durations, keep_open=keep_open)
