"""Features of an order-book snapshot, as expressions over its arrays of levels.

Input columns ``bids`` and ``asks``: arrays of [price, size] or of struct(price, size), best level first. Undefined
features are null. Sizes of missing levels are 0, their prices null. A null side counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEVELS = "array<struct<price:double,size:double>>"
#: Levels used by the features that look at a fixed depth.
NEAR, SLOPE_LEVELS, COG_LEVELS, SMART_LEVELS, SMART_DECAY = 5, 10, 20, 50, 100.0


def normalise(df: DataFrame, bids: str = "bids", asks: str = "asks") -> DataFrame:
    """Both sides as arrays of struct(price, size); null sides become empty."""

    def side(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
            col = F.transform(c, lambda x: F.struct(F.get(x, F.lit(0)).cast("double").alias("price"), F.get(x, F.lit(1)).cast("double").alias("size")))
        else:
            col = F.col(c)
        return F.coalesce(col.cast(LEVELS), F.array().cast(LEVELS))

    return df.withColumns({"bids": side(bids), "asks": side(asks)})


def truncate(c: Column, depth: int) -> Column:
    """The best ``depth`` levels."""
    return F.slice(c, 1, depth)


def total(levels: Column) -> Column:
    return F.aggregate(levels, F.lit(0.0), lambda a, x: a + x["size"])


def notional(levels: Column) -> Column:
    return F.aggregate(levels, F.lit(0.0), lambda a, x: a + x["price"] * x["size"])


def ratio(a: Column, b: Column) -> Column:
    """a / b where b is positive, else null."""
    return F.when(b > 0, a / b)


def imbalance(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); 0 if both are 0."""
    return F.when(a + b > 0, (a - b) / (a + b)).otherwise(F.lit(0.0))


def half_depth(levels: Column, whole: Column) -> Column:
    """Number of levels whose running volume is below half of the whole; null if the side is empty."""
    zero = F.struct(F.lit(0.0).alias("run"), F.lit(0).alias("n"))
    step = lambda a, x: F.struct((a["run"] + x["size"]).alias("run"), (a["n"] + F.when(a["run"] + x["size"] < whole * 0.5, 1).otherwise(0)).alias("n"))
    return F.when(F.size(levels) > 0, F.aggregate(levels, zero, step, lambda a: a["n"]))


def concentration(levels: Column, whole: Column) -> Column:
    """Sum of squared shares; 0 for a side without volume, null for an empty one."""
    own = F.aggregate(levels, F.lit(0.0), lambda a, x: a + x["size"] * x["size"])
    return F.when(F.size(levels) > 0, F.when(whole > 0, own / (whole * whole)).otherwise(F.lit(0.0)))


def band_volume(levels: Column, mid: Column, sign: int, lo: int, hi: int) -> Column:
    """Volume at a distance from mid in [lo, hi) basis points; 0 without a mid. sign: 1 for bids, -1 for asks."""
    d = lambda x: sign * (mid - x["price"]) / mid * 10000
    return F.when(mid > 0, total(F.filter(levels, lambda x: (d(x) >= lo) & (d(x) < hi)))).otherwise(F.lit(0.0))


def smart_depth(levels: Column, mid: Column, sign: int) -> Column:
    """Volume weighted by exp(-100 x relative distance), top 50 levels; 0 where undefined."""
    w = F.aggregate(truncate(levels, SMART_LEVELS), F.lit(0.0), lambda a, x: a + x["size"] * F.exp(-SMART_DECAY * (sign * (mid - x["price"]) / mid)))
    return F.when(mid > 0, w).otherwise(F.lit(0.0))


def slope_simple(levels: Column) -> Column:
    top = truncate(levels, NEAR)
    gap = F.abs(F.get(levels, F.lit(NEAR - 1))["price"] - F.get(levels, F.lit(0))["price"])
    return F.when(F.size(levels) >= NEAR, ratio(gap, total(top)))


def slope_regression(levels: Column, mid: Column, sign: int, n: Column) -> Column:
    """Least-squares slope of running volume on distance (bps) over the first n levels; null for fewer than 3 or if all distances are equal."""
    names = ("cum", "sx", "sy", "sxx", "sxy")
    zero = F.struct(*[F.lit(0.0).alias(k) for k in names])

    def step(a: Column, x: Column) -> Column:
        d, cum = sign * (mid - x["price"]) / mid * 10000, a["cum"] + x["size"]
        return F.struct(cum.alias("cum"), (a["sx"] + d).alias("sx"), (a["sy"] + cum).alias("sy"), (a["sxx"] + d * d).alias("sxx"), (a["sxy"] + d * cum).alias("sxy"))

    top = F.slice(levels, F.lit(1), n)
    span = F.array_max(F.transform(top, lambda x: x["price"])) > F.array_min(F.transform(top, lambda x: x["price"]))
    fit = lambda a: (n * a["sxy"] - a["sx"] * a["sy"]) / F.nullif(n * a["sxx"] - a["sx"] * a["sx"], F.lit(0.0))
    return F.when((n >= 3) & (mid > 0) & span, F.aggregate(top, zero, step, fit))


def snapshot_features(df: DataFrame, max_levels: int = 10, bands_bps: tuple[int, ...] = (5, 10, 25, 50), keep_raw_arrays: bool = False, carry: list[str] | None = None) -> DataFrame:
    """All features of each snapshot, with the ``carry`` columns (default: all others)."""
    carry = [c for c in (df.columns if carry is None else carry) if c not in ("bids", "asks")]
    df = normalise(df)
    one = lambda s, i, f: F.get(F.col(s), F.lit(i))[f]
    bb, ba = one("bids", 0, "price"), one("asks", 0, "price")
    df = df.select(*carry, "bids", "asks", bb.alias("best_bid"), ba.alias("best_ask"), ((bb + ba) / 2).alias("mid_price"), truncate(F.col("bids"), max_levels).alias("_b"), truncate(F.col("asks"), max_levels).alias("_a"))
    mid, sb, sa = F.col("mid_price"), one("bids", 0, "size"), one("asks", 0, "size")
    bands = list(zip((0, *bands_bps), bands_bps))
    key = lambda lo, hi: f"{lo}_{hi}bps"
    first = {
        "spread": F.col("best_ask") - F.col("best_bid"), "imbalance_L1": F.when(mid.isNotNull(), imbalance(sb, sa)),
        "microprice": F.when(sb + sa > 0, (F.col("best_bid") * sa + F.col("best_ask") * sb) / (sb + sa)).otherwise(mid),
        "_tb": total(F.col("_b")), "_ta": total(F.col("_a")), "_n": F.least(F.size("bids"), F.size("asks")),
        "smart_bid_depth": smart_depth(F.col("bids"), mid, 1), "smart_ask_depth": smart_depth(F.col("asks"), mid, -1),
    }
    for lo, hi in bands:
        first[f"bid_vol_band_{key(lo, hi)}"] = band_volume(F.col("bids"), mid, 1, lo, hi)
        first[f"ask_vol_band_{key(lo, hi)}"] = band_volume(F.col("asks"), mid, -1, lo, hi)
    for s, c in (("bid", "bids"), ("ask", "asks")):
        top = truncate(F.col(c), NEAR)
        first[f"vwap_{s}_5"] = ratio(notional(top), total(top))
        first[f"{s}_slope_simple"] = slope_simple(F.col(c))
    df = df.withColumns(first)
    slope_n, cog_n = F.least(F.col("_n"), F.lit(SLOPE_LEVELS)), F.least(F.col("_n"), F.lit(COG_LEVELS))
    cb, ca = F.slice("bids", F.lit(1), cog_n), F.slice("asks", F.lit(1), cog_n)
    df = df.withColumns({
        "bid_slope_regression": slope_regression(F.col("bids"), mid, 1, slope_n), "ask_slope_regression": slope_regression(F.col("asks"), mid, -1, slope_n),
        "center_of_gravity": F.when((cog_n >= 1) & (mid > 0), ratio(notional(cb) + notional(ca), total(cb) + total(ca))),
    })
    out: dict[str, Column] = {c: F.col(c) for c in ("best_bid", "best_ask", "mid_price", "spread")}
    out["relative_spread"] = F.when(mid > 0, F.col("spread") / mid)
    out |= {c: F.col(c) for c in ("imbalance_L1", "microprice")}
    for i in range(max_levels):
        for s, c in (("bid", "bids"), ("ask", "asks")):
            out[f"{s}_price_L{i}"] = one(c, i, "price")
            out[f"{s}_size_L{i}"] = F.coalesce(one(c, i, "size"), F.lit(0.0))
    if max_levels < 2:  # with two levels and more, L1 is the second level
        out["bid_size_L1"], out["ask_size_L1"] = sb, sa
    for lo, hi in bands:
        b, a = F.col(f"bid_vol_band_{key(lo, hi)}"), F.col(f"ask_vol_band_{key(lo, hi)}")
        out |= {f"bid_vol_band_{key(lo, hi)}": b, f"ask_vol_band_{key(lo, hi)}": a, f"imb_band_{key(lo, hi)}": F.when(mid > 0, imbalance(b, a))}
    for s, c, t in (("bid", "_b", "_tb"), ("ask", "_a", "_ta")):
        out[f"{s}_50pct_depth_levels"] = half_depth(F.col(c), F.col(t))
        out[f"{s}_concentration"] = concentration(F.col(c), F.col(t))
    out |= {"vwap_bid_5": F.col("vwap_bid_5"), "vwap_ask_5": F.col("vwap_ask_5"), "vwap_spread": F.col("vwap_ask_5") - F.col("vwap_bid_5")}
    sd, ad = F.col("smart_bid_depth"), F.col("smart_ask_depth")
    out |= {"smart_bid_depth": sd, "smart_ask_depth": ad, "smart_depth_imbalance": imbalance(sd, ad)}
    both = lambda *ks: sum((F.col(f"{s}_vol_band_{k}") for k in ks for s in ("bid", "ask")), F.lit(0.0))
    have = [key(*b) for b in bands]
    near = both(*[k for k in ("0_5bps",) if k in have])
    out["lambda_like"] = ratio(F.col("spread"), near)
    out["amihud_like"] = ratio(F.col("spread"), both(*[k for k in ("0_5bps", "5_10bps") if k in have]))
    for s in ("bid", "ask"):
        out[f"{s}_slope_simple"] = F.col(f"{s}_slope_simple")
        out[f"{s}_slope_regression"] = F.col(f"{s}_slope_regression")
    out["slope_asymmetry"] = ratio(F.col("bid_slope_regression"), F.col("ask_slope_regression"))
    out["center_of_gravity"] = F.col("center_of_gravity")
    out["cog_vs_mid"] = (F.col("center_of_gravity") - mid) / mid * 10000
    far = [key(lo, hi) for lo, hi in bands if hi <= 50]
    out["book_convexity"] = F.when(mid > 0, ratio(near, both(*far))) if 5 in bands_bps and 50 in bands_bps else F.lit(None).cast("double")
    deep = (F.size("bids") >= NEAR) & (F.size("asks") >= NEAR)
    decay = lambda c: F.when(deep, ratio(one(c, NEAR - 1, "size"), one(c, 0, "size")))
    out |= {"bid_depth_decay_5": decay("bids"), "ask_depth_decay_5": decay("asks"), "avg_depth_decay_5": (decay("bids") + decay("asks")) / 2}
    tb, ta = F.col("_tb"), F.col("_ta")
    out |= {"book_pressure": F.when(mid.isNotNull(), imbalance(tb, ta)), "total_bid_volume": F.when(mid.isNotNull(), tb), "total_ask_volume": F.when(mid.isNotNull(), ta)}
    out |= {"bid_slope": F.col("bid_slope_simple"), "ask_slope": F.col("ask_slope_simple")}
    raw = ["bids", "asks"] if keep_raw_arrays else []
    return df.select(*carry, *[c.alias(n) for n, c in out.items() if n not in carry], *raw)


def best_quotes(df: DataFrame) -> DataFrame:
    """Best prices and amounts, spread and mid of each snapshot; null where a side is missing."""
    rest = [c for c in df.columns if c not in ("bids", "asks")]
    d = normalise(df)
    b, a = F.get("bids", F.lit(0)), F.get("asks", F.lit(0))
    return d.select(*rest, b["price"].alias("best_bid"), b["size"].alias("best_bid_amount"), a["price"].alias("best_ask"), a["size"].alias("best_ask_amount"), (a["price"] - b["price"]).alias("spread"), ((a["price"] + b["price"]) / 2).alias("mid_price"))


def research_features(df: DataFrame) -> DataFrame:
    """The second set of features: depth sums at clamped depths, notional pressure, signed slopes and others."""
    rest = [c for c in df.columns if c not in ("bids", "asks")]
    d = normalise(df)
    one = lambda s, i, f: F.get(F.col(s), F.lit(i))[f]
    bb, ba, sb, sa = one("bids", 0, "price"), one("asks", 0, "price"), F.coalesce(one("bids", 0, "size"), F.lit(0.0)), F.coalesce(one("asks", 0, "size"), F.lit(0.0))
    mid, n = (bb + ba) / 2, F.least(F.size("bids"), F.size("asks"))
    cut = lambda s, k: F.slice(F.col(s), F.lit(1), F.least(n, F.lit(k)))
    free = lambda s, k: truncate(F.col(s), k)
    out: dict[str, Column] = {"best_bid": bb, "best_ask": ba, "mid_price": mid, "spread": ba - bb, "spread_bps": ratio(ba - bb, mid) * 10000, "relative_spread": ratio(ba - bb, mid)}
    out |= {"bid_size_level_0": sb, "ask_size_level_0": sa, "ofi_level_0": imbalance(sb, sa)}
    for i in range(10):  # levels both sides have
        for c, s in (("bids", "bid"), ("asks", "ask")):
            there = lambda f: F.when(n > i, one(c, i, f))
            out[f"{s}_price_level_{i}"] = there("price")
            out.setdefault(f"{s}_size_level_{i}", there("size"))
    for k in (5, 10, 20, 50):
        b, a = total(cut("bids", k)), total(cut("asks", k))
        out |= {f"bid_volume_{k}": b, f"ask_volume_{k}": a, f"total_volume_{k}": b + a, f"volume_imbalance_{k}": imbalance(b, a)}
    out["weighted_oi_5"] = imbalance(notional(free("bids", 5)), notional(free("asks", 5)))
    out["notional_pressure_10"] = imbalance(notional(free("bids", 10)), notional(free("asks", 10)))
    for s, c, best, keep in (("bid", "bids", bb, lambda x: x["price"] >= bb * 0.999), ("ask", "asks", ba, lambda x: x["price"] <= ba * 1.001)):
        top = free(c, 10)
        last = F.element_at(F.transform(top, lambda x: x["price"]), -1)
        out[f"{s}_level_spacing_mean"] = F.when(F.size(c) >= 2, (last - best) / (F.size(top) - 1)).otherwise(F.lit(0.0))
        out[f"{s}_depth_10bps"] = total(F.filter(F.col(c), keep))
        near = free(c, 5)
        out[f"vwap_{s}_5"] = F.when(F.size(c) >= 5, ratio(notional(near), total(near)))
        whole = total(F.col(c))
        out[f"{s}_50pct_depth"] = F.when(whole > 0, half_depth(F.col(c), whole)).otherwise(F.lit(0))
        out[f"{s}_concentration"] = F.when(whole > 0, F.aggregate(top, F.lit(0.0), lambda a, x: a + x["size"] * x["size"]) / (whole * whole)).otherwise(F.lit(0.0))
        out[f"{s}_slope"] = F.when(F.size(c) >= 5, F.coalesce(ratio(one(c, 4, "price") - best, total(near)), F.lit(0.0))).otherwise(F.lit(0.0))
        v5 = total(cut(c, 5))
        out[f"kyle_lambda_{s}"] = F.when(v5 > 0, (ba - bb) / (2 * v5))
        sign = 1 if s == "bid" else -1
        out[f"smart_{s}_depth"] = F.aggregate(F.col(c), F.lit(0.0), lambda a, x: a + x["size"] * F.exp(-SMART_DECAY * (sign * (mid - x["price"]) / mid)))
    for k in (3, 5, 10):
        out[f"volume_ratio_{k}"] = ratio(total(free("bids", k)), total(free("asks", k)))
    out["vwap_spread"] = out["vwap_ask_5"] - out["vwap_bid_5"]
    out["vw_spread"] = F.coalesce(out["vwap_spread"], ba - bb)
    out["microprice"] = ratio(bb * sa + ba * sb, sb + sa)
    out["effective_spread"] = 2 * F.abs(out["microprice"] - mid)
    out["smart_depth_imbalance"] = imbalance(out["smart_bid_depth"], out["smart_ask_depth"])
    out["amihud_illiquidity"] = ratio(ba - bb, out["bid_volume_10"] + out["ask_volume_10"])
    return d.select(*rest, *[c.alias(k) for k, c in out.items()])
