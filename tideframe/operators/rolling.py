"""Rolling statistics over the window (t - h, t], of the rows already seen.

A row sees the rows of its key with a time in (t - h, t] that do not come after it in order, so of rows with the same
time only the earlier ones. Additive statistics take the range frame with all peers and subtract the later ones;
rank statistics filter the collected frame. Values are centred on the key's first before squares are
summed, so that a large mean costs no precision. Null values are left out; an empty window gives 0 for sums, means,
deviations, lambda and R2, and 0.5 for a rank.

Times are whole milliseconds in a long column ``ts``, horizons are seconds, ``seq`` orders rows of the same time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideframe.operators import asof, split

#: Variances below this are taken as none.
FLOOR = 1e-10
FIRST = W.unboundedPreceding


@dataclass
class Rolling:
    """Rolling expressions over ``by``, ``ts`` and ``seq`` of one DataFrame."""

    by: list[str]
    ts: str = "ts"
    seq: str = "seq"
    parts: list[str] = field(default_factory=lambda: [split.CHUNK])

    @property
    def keys(self) -> list[str]:
        return [*self.by, *self.parts]

    def seen(self):
        """Everything up to and including the row."""
        return W.partitionBy(*self.keys).orderBy(self.ts, self.seq).rowsBetween(FIRST, 0)

    def frame(self, h: float):
        return W.partitionBy(*self.keys).orderBy(self.ts).rangeBetween(-(int(h * 1000) - 1), 0)

    def later_peers(self):
        return W.partitionBy(*self.keys, self.ts).orderBy(self.seq).rowsBetween(1, W.unboundedFollowing)

    def add(self, x: Column, h: float) -> Column:
        """Sum of x; 0 if empty."""
        return F.coalesce(F.sum(x).over(self.frame(h)), F.lit(0.0)) - F.coalesce(F.sum(x).over(self.later_peers()), F.lit(0.0))

    def count(self, x: Column, h: float) -> Column:
        return F.count(x).over(self.frame(h)) - F.count(x).over(self.later_peers())

    def mean(self, x: Column, h: float) -> Column:
        n = self.count(x, h)
        return F.when(n > 0, self.add(x, h) / n).otherwise(F.lit(0.0))

    def centre(self, x: str) -> Column:
        """The first value of the key (or chunk), a number near all the others."""
        return F.coalesce(F.first(x, ignorenulls=True).over(W.partitionBy(*self.keys).orderBy(self.ts, self.seq).rowsBetween(FIRST, W.unboundedFollowing)), F.lit(0.0))

    @staticmethod
    def variance_of(n: Column, s: Column, ss: Column) -> Column:
        return F.when(n > 1, F.greatest((ss - s * s / n) / (n - 1), F.lit(0.0))).otherwise(F.lit(0.0))

    def values(self, x: str, h: float) -> Column:
        """The window's values as an array, for ranks."""
        seen = F.collect_list(F.struct(F.col(self.seq).alias("s"), F.col(self.ts).alias("t"), F.col(x).alias("v"))).over(self.frame(h))
        return F.transform(F.filter(seen, lambda e: ((e["t"] < F.col(self.ts)) | (e["s"] <= F.col(self.seq))) & e["v"].isNotNull()), lambda e: e["v"])


def prepare(df: DataFrame, by: list[str], ts: str, seq: str, horizon: float, rows_per_chunk: int = split.ROWS_PER_CHUNK, hot: list | None = None) -> DataFrame:
    """Chunks for windows of up to ``horizon`` seconds."""
    return split.split_hot(df, by, ts, horizon=int(horizon * 1000), rows_per_chunk=rows_per_chunk, hot=hot)


def rolling_sum(df: DataFrame, by: list[str], ts: str, seq: str, x: str, h: float, out: str | None = None, rows_per_chunk: int = split.ROWS_PER_CHUNK) -> DataFrame:
    """Adds sum, mean and count of ``x`` over the last h seconds."""
    r, name = Rolling(by, ts, seq), out or f"{x}_{h:g}s"
    d = prepare(df, by, ts, seq, h, rows_per_chunk)
    d = d.withColumns({f"{name}_sum": r.add(F.col(x).cast("double"), h), f"{name}_n": r.count(F.col(x), h)})
    d = d.withColumn(f"{name}_mean", F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_sum") / F.col(f"{name}_n")).otherwise(F.lit(0.0)))
    return split.own(d)


def rolling_moments(df: DataFrame, by: list[str], ts: str, seq: str, x: str, h: float, out: str | None = None, hold: bool = False, rows_per_chunk: int = split.ROWS_PER_CHUNK) -> DataFrame:
    """Adds mean, var (sample) and std of ``x``; with ``hold`` rows without a value keep the last state."""
    r, name = Rolling(by, ts, seq), out or f"{x}_{h:g}s"
    d = prepare(df, by, ts, seq, h, rows_per_chunk).withColumn("_c", r.centre(x)).withColumn("_x", F.col(x) - F.col("_c"))
    d = _moments(d, r, "_x", h)
    d = d.withColumns({"_m": F.when(F.col("_x_n") > 0, F.col("_c") + F.col("_x_s") / F.col("_x_n")).otherwise(F.lit(0.0)), "_v": r.variance_of(F.col("_x_n"), F.col("_x_s"), F.col("_x_ss"))})
    names = {f"{name}_mean": F.col("_m"), f"{name}_var": F.col("_v"), f"{name}_std": F.sqrt("_v")}
    d = split.own(d.withColumns({n: F.when(F.col(x).isNotNull(), c) if hold else c for n, c in names.items()}).drop("_c", "_x", "_x_n", "_x_s", "_x_ss", "_m", "_v"))
    if hold:
        d = asof.fill_forward(d, by, ts, seq, list(names), hot=split.hot_keys(df, by, rows_per_chunk))
        d = d.withColumns({n: F.coalesce(n, F.lit(0.0)) for n in names})
    return d


def _moments(d: DataFrame, r: Rolling, x: str, h: float) -> DataFrame:
    c = F.col(x)
    return d.withColumns({f"{x}_n": r.count(c, h), f"{x}_s": r.add(c, h), f"{x}_ss": r.add(c * c, h)})


def welford(df: DataFrame, by: list[str], ts: str, seq: str, x: str, out: str | None = None, stretch: int = asof.STRETCH, rows_per_chunk: int = split.ROWS_PER_CHUNK) -> DataFrame:
    """Adds the unbounded running count, mean and sample variance (0 for fewer than two values).

    With hot keys, values are centred on the key's mean and their running sums taken within stretches of time and
    carried across them, so no task holds a key's whole history.
    """
    name = out or x
    if not split.hot_keys(df, by, rows_per_chunk):
        w = W.partitionBy(*by).orderBy(ts, seq).rowsBetween(FIRST, 0)
        return df.withColumns({f"{name}_n": F.count(x).over(w), f"{name}_mean": F.coalesce(F.avg(x).over(w), F.lit(0.0)), f"{name}_var": F.coalesce(F.var_samp(x).over(w), F.lit(0.0))})
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]
    centre = df.groupBy(*by).agg(F.coalesce(F.avg(x), F.lit(0.0)).alias("_c")).select(*keys, "_c")
    d = df.join(centre, on, "left").drop(*[f"_k{i}" for i in range(len(by))]).withColumn("_st", F.expr(f"`{ts}` div {stretch}"))
    v = F.col(x) - F.col("_c")
    d = d.withColumns({"_n": F.col(x).isNotNull().cast("long"), "_d": F.coalesce(v, F.lit(0.0)), "_dd": F.coalesce(v * v, F.lit(0.0))})
    parts = ["_n", "_d", "_dd"]
    w = W.partitionBy(*by).orderBy("_st").rowsBetween(FIRST, -1)
    sums = d.groupBy(*by, "_st").agg(*[F.sum(c).alias(c) for c in parts])
    sums = sums.select(*keys, F.col("_st").alias("_ks"), *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}0") for c in parts])
    inner = W.partitionBy(*by, "_st").orderBy(ts, seq).rowsBetween(FIRST, 0)
    d = d.withColumns({f"{c}1": F.sum(c).over(inner) for c in parts}).join(sums, [*on, F.col("_st").eqNullSafe(F.col("_ks"))], "left")
    n, s, ss = (F.col(f"{c}0") + F.col(f"{c}1") for c in parts)
    return d.select(*df.columns, n.cast("long").alias(f"{name}_n"), F.when(n > 0, F.col("_c") + s / n).otherwise(F.lit(0.0)).alias(f"{name}_mean"), Rolling.variance_of(n, s, ss).alias(f"{name}_var"))


def percentile_rank(df: DataFrame, by: list[str], ts: str, seq: str, x: str, h: float, points: tuple[float, ...] = (), out: str | None = None, rows_per_chunk: int = split.ROWS_PER_CHUNK) -> DataFrame:
    """Adds the rank of ``x`` in its window, #(v < x) / n, and for each point p the value at index int(p (n - 1)) of the sorted window.

    A null x is not in the window and ranks 0, or 0.5 if the window is empty.
    """
    r, name = Rolling(by, ts, seq), out or x
    d = prepare(df, by, ts, seq, h, rows_per_chunk).withColumn("_vals", r.values(x, h))
    n = F.size("_vals")
    below = F.size(F.filter("_vals", lambda v: v < F.col(x)))
    cols = {f"{name}_rank": F.when(n > 0, F.coalesce(F.when(F.col(x).isNotNull(), below), F.lit(0)) / n).otherwise(F.lit(0.5))}
    for p in points:
        cols[f"{name}_p{p * 100:g}"] = F.get(F.array_sort("_vals"), (F.lit(p) * (n - 1)).cast("int"))
    return split.own(d.withColumns(cols).drop("_vals"))


def regime_fractions(df: DataFrame, by: list[str], ts: str, seq: str, regime: str, h: float, regimes: tuple[str, ...], rows_per_chunk: int = split.ROWS_PER_CHUNK) -> DataFrame:
    """Adds the share of the last h seconds spent in each regime; the time up to a row is charged to the regime before it."""
    hot = split.hot_keys(df, by, rows_per_chunk)
    d = since_last(df, by, ts, seq, regime, rows_per_chunk, hot)
    d = prepare(d, by, ts, seq, h, rows_per_chunk, hot)
    return split.own(d.withColumns(time_shares(Rolling(by, ts, seq), h, regime, regimes)).drop("_dt", "_pr"))


def since_last(df: DataFrame, by: list[str], ts: str, seq: str, regime: str, rows_per_chunk: int = split.ROWS_PER_CHUNK, hot: list | None = None) -> DataFrame:
    """Adds ``_dt``, the time since the row before, and ``_pr``, that row's regime."""
    d = split.split_hot(df, by, ts, last_rows=1, order=[seq], rows_per_chunk=rows_per_chunk, hot=hot)
    o = W.partitionBy(*by, split.CHUNK).orderBy(ts, seq)
    return split.own(d.withColumns({"_dt": (F.col(ts) - F.lag(ts).over(o)).cast("double"), "_pr": F.lag(regime).over(o)}))


def time_shares(r: Rolling, h: float, regime: str, regimes: tuple[str, ...]) -> dict[str, Column]:
    """Share of each regime in the time of the window; peers of a row add no time, so the plain frame does."""
    whole = F.coalesce(F.sum("_dt").over(r.frame(h)), F.lit(0.0))
    part = lambda k: F.coalesce(F.sum(F.when(F.col("_pr") == k, F.col("_dt"))).over(r.frame(h)), F.lit(0.0))
    return {f"{regime}_{k}_frac": F.when(whole > 0, part(k) / whole).otherwise(F.lit(0.0)) for k in regimes}


def kyle_lambda(df: DataFrame, by: list[str], ts: str, seq: str, ret: str, flow: str, h: float, rows_per_chunk: int = split.ROWS_PER_CHUNK) -> DataFrame:
    """Adds kyle_lambda = cov(ret, flow) / var(flow) and its R2; 0 for fewer than two rows or a variance below the floor."""
    r = Rolling(by, ts, seq)
    d = prepare(df, by, ts, seq, h, rows_per_chunk)
    a, b = F.col(ret), F.col(flow)
    both = a.isNotNull() & b.isNotNull()
    d = d.withColumns({"_n": r.count(F.when(both, a), h), "_a": r.add(F.when(both, a), h), "_b": r.add(F.when(both, b), h), "_aa": r.add(F.when(both, a * a), h), "_bb": r.add(F.when(both, b * b), h), "_ab": r.add(F.when(both, a * b), h)})
    n = F.col("_n")
    cov, va, vb = (F.when(n > 0, F.col(x) / n - F.col(y) / n * F.col(z) / n) for x, y, z in (("_ab", "_a", "_b"), ("_aa", "_a", "_a"), ("_bb", "_b", "_b")))
    lam = F.when((n >= 2) & (vb >= FLOOR), cov / vb).otherwise(F.lit(0.0))
    r2 = F.when((n >= 2) & (vb >= FLOOR) & (va >= FLOOR), cov * cov / (va * vb)).otherwise(F.lit(0.0))
    return split.own(d.withColumns({"kyle_lambda": lam, "kyle_lambda_r2": r2}).drop("_n", "_a", "_b", "_aa", "_bb", "_ab"))
