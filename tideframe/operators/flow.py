"""Changes from one snapshot of a key to the next: returns, order-flow imbalance, velocity.

Input: best quotes, and ``bids``/``asks`` arrays for the multi-level measures, with a millisecond time ``ts`` and
``seq`` for its order. A first row, or one next to a one-sided book, has return and flow 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideframe.operators import split


def level_flow(price: Column, size: Column, prev_price: Column, prev_size: Column, up: Column, down: Column) -> Column:
    return F.when(price > prev_price, up).when(price < prev_price, down).otherwise(size - prev_size)


def bid_flow(p: Column, s: Column, pp: Column, ps: Column) -> Column:
    return level_flow(p, s, pp, ps, s, -ps)


def ask_flow(p: Column, s: Column, pp: Column, ps: Column) -> Column:
    return level_flow(p, s, pp, ps, -ps, s)


def _levels_flow(cur: str, prev: str, levels: int, rule, alpha: float | None) -> Column:
    """Sum of the rule over the levels both books have, weighted by exp(-alpha i) if alpha is given."""
    n = F.least(F.size(cur), F.size(prev), F.lit(levels))
    cut = lambda c: F.slice(F.col(c), F.lit(1), n)
    each = F.zip_with(cut(cur), cut(prev), lambda x, y: rule(x["price"], x["size"], y["price"], y["size"]))
    if alpha is not None:
        each = F.transform(each, lambda v, i: v * F.exp(-alpha * i))
    return F.aggregate(each, F.lit(0.0), lambda a, v: a + v)


def snapshot_flow(df: DataFrame, by: list[str], ts: str = "ts", seq: str = "seq", levels: int = 10, alpha: float = 0.5, rows_per_chunk: int = split.ROWS_PER_CHUNK, hot: list | None = None) -> DataFrame:
    """Adds log_return_step, ofi_step, ofi_multi, mlofi_decay, mid_velocity, mid_accel and micro_minus_mid.

    Needs best_bid, best_ask, bid_size, ask_size, mid_price, microprice, bids and asks.
    """
    d = split.split_hot(df, by, ts, last_rows=2, order=[seq], rows_per_chunk=rows_per_chunk, hot=hot)
    w = W.partitionBy(*by, split.CHUNK).orderBy(ts, seq)
    lag = lambda c, k=1: F.lag(c, k).over(w)
    d = d.withColumns({
        "_pm": lag("mid_price"), "_pb": lag("best_bid"), "_pa": lag("best_ask"), "_psb": lag("bid_size"), "_psa": lag("ask_size"),
        "_pbids": lag("bids"), "_pasks": lag("asks"), "_t1": lag(ts), "_t0": lag(ts, 2), "_m0": lag("mid_price", 2),
    })
    ok = (F.col("mid_price") > 0) & (F.col("_pm") > 0)
    zero = F.lit(0.0)
    when_ok = lambda c: F.when(ok, c).otherwise(zero)
    l1 = bid_flow(F.col("best_bid"), F.col("bid_size"), F.col("_pb"), F.col("_psb")) - ask_flow(F.col("best_ask"), F.col("ask_size"), F.col("_pa"), F.col("_psa"))
    multi = lambda a: _levels_flow("bids", "_pbids", levels, bid_flow, a) - _levels_flow("asks", "_pasks", levels, ask_flow, a)
    dt1, dt0 = (F.col(ts) - F.col("_t1")) / 1000.0, (F.col("_t1") - F.col("_t0")) / 1000.0
    v1 = F.when(dt1 > 0, (F.col("mid_price") - F.col("_pm")) / dt1)
    v0 = F.when(dt0 > 0, (F.col("_pm") - F.col("_m0")) / dt0)
    cols = {
        "log_return_step": when_ok(F.ln(F.col("mid_price") / F.col("_pm"))), "ofi_step": when_ok(l1),
        "ofi_multi": when_ok(F.coalesce(multi(None), zero)), "mlofi_decay": when_ok(F.coalesce(multi(alpha), zero)),
        "mid_velocity": F.coalesce(v1, zero), "mid_accel": F.coalesce((v1 - v0) / ((dt1 + dt0) / 2), zero),
        "micro_minus_mid": F.when(F.col("mid_price") > 0, F.col("microprice") - F.col("mid_price")),
    }
    return split.own(d.withColumns(cols).drop("_pm", "_pb", "_pa", "_psb", "_psa", "_pbids", "_pasks", "_t1", "_t0", "_m0"))
