"""Bars by time and by volume, VPIN, and aggregates over windows of time.

Open and close are those of the first and last row by (ts, seq). Null prices are no prices. All groupings
combine on the map side, so a hot key is no hot task; the volume clock's running sums are taken in two steps, within and
across stretches of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideframe.functions import normal
from tideframe.operators import split


def _mean_all(c: str) -> Column:
    """Sum of the values there are over the number of all rows."""
    return F.coalesce(F.sum(c), F.lit(0.0)) / F.count("*")


def time_bars(df: DataFrame, by: list[str], durations: tuple[int, ...], ts: str = "ts", seq: str = "seq", keep_open: bool = False) -> DataFrame:
    """Bars of ``mid`` with spread, flow and variance statistics; one row for each key, duration (s) and bar with rows.

    Needs mid, spread, rel_spread, ofi, l1_imb, log_ret and mlofi. The newest bar of each key is still open and left out
    unless ``keep_open``; no empty bars are made. ``sum_mlofi_decay`` is a true sum, ``close_step_mlofi`` the step of the row that
    closed the bar.
    """
    d = df.withColumn("duration", F.explode(F.array(*[F.lit(x) for x in durations]))).withColumn("bar_start", F.expr(f"{ts} - pmod({ts}, duration * 1000L)"))
    order = F.struct(ts, seq)
    value = lambda c: F.when(F.col(c).isNotNull(), F.struct(ts, seq, c))
    b = d.groupBy(*by, "duration", "bar_start").agg(
        F.min(value("mid")).alias("_o"), F.max("mid").alias("high"), F.min("mid").alias("low"), F.max(value("mid")).alias("_c"),
        _mean_all("spread").alias("mean_spread"), _mean_all("rel_spread").alias("mean_relative_spread"), _mean_all("l1_imb").alias("mean_l1_imbalance"),
        F.min("spread").alias("min_spread"), F.max("spread").alias("max_spread"), F.sum("ofi").alias("sum_ofi"), F.coalesce(F.var_samp("log_ret"), F.lit(0.0)).alias("realized_variance"),
        F.count("*").alias("count"), F.sum("mlofi").alias("sum_mlofi_decay"), F.min(F.struct(order.alias("o"), F.col("mlofi").alias("m"))).alias("_f"),
    )
    w = W.partitionBy(*by, "duration").orderBy("bar_start")
    b = b.withColumns({"close_step_mlofi": F.lead("_f.m").over(w), "_next": F.lead("bar_start").over(w)})
    if not keep_open:
        b = b.filter("_next is not null")
    cols = ["high", "low"]
    stats = ["mean_spread", "mean_relative_spread", "mean_l1_imbalance", "min_spread", "max_spread", "sum_ofi", "realized_variance", "count", "sum_mlofi_decay", "close_step_mlofi"]
    day = F.date_format(F.timestamp_millis("bar_start"), "yyyy-MM-dd").alias("date")
    return b.select(*by, "duration", "bar_start", F.col("_o.mid").alias("open"), *cols, F.col("_c.mid").alias("close"), *stats, day)


def running_sum(df: DataFrame, by: list[str], order: list[str], value: str, out: str, stretch: Column | None = None) -> DataFrame:
    """Sum of ``value`` over the rows of the key before and including each.

    With ``stretch``, a number that rises with the order, sums are taken within stretches and then carried across them.
    """
    if stretch is None:
        return df.withColumn(out, F.sum(value).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
    d = df.withColumn("_st", stretch)
    sums = d.groupBy(*by, "_st").agg(F.sum(value).alias("_s"))
    carry = F.coalesce(F.sum("_s").over(W.partitionBy(*by).orderBy("_st").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast(df.schema[value].dataType))
    sums = sums.select(*by, "_st", carry.alias("_carry"))
    within = F.sum(value).over(W.partitionBy(*by, "_st").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return d.withColumn("_w", within).join(sums, [*by, "_st"]).withColumn(out, F.col("_w") + F.col("_carry")).drop("_st", "_w", "_carry")


#: Volumes are counted in whole units of this size, so that a bar's edge is exact.
UNIT = 1e-8


def volume_fills(df: DataFrame, by: list[str], threshold: float, ts: str = "ts", seq: str = "seq", volume: str = "volume", hot: list | None = None) -> DataFrame:
    """Trades cut at the edges of volume buckets: one row for each trade and bucket it fills, with ``bucket`` and ``fill``.

    Volume is kept whole; trades without a positive volume fill nothing.
    """
    unit = F.round(F.col(volume) / UNIT).cast("long")
    size = round(threshold / UNIT)
    d = df.withColumn("_u", unit).filter("_u > 0")
    d = running_sum(d, by, [ts, seq], "_u", "_cum", F.expr(f"{ts} div 3600000") if hot is None or hot else None)
    first, last = F.expr(f"(_cum - _u) div {size}"), F.expr(f"(_cum - 1) div {size}")
    d = d.withColumn("bucket", F.explode(F.sequence(first, last)))
    lo, hi = F.greatest(F.col("_cum") - F.col("_u"), F.col("bucket") * size), F.least(F.col("_cum"), (F.col("bucket") + 1) * size)
    return d.withColumn("_fill", hi - lo).withColumn("fill", F.col("_fill") * UNIT).drop("_u", "_cum")


def volume_bars(df: DataFrame, by: list[str], threshold: float, ts: str = "ts", seq: str = "seq", price: str = "price", volume: str = "volume", side: str = "side") -> DataFrame:
    """Bars of ``threshold`` volume each; a bar opens at the price and time at which the one before was completed. The open last bar is left out."""
    hot = split.hot_keys(df, by)
    f = volume_fills(df, by, threshold, ts, seq, volume, hot)
    s = normal.trade_side(side)
    last = F.max(F.struct(ts, seq, price)).alias("_l")
    part = lambda k: (F.sum(F.when(s == k, F.col("_fill")).otherwise(F.lit(0))) * UNIT).alias(f"{k}_volume")
    b = f.groupBy(*by, "bucket").agg(
        F.min(F.struct(ts, seq, price)).alias("_f"), last, F.max(price).alias("_h"), F.min(price).alias("_lo"), F.sum("_fill").alias("_v"), part("buy"), part("sell"),
        F.sum(F.col(price) * F.col("_fill")).alias("_pv"), F.count("*").alias("trade_count"),
    )
    b = split.split_hot(b, by, "bucket", last_rows=1, bucket=1024, hot=hot)
    w = W.partitionBy(*by, split.CHUNK).orderBy("bucket")
    b = b.withColumns({"open": F.coalesce(F.lag(f"_l.{price}").over(w), F.col(f"_f.{price}")), "start_time": F.coalesce(F.lag(f"_l.{ts}").over(w), F.col(f"_f.{ts}"))})
    b = split.own(b).filter(F.col("_v") >= round(threshold / UNIT))
    v = F.col("_v") * UNIT
    return b.select(
        *by, "bucket", "open", F.greatest("_h", "open").alias("high"), F.least("_lo", "open").alias("low"), F.col(f"_l.{price}").alias("close"), v.alias("volume"), "buy_volume", "sell_volume",
        (F.col("_pv") / F.col("_v")).alias("vwap"), (F.col("buy_volume") / v).alias("buy_ratio"), "trade_count", "start_time", F.col(f"_l.{ts}").alias("end_time"),
    )


def tick_side(df: DataFrame, by: list[str], ts: str, seq: str, price: str, side: str | None, hot: list | None = None) -> DataFrame:
    """Adds ``_buy``, the bought share of each trade: by its side, else 1 on a rise of price, 0 on a fall, 0.5 on neither."""
    d = split.split_hot(df, by, ts, last_rows=1, order=[seq], hot=hot)
    before = F.lag(price).over(W.partitionBy(*by, split.CHUNK).orderBy(ts, seq))
    rule = F.when(F.col(price) > before, 1.0).when(F.col(price) < before, 0.0).otherwise(F.lit(0.5))
    if side is not None:
        s = normal.trade_side(side)
        rule = F.when(s == "buy", 1.0).when(s == "sell", 0.0).otherwise(rule)
    return split.own(d.withColumn("_buy", rule))


def vpin(df: DataFrame, by: list[str], bucket_volume: float, window_buckets: int = 50, ts: str = "ts", seq: str = "seq", price: str = "price", volume: str = "volume", side: str | None = "side") -> DataFrame:
    """Each complete volume bucket with its bought and sold volume and VPIN, the mean imbalance of the last buckets."""
    hot = split.hot_keys(df, by)
    d = volume_fills(tick_side(df, by, ts, seq, price, side, hot), by, bucket_volume, ts, seq, volume, hot)
    size = round(bucket_volume / UNIT)
    b = d.groupBy(*by, "bucket").agg(F.sum("_fill").alias("_v"), F.sum(F.col("_fill") * F.col("_buy")).alias("_b")).filter(F.col("_v") >= size)
    b = split.split_hot(b, by, "bucket", last_rows=window_buckets - 1, bucket=1024, hot=hot)
    w = W.partitionBy(*by, split.CHUNK).orderBy("bucket").rowsBetween(-(window_buckets - 1), 0)
    b = split.own(b.withColumn("vpin", F.sum(F.abs(2 * F.col("_b") - F.col("_v"))).over(w) / (F.count("*").over(w) * size)))
    return b.select(*by, "bucket", (F.col("_b") * UNIT).alias("buy_volume"), ((F.col("_v") - F.col("_b")) * UNIT).alias("sell_volume"), "vpin")


def window_ohlcv(df: DataFrame, by: list[str], seconds: int, ts: str = "ts", seq: str = "seq", price: str = "price", volume: str = "volume") -> DataFrame:
    """vwap, volume and open, high, low, close of each window of time."""
    d = df.withColumn("window_start", F.expr(f"{ts} - pmod({ts}, {seconds * 1000}L)"))
    p = F.when(F.col(price).isNotNull(), F.struct(ts, seq, price))
    a = d.groupBy(*by, "window_start").agg(
        F.sum(F.col(price) * F.col(volume)).alias("_pv"), F.sum(F.when(F.col(price).isNotNull(), F.col(volume))).alias("volume"),
        F.min(price).alias("low"), F.max(price).alias("high"), F.min(p).alias("_o"), F.max(p).alias("_c"), F.count(price).alias("trades"),
    )
    return a.select(*by, "window_start", F.when(F.col("volume") > 0, F.col("_pv") / F.col("volume")).alias("vwap"), "volume", F.col(f"_o.{price}").alias("open"), "high", "low", F.col(f"_c.{price}").alias("close"), "trades")
