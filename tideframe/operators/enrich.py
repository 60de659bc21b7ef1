"""Derived columns of ticker, trade and level-2 rows. A column is added only where its inputs are there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.functions import normal
from tideframe.functions.timefn import add_time_fields


def has(df: DataFrame, *names: str) -> bool:
    return all(n in df.columns for n in names)


def quote_spread(df: DataFrame) -> DataFrame:
    """spread and spread_pct (of the bid; null unless it is positive) of bid and ask."""
    if not has(df, "bid", "ask"):
        return df
    return df.withColumns({"spread": F.col("ask") - F.col("bid"), "spread_pct": F.when(F.col("bid") > 0, (F.col("ask") - F.col("bid")) / F.col("bid") * 100)})


def unified_ticker(df: DataFrame) -> DataFrame:
    return quote_spread(add_time_fields(df, "datetime", "timestamp"))


def unified_trades(df: DataFrame) -> DataFrame:
    return add_time_fields(df, "datetime", "timestamp")


def advanced_ticker(df: DataFrame, derived: bool = True) -> DataFrame:
    """Mid, spread and spread_bps where both quotes are positive; the day's range."""
    if not derived:
        return df
    d = add_time_fields(df, "server_timestamp", "capture_timestamp")
    if has(d, "best_bid", "best_ask"):
        b, a = F.col("best_bid"), F.col("best_ask")
        ok = (b > 0) & (a > 0)
        d = d.withColumns({"mid_price": F.when(ok, (b + a) / 2), "spread": F.when(ok, a - b), "spread_bps": F.when(ok, (a - b) / ((b + a) / 2) * 10000)})
    if has(d, "high_24h", "low_24h"):
        h, lo = F.col("high_24h"), F.col("low_24h")
        ok = (h > 0) & (lo > 0)
        d = d.withColumns({"range_24h": F.when(ok, h - lo), "range_24h_pct": F.when(ok, (h - lo) / lo * 100)})
    return d


def advanced_trades(df: DataFrame, derived: bool = True) -> DataFrame:
    if not derived:
        return df
    d = add_time_fields(df, "time", "server_timestamp")
    if has(d, "price", "size"):
        d = d.withColumn("value", F.col("price") * F.col("size"))
    return d.withColumn("side_normalized", normal.trade_side(F.coalesce("side", F.lit("")))) if has(d, "side") else d


def level2(df: DataFrame, derived: bool = True) -> DataFrame:
    if not derived:
        return df
    d = add_time_fields(df, "event_time", "server_timestamp")
    if has(d, "event_type"):
        d = d.withColumn("is_snapshot", F.col("event_type") == "snapshot")
    if has(d, "side"):
        d = d.withColumn("side_normalized", F.when(F.col("side") == "offer", "ask").otherwise(F.coalesce("side", F.lit("bid"))))
    return d


def only_channels(df: DataFrame, *channels: str) -> DataFrame:
    return df.filter(F.col("channel").isin(*channels))


def keyed(df: DataFrame) -> DataFrame:
    """Rows with an exchange and a symbol, and their key."""
    return df.filter("exchange is not null and symbol is not null").withColumn("key", F.concat_ws(":", "exchange", "symbol"))


def chain(df: DataFrame, *steps) -> DataFrame:
    """One operator after the other; each takes and gives a DataFrame, and may drop or multiply rows."""
    for s in steps:
        df = df.transform(s)
    return df
