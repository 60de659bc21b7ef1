"""Queries of the market-data operators over the given tables, each with the same result in SQL.

Ticks are the rows of ``trades`` as delivered; quotes those of ``ticker``. Book snapshots are made of ``lineitem`` and
``orders``: an order's lines are its levels, its customer the key. Every query runs over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.config import FeatureConfig
from tideframe.functions import fs, normal, timefn
from tideframe.operators import asof, bars, book, dml, enrich, features, flow, layout, parse, rolling
from tideframe.session import scratch, spread
from tideframe.sources import segments, sinks, sync

KEY = ["exchange", "symbol"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ticks(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "trades").filter("timestamp is not null and price is not null")
    return t.select(normal.exchange("exchange").alias("exchange"), "symbol", F.col("timestamp").alias("ts"), F.col("rec_no").alias("seq"), "price", "amount", normal.trade_side("side").alias("side"), "date")


_TICKS = """(select lower(trim(exchange)) exchange, symbol, "timestamp" ts, rec_no seq, price, amount, case when upper(trim(side)) in ('BUY', 'B') then 'buy' when upper(trim(side)) in ('SELL', 'S') then 'sell' else lower(trim(side)) end side, date
 from trades where "timestamp" is not null and price is not null)"""


def quotes(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "ticker")
    return t.withColumns({"exchange": normal.exchange("exchange"), "symbol": normal.instrument("symbol")})


_QUOTES = """(select * replace (lower(trim(exchange)) as exchange, replace(symbol, '-', '/') as symbol) from ticker)"""


def books(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax")
    bid = F.struct((100 * (1 - F.col("l_discount") / 10)).alias("price"), F.col("l_quantity").alias("size"))
    ask = F.struct((100 * (1 + F.col("l_tax") / 10)).alias("price"), F.col("l_quantity").alias("size"))
    # An order has a handful of lines: the arrays are bounded by the data model. Lists do not shrink before the shuffle: plain lines are half their size.
    b = li.repartition("l_orderkey").groupBy("l_orderkey").agg(F.reverse(F.array_sort(F.collect_list(bid))).alias("bids"), F.array_sort(F.collect_list(ask)).alias("asks"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    j = b.join(o, b["l_orderkey"] == o["o_orderkey"])
    ts = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return j.select(F.col("o_orderstatus").alias("exchange"), F.col("o_custkey").cast("string").alias("symbol"), ts.alias("ts"), F.col("o_orderkey").alias("seq"), "bids", "asks")


_BOOKS = """(select o_orderstatus exchange, cast(o_custkey as varchar) symbol, epoch_ms(o_orderdate) ts, o_orderkey seq, bids, asks, bids[1].price bb, asks[1].price ba, bids[1].size sb, asks[1].size sa, (bids[1].price + asks[1].price) / 2 mid
 from (select l_orderkey, list_reverse_sort(list({'price': 100 * (1 - l_discount / 10), 'size': l_quantity})) bids, list_sort(list({'price': 100 * (1 + l_tax / 10), 'size': l_quantity})) asks from lineitem group by 1) b join orders o on o.o_orderkey = b.l_orderkey)"""

# Sample queries.


def s01_day_stats(spark: SparkSession, d: str) -> DataFrame:
    t = quotes(spark, d).filter("exchange = 'kelvane' and symbol = 'QVNT/USDX' and date = '2025-03-03'")
    return t.agg(F.count("*").alias("n"), F.min("bid").alias("low"), F.max("bid").alias("high"), F.round(F.avg("bid"), 6).alias("mean"))


def s02_top_products(spark: SparkSession, d: str) -> DataFrame:
    t = ticks(spark, d).filter(F.hour(F.timestamp_millis("ts")).isin(22, 23, 0))
    return t.groupBy(*KEY).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *KEY).limit(10)


def s03_hourly_average(spark: SparkSession, d: str) -> DataFrame:
    t = ticks(spark, d).filter(F.col("symbol").isin("KASP/USDX", "QVNT/USDX", "FENO/USDX"))
    return t.groupBy("symbol", F.expr("ts div 3600000").alias("hour")).agg(F.round(F.avg("price"), 6).alias("mean_price")).orderBy("symbol", "hour")


def s04_projection(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "ticker").filter((F.col("date") == "2025-03-04") & (F.col("exchange") == "kelvane"))
    return t.select("timestamp", "bid", "ask")


def s05_hourly_stats(spark: SparkSession, d: str) -> DataFrame:
    return quotes(spark, d).groupBy(*KEY, F.expr("timestamp div 3600000").alias("hour")).agg(F.count("*").alias("n"), F.round(F.avg("last"), 6).alias("mean"), F.min("last").alias("low"), F.max("last").alias("high"))


def s06_partition_agg(spark: SparkSession, d: str) -> DataFrame:
    """Written as a partitioned dataset, one partition of which is read."""
    at = scratch(spark, "dataset")
    sinks.write_dataset(quotes(spark, d).select("exchange", "symbol", "date", "bid", "ask", "last"), at, ["exchange", "date"])
    t = segments.read_dataset(spark, at, where=(F.col("exchange") == "kelvane") & (F.col("date").cast("string") == "2025-03-04"), merge=False)
    return t.agg(F.count("*").alias("n"), F.round(F.avg("bid"), 6).alias("mean_bid"), F.min("last").alias("low"), F.max("last").alias("high"))


def s07_hour_range(spark: SparkSession, d: str) -> DataFrame:
    t = quotes(spark, d).withColumn("hour", F.hour(F.timestamp_millis("timestamp"))).filter(F.col("hour").between(22, 23) & F.col("symbol").isin("KASP/USDX", "QVNT/USDX"))
    return t.groupBy(*KEY, "hour").agg(F.count("*").alias("n"), F.round(F.avg("ask"), 6).alias("mean_ask")).orderBy(*KEY, "hour")


def s08_partitions(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "ticker_files").select("file_no", "path", "n_bytes").distinct()
    return f.select(*segments.path_values(F.col("path"), "exchange", "symbol", "date"), "n_bytes").groupBy("exchange", "symbol", "date").agg(F.count("*").alias("files"), F.sum("n_bytes").alias("bytes"))


def s09_mid_spread(spark: SparkSession, d: str) -> DataFrame:
    q = enrich.quote_spread(quotes(spark, d).filter("bid > 0 and ask > 0"))
    return q.groupBy(*KEY, "date").agg(F.round(F.avg((F.col("bid") + F.col("ask")) / 2), 6).alias("mid"), F.round(F.avg("spread"), 6).alias("spread"), F.round(F.avg("spread_pct"), 6).alias("spread_pct"))


def s10_bars(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bars")
    return b.groupBy("duration", "exchange", "symbol").agg(F.count("*").alias("n"), F.sum("trade_count").alias("trades"), F.max("high").alias("high"), F.min("low").alias("low"))


def s11_symbols(spark: SparkSession, d: str) -> DataFrame:
    return ticks(spark, d).filter(F.col("symbol").endswith("/USDX") & ~F.col("symbol").startswith("SKEL")).select("symbol").distinct()


def s12_round_trip(spark: SparkSession, d: str) -> DataFrame:
    at = scratch(spark, "round-trip")
    sinks.write_dataset(ticks(spark, d), at, ["symbol"])
    return segments.read_dataset(spark, at, ["exchange", "seq", "price"], F.col("price") > 1000)


# Joins, sets, sorts, filters.


def k_left_join(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "ticker_files").groupBy("file_no").agg(F.max("n_rows").alias("listed"))
    n = table(spark, d, "ticker").groupBy("file_no").agg(F.count("*").alias("held"))
    return n.join(f, "file_no", "left")


def k_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """Sources that trade but have no order book."""
    b = table(spark, d, "orderbook").select(normal.exchange("exchange").alias("exchange"), normal.instrument("symbol").alias("symbol")).distinct()
    return ticks(spark, d).select(*KEY).distinct().join(b, KEY, "left_anti")


def k_asof(spark: SparkSession, d: str) -> DataFrame:
    """The last quote at or before each tick."""
    q = quotes(spark, d).select(*KEY, F.col("timestamp").alias("ts"), F.col("rec_no").alias("quote_no")).groupBy(*KEY, "ts").agg(F.max("quote_no").alias("quote_no"))
    return asof.asof_last(ticks(spark, d).select(*KEY, "ts", "seq"), q, KEY, "ts", ["quote_no"]).select("seq", F.col("asof_quote_no").alias("quote_no"))


def k_interval(spark: SparkSession, d: str) -> DataFrame:
    """Ticks in the five-minute bars published for them."""
    b = table(spark, d, "bars").filter("duration = 300").select(normal.exchange("exchange").alias("exchange"), "symbol", (F.col("timestamp") * 1000).cast("long").alias("bar_start")).distinct()
    b = b.withColumn("bar_end", F.col("bar_start") + 300_000)
    j = asof.range_join(ticks(spark, d).select(*KEY, "ts", "seq"), b, KEY, "ts", "bar_start", "bar_end", 300_000)
    return j.select("seq", "bar_start")


def k_intervals(spark: SparkSession, d: str) -> DataFrame:
    """Ticks in the bars published for them, of every duration."""
    all_ = table(spark, d, "bars").select(normal.exchange("exchange").alias("exchange"), "symbol", "duration", (F.col("timestamp") * 1000).cast("long").alias("bar_start")).distinct()
    out = None
    for n in CFG.bar_durations:
        b = all_.filter(F.col("duration") == n).withColumn("bar_end", F.col("bar_start") + n * 1000)
        j = asof.range_join(ticks(spark, d).select(*KEY, "ts", "seq"), b.drop("duration"), KEY, "ts", "bar_start", "bar_end", n * 1000).select("seq", F.lit(n).alias("duration"), "bar_start")
        out = j if out is None else out.unionByName(j)
    return out


def l_union(spark: SparkSession, d: str) -> DataFrame:
    a = ticks(spark, d).select("exchange", "symbol", "ts", "price")
    b = quotes(spark, d).filter("last is not null").select("exchange", "symbol", F.col("timestamp").alias("ts"), F.col("last").alias("price"), "rec_no")
    u = a.unionByName(b, allowMissingColumns=True)
    return u.groupBy(*KEY).agg(F.count("*").alias("n"), F.count("rec_no").alias("quotes"), F.max("price").alias("high"))


def l_distinct_on(spark: SparkSession, d: str) -> DataFrame:
    """The first arrival of each (trade_id, timestamp)."""
    t = table(spark, d, "trades").select("trade_id", "timestamp", "collected_at", "rec_no", "price")
    return dml.first_by(t, ["trade_id", "timestamp"], [F.col("collected_at"), F.col("rec_no")]).select("trade_id", "timestamp", "rec_no", "price")


def m_book_order(spark: SparkSession, d: str) -> DataFrame:
    """The rank of each change within its source, by sequence; counted within stretches of sequences and carried across them."""
    o = table(spark, d, "orderbook").select(normal.exchange("exchange").alias("exchange"), "symbol", "sequence_num").distinct().withColumn("one", F.lit(1))
    r = bars.running_sum(o, ["exchange", "symbol"], ["sequence_num"], "one", "place", F.coalesce(F.expr("sequence_num div 4096"), F.lit(-1)))
    return r.select("exchange", "symbol", "sequence_num", F.col("place").cast("int").alias("place"))


def m_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Sources by traded value, in bands of 4, 8 and 8."""
    from pyspark.sql import Window as W

    v = ticks(spark, d).groupBy(*KEY).agg(F.round(F.sum(F.col("price") * F.col("amount")), 2).alias("traded")).withColumn("place", F.row_number().over(W.orderBy(F.desc("traded"), *KEY)))
    return v.withColumn("tier", F.when(F.col("place") <= 4, 1).when(F.col("place") <= 12, 2).when(F.col("place") <= 20, 3).otherwise(4))


def c_predicates(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "trades").filter("side is not null and price between 1 and 5000 and taker_or_maker in ('taker', 'maker')")
    return t.select("rec_no", normal.trade_side("side").alias("side"))


def f_partition_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ticker").groupBy(sinks.partition_value("symbol").alias("symbol"), normal.exchange("exchange").alias("exchange")).agg(F.count("*").alias("n"))


def f_path_values(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "ticker_files").select("file_no", "path").distinct()
    return f.select("file_no", *segments.path_values(F.col("path"), "exchange", "symbol", "date"), F.col("path").rlike(layout.FILE_NAME + "$").alias("named_well"))


def e_time_fields(spark: SparkSession, d: str) -> DataFrame:
    t = timefn.add_time_fields(table(spark, d, "ticker").select("rec_no", "file_no", "timestamp"), "timestamp")
    return t.select("rec_no", "file_no", "year", "month", "day", "hour", "minute", "second", "microsecond", "date", "day_of_week", "is_weekend")


def e_iso_times(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orderbook").filter("event_time is not null").select("exchange", "sequence_num", "event_time").distinct()
    return o.select("exchange", "sequence_num", "event_time", F.unix_millis(timefn.to_utc(F.col("event_time"))).alias("event_ms"))


# Parsing: messages are made from the tables, read as text, and flattened again.


def _messages(spark: SparkSession, d: str) -> DataFrame:
    q = spread(table(spark, d, "ticker"))
    data = F.struct("timestamp", "bid", "ask", F.coalesce("bidVolume", "bid_volume").alias("bidVolume"), F.coalesce("askVolume", "ask_volume").alias("askVolume"), "last", "open", "high", "low", F.col("base_volume").alias("baseVolume"))
    m1 = q.select(F.to_json(F.struct(F.lit("ticker").alias("type"), "exchange", "symbol", F.lit("watchTicker").alias("method"), F.to_json(data).alias("data"), "collected_at")).alias("value"), "rec_no")
    t = spread(table(spark, d, "trades"))
    one = F.struct(F.col("trade_id").alias("id"), "timestamp", "side", "price", "amount", "cost", F.col("taker_or_maker").alias("takerOrMaker"), F.col("info_json").alias("info"))
    body = F.when(F.col("rec_no") % 7 == 0, F.to_json(one)).otherwise(F.to_json(F.array(one)))
    m2 = t.select(F.to_json(F.struct(F.lit("trades").alias("type"), "exchange", "symbol", F.lit("watchTrades").alias("method"), body.alias("data"), "collected_at")).alias("value"), "rec_no")
    broken = t.select(F.lit('{"type": "trades", "exch').alias("value"), "rec_no").filter("rec_no % 100 = 0")
    return m1.unionByName(m2).unionByName(broken)


def d_ticker(spark: SparkSession, d: str) -> DataFrame:
    ok, _ = segments.parse_json(_messages(spark, d), parse.ENVELOPE)
    return enrich.quote_spread(parse.ticker(ok, ["rec_no"])).select("rec_no", "exchange", "symbol", "date", "timestamp", "bid", "ask", "bidVolume", "baseVolume", F.round("spread", 8).alias("spread"), F.round("spread_pct", 4).alias("spread_pct"))


def d_trades(spark: SparkSession, d: str) -> DataFrame:
    ok, _ = segments.parse_json(_messages(spark, d), parse.ENVELOPE)
    return parse.trades(ok, ["rec_no"]).select("rec_no", "exchange", "symbol", "date", "trade_id", "timestamp", "side", "price", "amount", "cost", "takerOrMaker")


def d_stats(spark: SparkSession, d: str) -> DataFrame:
    """Messages by type, and lines set aside."""
    ok, bad = segments.parse_json(_messages(spark, d), parse.ENVELOPE)
    return parse.stats(ok).unionByName(bad.agg(F.lit("rejected").alias("type"), F.count("*").alias("n")))


def d_orderbook(spark: SparkSession, d: str) -> DataFrame:
    """Books as messages, truncated to five levels when read."""
    pair = lambda c: F.transform(c, lambda x: F.array(x["price"], x["size"])).alias(c)
    b = books(spark, d)
    m = b.select(F.lit("orderbook").alias("type"), "exchange", "symbol", F.to_json(F.struct(F.col("ts").alias("timestamp"), F.col("seq").alias("nonce"), pair("bids"), pair("asks"))).alias("data"), F.col("ts").alias("collected_at"))
    o = parse.orderbook(m, depth=5)
    return o.select(F.col("nonce").alias("seq"), "date", F.size("bids").alias("levels"), F.col("bids")[0][0].alias("best_bid"), F.col("asks")[0][1].alias("ask_size"))


def d_events(spark: SparkSession, d: str) -> DataFrame:
    """Changes of the level-2 feed as nested event messages, one for each sequence number, exploded again."""
    o = table(spark, d, "orderbook").filter("sequence_num is not null and price_level is not null")
    item = F.to_json(F.struct("side", F.col("price_level").cast("string").alias("price_level"), F.col("new_quantity").cast("string").alias("new_quantity"), "event_time"))
    data = F.concat(F.lit('{"channel":"l2_data","sequence_num":'), F.col("sequence_num"), F.lit(',"events":[{"type":"'), F.lower("event_type"), F.lit('","product_id":"'), "symbol", F.lit('","updates":['), item, F.lit("]}]}"))
    line = F.concat(F.lit('{"capture_ts":"x","data":'), data, F.lit("}"))
    ok, _ = segments.parse_json(o.select(line.alias("value")), parse.events_schema())
    rows, _ = parse.events(ok, "orderbook")
    e = enrich.level2(rows)
    return e.groupBy("symbol", "side_normalized", "is_snapshot").agg(F.count("*").alias("n"), F.max("price_level").alias("high"), F.round(F.sum("new_quantity"), 4).alias("quantity"))


# Book features.

CFG = FeatureConfig()


def _features(spark: SparkSession, d: str) -> DataFrame:
    return book.snapshot_features(books(spark, d), CFG.max_levels, CFG.bands_bps, carry=["seq"])


def _rounded(df: DataFrame, keep: list[str], cols: list[str], digits: int = 6) -> DataFrame:
    """Computed numbers in single precision, so that another order of addition gives the same; -0.0 is 0.0."""
    return df.select(*keep, *[(F.round(c, digits + 3) + F.lit(0.0)).cast("float").alias(c) for c in cols])


def g_quotes(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_features(spark, d), ["seq"], ["best_bid", "best_ask", "mid_price", "spread", "relative_spread", "imbalance_L1", "microprice"])


def g_levels(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_features(spark, d), ["seq"], ["bid_price_L0", "bid_size_L0", "bid_price_L1", "bid_size_L1", "ask_price_L3", "ask_size_L3", "ask_price_L12", "ask_size_L12"])


def g_bands(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_features(spark, d), ["seq"], ["bid_vol_band_0_5bps", "ask_vol_band_0_5bps", "imb_band_0_5bps", "bid_vol_band_25_50bps", "ask_vol_band_25_50bps", "imb_band_25_50bps", "lambda_like", "amihud_like", "book_convexity"])


def g_depth(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_features(spark, d), ["seq", "bid_50pct_depth_levels", "ask_50pct_depth_levels"], ["bid_concentration", "ask_concentration", "book_pressure", "total_bid_volume", "total_ask_volume", "bid_depth_decay_5", "avg_depth_decay_5"])


def g_vwap(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_features(spark, d), ["seq"], ["vwap_bid_5", "vwap_ask_5", "vwap_spread", "smart_bid_depth", "smart_ask_depth", "smart_depth_imbalance", "center_of_gravity", "cog_vs_mid"])


def g_slopes(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_features(spark, d), ["seq"], ["bid_slope_simple", "ask_slope_simple", "bid_slope_regression", "ask_slope_regression", "slope_asymmetry"], 4)


def g_best_quotes(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(book.best_quotes(books(spark, d)), ["seq"], ["best_bid", "best_bid_amount", "best_ask", "best_ask_amount", "spread", "mid_price"])


def g_research(spark: SparkSession, d: str) -> DataFrame:
    cols = ["spread_bps", "bid_volume_10", "volume_imbalance_5", "weighted_oi_5", "notional_pressure_10", "bid_level_spacing_mean", "ask_depth_10bps", "bid_slope", "volume_ratio_3", "effective_spread", "kyle_lambda_bid", "amihud_illiquidity", "bid_concentration"]
    return _rounded(book.research_features(books(spark, d)), ["seq", "bid_50pct_depth"], cols)


# Flow.


def _flow(spark: SparkSession, d: str) -> DataFrame:
    b = books(spark, d)
    one = lambda s, f: F.get(F.col(s), F.lit(0))[f]
    bb, ba, sb, sa = one("bids", "price"), one("asks", "price"), one("bids", "size"), one("asks", "size")
    b = b.select(*KEY, "ts", "seq", "bids", "asks", bb.alias("best_bid"), ba.alias("best_ask"), sb.alias("bid_size"), sa.alias("ask_size"), ((bb + ba) / 2).alias("mid_price"), ((bb * sa + ba * sb) / (sa + sb)).alias("microprice"))
    return flow.snapshot_flow(b, KEY, levels=CFG.ofi_levels, alpha=CFG.ofi_decay_alpha)


def h_flow_l1(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_flow(spark, d), ["seq"], ["log_return_step", "ofi_step", "micro_minus_mid"], 8)


def h_flow_levels(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_flow(spark, d), ["seq"], ["ofi_multi", "mlofi_decay"])


def h_velocity(spark: SparkSession, d: str) -> DataFrame:
    f = _flow(spark, d)
    return f.select("seq", (F.round(F.col("mid_velocity") * 1e9, 4) + F.lit(0.0)).alias("mid_velocity_e9"), (F.round(F.col("mid_accel") * 1e15, 2) + F.lit(0.0)).alias("mid_accel_e15"))


# Windows.


def i_running(spark: SparkSession, d: str) -> DataFrame:
    t = rolling.welford(ticks(spark, d), KEY, "ts", "seq", "amount")
    return _rounded(t, ["seq", "amount_n"], ["amount_mean", "amount_var"], 9)


def i_rolling_sum(spark: SparkSession, d: str) -> DataFrame:
    t = rolling.rolling_sum(ticks(spark, d), KEY, "ts", "seq", "amount", 60, "w")
    return _rounded(t, ["seq", "w_n"], ["w_sum", "w_mean"], 6)


def i_rolling_std(spark: SparkSession, d: str) -> DataFrame:
    t = rolling.rolling_moments(ticks(spark, d), KEY, "ts", "seq", "amount", 60, "w")
    return _rounded(t, ["seq"], ["w_mean", "w_var", "w_std"])


def i_percentile(spark: SparkSession, d: str) -> DataFrame:
    t = rolling.percentile_rank(ticks(spark, d), KEY, "ts", "seq", "amount", 60, (0.2, 0.8), "w")
    return _rounded(t, ["seq"], ["w_rank", "w_p20", "w_p80"])


def i_regimes(spark: SparkSession, d: str) -> DataFrame:
    """Share of the last five minutes in which the last trade was a buy, or a sale."""
    t = rolling.regime_fractions(ticks(spark, d).filter("side is not null"), KEY, "ts", "seq", "side", 300, ("buy", "sell"))
    return _rounded(t, ["seq"], ["side_buy_frac", "side_sell_frac"])


def i_kyle(spark: SparkSession, d: str) -> DataFrame:
    t = ticks(spark, d).filter("side is not null").withColumn("signed", F.when(F.col("side") == "buy", F.col("amount")).otherwise(-F.col("amount"))).withColumn("p", F.ln("amount"))
    return _rounded(rolling.kyle_lambda(t, KEY, "ts", "seq", "p", "signed", 300), ["seq"], ["kyle_lambda", "kyle_lambda_r2"], 6)


def i_trade_flow(spark: SparkSession, d: str) -> DataFrame:
    """Flow of trades as of each quote: the state after the last trade at or before it."""
    tf = features.trade_flow(ticks(spark, d), (60,))
    q = quotes(spark, d).groupBy(*KEY, F.col("timestamp").alias("ts")).agg(F.min("rec_no").alias("seq"))
    j = asof.asof_last(q, tf.groupBy(*KEY, "ts").agg(F.max(F.struct("seq", "buy_60", "sell_60")).alias("v")).select(*KEY, "ts", "v.buy_60", "v.sell_60"), KEY, "ts", ["buy_60", "sell_60"], prefix="")
    b, s = F.coalesce("buy_60", F.lit(0.0)), F.coalesce("sell_60", F.lit(0.0))
    return j.select("seq", F.round(F.when(b + s > 0, (b - s) / (b + s)).otherwise(F.lit(0.0)), 6).alias("tfi"), F.round(b + s, 6).alias("volume"))


# Bars.


def j_time_bars(spark: SparkSession, d: str) -> DataFrame:
    """Bars of ticks at four durations; the newest of each key is open."""
    none = F.lit(None).cast("double")
    t = ticks(spark, d).select(*KEY, "ts", "seq", F.col("price").alias("mid"), none.alias("spread"), none.alias("rel_spread"), F.when(F.col("side") == "buy", F.col("amount")).otherwise(-F.col("amount")).alias("ofi"), none.alias("l1_imb"), F.ln("amount").alias("log_ret"), F.col("amount").alias("mlofi"))
    b = bars.time_bars(t, KEY, CFG.bar_durations)
    return _rounded(b, [*KEY, "duration", "bar_start", "open", "high", "low", "close", "count", "date"], ["sum_ofi", "realized_variance", "sum_mlofi_decay", "close_step_mlofi"], 6)


def j_feature_bars(spark: SparkSession, d: str) -> DataFrame:
    b = features.feature_bars(books(spark, d), FeatureConfig(bar_durations=(86_400 * 30,)))
    return _rounded(b, [*KEY, "duration", "bar_start", "count"], ["open", "high", "low", "close", "mean_spread", "mean_l1_imbalance", "sum_ofi", "max_spread"])


def j_feature_bars_all(spark: SparkSession, d: str) -> DataFrame:
    """At the durations of the configuration, and of 30 days, as these books are days apart."""
    b = features.feature_bars(books(spark, d), FeatureConfig(bar_durations=(*CFG.bar_durations, 86_400 * 30)))
    return _rounded(b, [*KEY, "duration", "bar_start", "count"], ["open", "high", "low", "close", "mean_spread", "mean_l1_imbalance", "sum_ofi", "max_spread"])


def j_volume_bars(spark: SparkSession, d: str) -> DataFrame:
    b = bars.volume_bars(ticks(spark, d).withColumnRenamed("amount", "volume"), KEY, 50.0)
    return _rounded(b, [*KEY, "bucket", "open", "close", "trade_count", "start_time", "end_time"], ["volume", "buy_volume", "vwap", "buy_ratio"], 5)


def j_vpin(spark: SparkSession, d: str) -> DataFrame:
    b = bars.vpin(ticks(spark, d).withColumnRenamed("amount", "volume"), KEY, 20.0)
    return _rounded(b, [*KEY, "bucket"], ["buy_volume", "sell_volume", "vpin"], 5)


def j_window_vwap(spark: SparkSession, d: str) -> DataFrame:
    b = bars.window_ohlcv(ticks(spark, d).withColumnRenamed("amount", "volume"), KEY, 300)
    return _rounded(b, [*KEY, "window_start", "open", "high", "low", "close", "trades"], ["vwap", "volume"], 5)


def j_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return ticks(spark, d).groupBy(*KEY, "ts", "price").agg(F.count("*").alias("n")).filter("n > 1")


def j_estimate(spark: SparkSession, d: str) -> DataFrame:
    e = layout.estimate(quotes(spark, d), ["exchange", "symbol", "date"])
    return e.select("partitions", "total_rows", F.round("avg_rows", 4).alias("avg_rows"), "max_rows", F.round("avg_mb", 6).alias("avg_mb"))


def j_backlog(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "ticker_files").select("file_no", F.col("n_bytes").alias("size"), F.unix_millis("written_at").alias("modified_ms"))
    h = layout.backlog_health(f, 1_741_100_000_000)
    return h.select("files", "bytes", F.round("oldest_s", 3).alias("oldest_s"), "status")


def j_collisions(spark: SparkSession, d: str) -> DataFrame:
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return table(spark, d, "ticker_files").select("path").distinct().groupBy(name.alias("name")).agg(F.count("*").alias("n")).filter("n > 1")


# Stateful.


def n_downsample(spark: SparkSession, d: str) -> DataFrame:
    return features.downsample(ticks(spark, d).select(*KEY, "ts", "seq"), KEY, "ts", 30_000)


def n_book_states(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orderbook").select(normal.exchange("exchange").alias("exchange"), "symbol", "side", "price_level", "new_quantity", "sequence_num", ((F.lower("event_type") == "delete") | (F.col("new_quantity") == 0)).alias("gone"))
    s = asof.book_states(o, KEY, removed=F.col("gone"))
    return _rounded(s, [*KEY, "sequence_num", "best_bid", "best_bid_size", "best_ask", "best_ask_size"], ["mid_price", "spread", "spread_bps"])


def n_hf_features(spark: SparkSession, d: str) -> DataFrame:
    """Fifteen columns of the feature row of the books, without trades, with horizons of days, as these books are days apart."""
    cfg = FeatureConfig(horizons=(86_400 * 10, 86_400 * 60), hf_emit_interval=86_400.0, spread_regime_window=86_400 * 60, kyle_lambda_window=86_400 * 60, depth_window=86_400 * 60, slope_window=86_400 * 60)
    f = features.hf_features(books(spark, d), None, cfg)
    cols = ["mid_price", "ofi_step", "ofi_sum_5184000s", "mlofi_sum_5184000s", "depth_0_5bps_sigma", "spread_percentile", "spread_regime_tight_frac", "cog_momentum_mean_5184000s", "cog_momentum_std_5184000s"]
    return _rounded(f.drop("timestamp"), [*KEY, "seq", "spread_regime", "hour_of_day", "day_of_week", "is_weekend"], cols, 1)


def n_hf_whole(spark: SparkSession, d: str) -> DataFrame:
    """The whole feature row of the books at five horizons, with an order's lines as its trades. Without SQL."""
    day = 86_400
    cfg = FeatureConfig(horizons=(day, 5 * day, 10 * day, 30 * day, 60 * day), hf_emit_interval=float(day), spread_regime_window=60 * day, kyle_lambda_window=60 * day, depth_window=60 * day, slope_window=60 * day)
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_linestatus") == "O", "buy").otherwise("sell").alias("side"))
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("exchange"), F.col("o_custkey").cast("string").alias("symbol"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts"))
    t = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(*KEY, "ts", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), "side", F.col("l_quantity").cast("double").alias("amount"))
    return features.hf_features(books(spark, d), t, cfg)


# Changes to datasets, and their layout.


def _dataset(spark: SparkSession, d: str) -> dml.Dataset:
    at = scratch(spark, "dml")
    q = quotes(spark, d).filter("bid is not null").select("exchange", "symbol", "date", "rec_no", "bid", "ask", "base_volume").distinct()
    sinks.write_dataset(q, at, ["exchange", "date"])
    return dml.Dataset(spark, at, ["exchange", "date"])


def o_delete(spark: SparkSession, d: str) -> DataFrame:
    t = _dataset(spark, d)
    t.delete(F.col("base_volume") < 5000)
    return t.read().select("exchange", "date", "rec_no", "bid", "base_volume")


def o_update(spark: SparkSession, d: str) -> DataFrame:
    """The second column sees the first: rows that leave the condition by it are not changed."""
    t = _dataset(spark, d)
    t.update(F.col("bid") > F.col("ask"), {"base_volume": 0.0, "bid": F.col("ask")}, {"date": "2025-03-04"})
    return t.read().select("exchange", "date", "rec_no", "bid", "ask", "base_volume")


def o_upsert(spark: SparkSession, d: str) -> DataFrame:
    t = _dataset(spark, d)
    q = quotes(spark, d).filter("bid is not null").select("exchange", "symbol", "date", "rec_no", "bid", "ask", "base_volume").distinct()
    new = q.filter("rec_no % 5 = 0").withColumns({"bid": F.col("bid") + 1, "ask": F.when(F.col("rec_no") % 2 == 0, F.col("ask") + 1), "rec_no": F.when(F.col("rec_no") % 3 == 0, -F.col("rec_no")).otherwise(F.col("rec_no"))})
    t.upsert(new, ["rec_no"])
    return _rounded(t.read(), ["exchange", "date", "symbol", "rec_no"], ["bid", "ask"])


def o_upsert_all(spark: SparkSession, d: str) -> DataFrame:
    """Changed values for every record, those of little volume under new keys, the dear ones without a new ask."""
    t = _dataset(spark, d)
    q = quotes(spark, d).filter("bid is not null").select("exchange", "symbol", "date", "rec_no", "bid", "ask", "base_volume").distinct()
    new = q.select("exchange", "symbol", "date", F.when(F.col("base_volume") < 5000, -F.col("rec_no")).otherwise(F.col("rec_no")).alias("rec_no"), (F.col("bid") + 1).alias("bid"), F.when(F.col("bid") < 1000, F.col("ask") + 1).alias("ask"), "base_volume")
    t.upsert(new, ["rec_no"])
    return _rounded(t.read(), ["exchange", "date", "symbol", "rec_no"], ["bid", "ask"])


def o_deduplicate(spark: SparkSession, d: str) -> DataFrame:
    at = scratch(spark, "dedup")
    sinks.write_dataset(quotes(spark, d).select("exchange", "date", "rec_no", "file_no", "bid"), at, ["exchange"])
    t = dml.Dataset(spark, at, ["exchange"])
    t.deduplicate(["rec_no"], [F.col("file_no")])
    return t.read().select("exchange", "rec_no", "file_no", "bid")


def p_repartition(spark: SparkSession, d: str) -> DataFrame:
    """From one layout to another, with a column the transform makes."""
    a, b = scratch(spark, "layout"), scratch(spark, "layout")
    sinks.write_dataset(ticks(spark, d), a, ["exchange"])
    layout.repartition(spark, a, b, ["symbol", "hour"], lambda x: x.withColumn("hour", F.hour(F.timestamp_millis("ts"))))
    return spark.read.parquet(b).groupBy(F.col("symbol").cast("string").alias("symbol"), F.col("hour").cast("int").alias("hour")).agg(F.count("*").alias("n"), F.max("price").alias("high"))


def p_compact(spark: SparkSession, d: str) -> DataFrame:
    at = scratch(spark, "small")
    q = quotes(spark, d).select("exchange", "rec_no", "file_no", "bid")
    for part in ("file_no % 2 = 0", "file_no % 2 = 1"):
        sinks.write_dataset(q.filter(part), at, ["exchange"])
    layout.compact(spark, at, sort_by=["rec_no"])
    return spark.read.parquet(at).select(F.col("exchange").cast("string").alias("exchange"), "rec_no", "file_no", "bid")


def p_repair(spark: SparkSession, d: str) -> DataFrame:
    """Files whose symbols were written with a slash below folders with a dash."""
    at = scratch(spark, "repair")
    q = quotes(spark, d).select("exchange", "symbol", "rec_no", "bid")
    q.withColumn("_p", F.translate("symbol", "/", "-")).withColumnRenamed("symbol", "held").write.partitionBy("_p").parquet(at + "/raw")
    t = spark.read.parquet(at + "/raw").withColumnRenamed("held", "symbol").drop("_p")
    sinks.write_dataset(t, at + "/fixed", ["symbol"], keep_columns=True)
    layout.repair(spark, at + "/fixed", ["symbol"])
    return spark.read.option("recursiveFileLookup", "true").parquet(at + "/fixed").groupBy("symbol").agg(F.count("*").alias("n"))


def q_sync(spark: SparkSession, d: str) -> DataFrame:
    a, b = scratch(spark, "from"), scratch(spark, "to")
    sinks.write_dataset(quotes(spark, d).select("exchange", "rec_no", "file_no", "bid"), a, ["exchange"])
    sync.sync(spark, a, b, ".parquet")
    sync.sync(spark, a, b, ".parquet")  # what is there is skipped
    out = spark.read.parquet(b).select(F.col("exchange").cast("string").alias("exchange"), "rec_no", "file_no", "bid")
    fs.delete(spark, a)
    return out


def queries() -> dict:
    return {n: f for n, f in globals().items() if n[0] != "_" and n.split("_")[0] in {*"cdefghijklmnopq", *(f"s{i:02d}" for i in range(1, 13))} and callable(f)}
