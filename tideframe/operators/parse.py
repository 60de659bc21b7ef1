"""Messages of two exchange interfaces flattened into typed channels.

The unified interface sends one envelope for each message: type, exchange, symbol, collected_at and data (a ticker, a list
of trades, or a book). The advanced-trade interface sends data.channel and nested events; its numbers are texts, a missing
one is 0.0, one that is no number drops its row into the rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe import schemas
from tideframe.functions.normal import once
from tideframe.schemas import doubles, strings

ENVELOPE = schemas.of(**strings("type exchange symbol method data"), collected_at="long", capture_ts="string")
TICKER_NUMBERS = "high low bid bidVolume ask askVolume vwap open close last previousClose change percentage average baseVolume quoteVolume"
TICKER = schemas.of(timestamp="long", datetime="string", **doubles(TICKER_NUMBERS))
TRADE = schemas.of(id="string", timestamp="long", **strings("datetime symbol order type side"), **doubles("price amount cost"), takerOrMaker="string", info="string")
BOOK = schemas.of(timestamp="long", datetime="string", nonce="long", bids=T.ArrayType(T.ArrayType(T.DoubleType())), asks=T.ArrayType(T.ArrayType(T.DoubleType())))

#: Names under which the second interface sends its channels, and ours.
CHANNELS = {"ticker": "ticker", "level2": "orderbook", "l2_data": "orderbook", "orderbook": "orderbook", "trades": "trades", "market_trades": "trades", "candles": "candles"}
HEARTBEATS = "heartbeats"


def usable(messages: DataFrame) -> DataFrame:
    """Messages with a type and data that is not empty."""
    d = F.trim("data")
    return messages.filter(F.col("type").isNotNull() & d.isNotNull() & ~d.isin("", "null", "[]", "{}", "0", "false", '""'))


def _times(df: DataFrame, data: str) -> DataFrame:
    """timestamp (that of the data, else of the collection), datetime (from it if absent) and date."""
    ts = F.coalesce(F.nullif(F.col(f"{data}.timestamp"), F.lit(0).cast("long")), F.col("collected_at"))
    iso = F.date_format(F.timestamp_millis(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    iso = F.concat(F.regexp_replace(iso, r"\.000000$", ""), F.lit("+00:00"))
    text = F.coalesce(F.nullif(F.col(f"{data}.datetime"), F.lit("")), iso)
    return df.withColumns({"_ts": ts, "_dt": text})


def _head(channel: str) -> list[Column]:
    return [F.lit(channel).alias("channel"), F.col("exchange"), F.col("symbol"), F.col("symbol").alias("product_id"), F.substring("_dt", 1, 10).alias("date")]


def ticker(messages: DataFrame, keep: list[str] = ()) -> DataFrame:
    d = usable(messages).filter("type = 'ticker'").select("*", once(F.from_json("data", TICKER)).alias("_d")).filter("_d is not null")
    d = _times(d, "_d")
    return d.select(*keep, *_head("ticker"), F.col("_ts").alias("timestamp"), F.col("_dt").alias("datetime"), *[F.col(f"_d.{c}").alias(c) for c in TICKER_NUMBERS.split()], "collected_at")


def trades(messages: DataFrame, keep: list[str] = ()) -> DataFrame:
    """One row for each trade of a list, or of a single object."""
    text = F.trim("data")
    listed = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    d = usable(messages).filter("type = 'trades'").select("*", F.explode(F.from_json(listed, T.ArrayType(TRADE))).alias("_d"))
    d = _times(d.filter("_d is not null"), "_d")
    t = lambda c: F.col(f"_d.{c}")
    return d.select(
        *keep, *_head("trades"), t("id").alias("trade_id"), F.col("_ts").alias("timestamp"), F.col("_dt").alias("datetime"), t("symbol").alias("symbol_ccxt"), t("order").alias("order_id"),
        t("type").alias("type"), t("side").alias("side"), t("price").alias("price"), t("amount").alias("amount"), t("cost").alias("cost"), t("takerOrMaker").alias("takerOrMaker"), "collected_at",
    )


def orderbook(messages: DataFrame, keep: list[str] = (), depth: int | None = None) -> DataFrame:
    """One row for each book; missing sides are empty, ``depth`` keeps the best levels."""
    d = usable(messages).filter("type = 'orderbook'").select("*", once(F.from_json("data", BOOK)).alias("_d")).filter("_d is not null")
    d = _times(d, "_d")
    side = lambda c: F.coalesce(F.col(f"_d.{c}"), F.array().cast("array<array<double>>"))
    cut = (lambda c: F.slice(side(c), 1, depth)) if depth else side
    return d.select(*keep, *_head("orderbook"), F.col("_ts").alias("timestamp"), F.col("_dt").alias("datetime"), F.col("_d.nonce").alias("nonce"), cut("bids").alias("bids"), cut("asks").alias("asks"), "collected_at")


def stats(messages: DataFrame, by: str = "type") -> DataFrame:
    """Messages by type or channel."""
    return messages.groupBy(by).agg(F.count("*").alias("n"))


def universe(bulk: DataFrame, response: str = "data") -> DataFrame:
    """A bulk response as one message for each symbol: an object of symbol to ticker (or list of trades), or a list of tickers or trades that name their symbol.

    Trades of a list are brought together by symbol within their response. Items of a list without a symbol are left out.
    """
    rest = [c for c in bulk.columns if c not in (response, "symbol")]
    text = F.trim(response)
    m = F.from_json(F.when(text.startswith("{"), text), T.MapType(T.StringType(), T.StringType()))
    by_name = bulk.select(*rest, F.explode(m).alias("symbol", response))
    items = bulk.filter(text.startswith("[")).select("*", F.monotonically_increasing_id().alias("_r"), F.posexplode(F.from_json(text, T.ArrayType(T.StringType()))).alias("_i", "_d"))
    items = items.drop("symbol").withColumn("symbol", F.get_json_object("_d", "$.symbol")).filter("symbol is not null")
    trade = F.coalesce(F.col("type") == "trades", F.lit(False)) if "type" in bulk.columns else F.lit(False)
    single = items.filter(~trade).select(*rest, "symbol", F.col("_d").alias(response))
    # The trades of a symbol within one response: bounded by the response.
    many = items.filter(trade).groupBy("_r", *rest, "symbol").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_d"))), lambda x: x["_d"]), ",").alias("_l"))
    return by_name.unionByName(single).unionByName(many.select(*rest, "symbol", F.concat(F.lit("["), "_l", F.lit("]")).alias(response)))


# The advanced-trade interface.

_EVENTS = {
    "ticker": ("tickers", {"price": "price", "volume_24h": "volume_24_h", "low_24h": "low_24_h", "high_24h": "high_24_h", "low_52w": "low_52_w", "high_52w": "high_52_w", "price_percent_chg_24h": "price_percent_chg_24_h",
                           "best_bid": "best_bid", "best_bid_quantity": "best_bid_quantity", "best_ask": "best_ask", "best_ask_quantity": "best_ask_quantity"}, {}),
    "orderbook": ("updates", {"price_level": "price_level", "new_quantity": "new_quantity"}, {"side": "side", "event_time": "event_time"}),
    "trades": ("trades", {"price": "price", "size": "size"}, {"trade_id": "trade_id", "side": "side", "time": "time"}),
    "candles": ("candles", {"high": "high", "low": "low", "open": "open", "close": "close", "volume": "volume"}, {"start": "start"}),
}


def events_schema() -> T.StructType:
    m = T.MapType(T.StringType(), T.StringType())
    event = schemas.of(type="string", product_id="string", **{v[0]: T.ArrayType(m) for v in _EVENTS.values()})
    data = schemas.of(**strings("channel timestamp client_id"), sequence_num="long", events=T.ArrayType(event))
    return schemas.of(capture_ts="string", data=data, metadata=m)


def channel_of(c: Column) -> Column:
    """Our name of a channel; null for heartbeats and unknown ones."""
    out = None
    for theirs, ours in CHANNELS.items():
        out = F.when(c == theirs, ours) if out is None else out.when(c == theirs, ours)
    return out


def events(messages: DataFrame, channel: str, keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of one channel (ticker, orderbook, trades, candles), and the items with a number that is none."""
    items, numbers, texts = _EVENTS[channel]
    d = messages.filter(channel_of(F.col("data.channel")) == channel)
    d = d.select(*keep, "capture_ts", "data", F.explode("data.events").alias("_e")).select("*", F.explode(f"_e.{items}").alias("_i"))
    get = lambda n: F.try_element_at("_i", F.lit(n))
    number = lambda n: F.when(F.map_contains_key("_i", n), get(n).try_cast("double")).otherwise(F.lit(0.0))
    symbol = F.col("_e.product_id") if channel == "orderbook" else get("product_id")
    d = d.withColumns({f"_n_{k}": number(v) for k, v in numbers.items()})
    fine = F.lit(True)
    for k in numbers:
        fine = fine & F.col(f"_n_{k}").isNotNull()
    cols = [
        *keep, F.lit(channel).alias("channel"), F.lit("coinbase").alias("exchange"), F.coalesce("_e.type", F.lit("unknown")).alias("event_type"), *[get(v).alias(k) for k, v in texts.items()],
        symbol.alias("symbol"), symbol.alias("product_id"), *[F.col(f"_n_{k}").alias(k) for k in numbers], F.col("data.sequence_num").alias("sequence_num"), F.coalesce("data.client_id", F.lit("")).alias("client_id"),
        F.col("data.timestamp").alias("server_timestamp"), F.col("capture_ts").alias("capture_timestamp"),
    ]
    return d.filter(fine).select(*cols), d.filter(~fine).select(*keep, "capture_ts", F.to_json("_i").alias("item"))


# Typed landing tables.


def landing(messages: DataFrame) -> dict[str, DataFrame]:
    """Messages of the unified interface as typed tables: ticker, trades, orderbook, and generic with the data as JSON."""
    m = messages.withColumn("capture_ts", F.col("capture_ts").try_cast("timestamp"))
    head = ["collected_at", "capture_ts", "exchange", "symbol"]
    info = lambda c: F.get_json_object(c, "$.info")
    k = m.filter("type = 'ticker'").select(*head, once(F.from_json("data", TICKER)).alias("d"), info("data").alias("info_json"))
    names = {"bid_volume": "bidVolume", "ask_volume": "askVolume", "base_volume": "baseVolume", "quote_volume": "quoteVolume"}
    order = "bid ask bid_volume ask_volume last open high low close vwap base_volume quote_volume change percentage".split()
    text = F.trim("data")
    listed = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    t = m.filter("type = 'trades'").select(*head, F.explode(F.from_json(listed, T.ArrayType(TRADE))).alias("d"))
    b = m.filter("type = 'orderbook'").select(*head, once(F.from_json("data", BOOK)).alias("d"))
    level = lambda c: F.transform(f"d.{c}", lambda x: F.struct(F.get(x, F.lit(0)).alias("price"), F.get(x, F.lit(1)).alias("size"))).alias(c)
    return {
        "ticker": k.select(*head, *[F.col(f"d.{names.get(c, c)}").alias(c) for c in order], "d.timestamp", "info_json"),
        "trades": t.select(*head, F.col("d.id").alias("trade_id"), "d.timestamp", "d.side", "d.price", "d.amount", "d.cost", F.col("d.info").alias("info_json")),
        "orderbook": b.select(*head, "d.timestamp", "d.nonce", level("bids"), level("asks")),
        "generic": m.filter("type is null or type not in ('ticker', 'trades', 'orderbook')").select(*head, "type", "method", F.col("data").alias("data_json")),
    }


def envelope(data: Column, **metadata: Column) -> Column:
    """A message as JSON: {capture_ts, data, metadata}."""
    meta = F.struct(*[c.alias(n) for n, c in metadata.items()]) if metadata else F.create_map()
    return F.to_json(F.struct(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("capture_ts"), data.alias("data"), meta.alias("metadata")))


def raw_envelope(data: Column) -> Column:
    """Bytes as JSON: {capture_ts, raw_bytes in hex}."""
    return F.to_json(F.struct(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("capture_ts"), F.lower(F.hex(data)).alias("raw_bytes")))
