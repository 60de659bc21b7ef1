"""Queries of the data-processing problems in the core, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.functions import normal
from tideframe.operators import changefeed, drift, latebars, redelivery, smallfiles, spikes
from tideframe.session import scratch, spread

TRADE_KEY = {"exchange": normal.exchange, "trade_id": F.col, "timestamp": F.col}


def _trade_key() -> dict:
    return {n: f(n) for n, f in TRADE_KEY.items()}


def _copies(spark: SparkSession, path: str) -> redelivery.DeletionVectors:
    return redelivery.find_copies(spark, path, _trade_key(), [F.col("collected_at"), F.col("segment_no"), F.col("rec_no")])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers of the rows that the deletion vectors take out of trades."""
    path = f"{d}/trades.parquet"
    gone = redelivery.apply_vectors(spark, path, _copies(spark, path), ["exchange", "trade_id", "timestamp"], deleted=True)
    return gone.select(normal.exchange("exchange").alias("exchange"), "trade_id", "timestamp").distinct()


def p1_trades_once(spark: SparkSession, d: str) -> DataFrame:
    path = f"{d}/trades.parquet"
    t = redelivery.apply_vectors(spark, path, _copies(spark, path))
    return t.select("rec_no", normal.exchange("exchange").alias("exchange"), "symbol", "trade_id", "timestamp", "price", "amount")


#: Arrival periods that become runs of their own, in hours.
RUN_HOURS = 12


def book_changes(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/orderbook.parquet").select(
        normal.exchange("exchange").alias("exchange"), "symbol", normal.book_side("side").alias("side"), F.round(F.col("price_level") * 1e8).cast("long").alias("price_e8"),
        "price_level", "new_quantity", "sequence_num", ((F.lower(F.trim("event_type")) == "delete") | (F.col("new_quantity") == 0)).alias("removed"), "capture_timestamp",
    )


def _book(spark: SparkSession, d: str) -> changefeed.ChangeTable:
    t = changefeed.ChangeTable(spark, scratch(spark, "book"), ["exchange", "symbol", "side", "price_e8"], ["price_level", "new_quantity"], buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    c = book_changes(spark, d)
    t.append(c, F.col("sequence_num"), F.col("removed"), F.floor(F.unix_timestamp("capture_timestamp") / (3600 * RUN_HOURS)))
    return t


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _book(spark, d).read().select("exchange", "symbol", "side", "price_e8", F.col("_seq").alias("sequence_num"))


def p2_levels(spark: SparkSession, d: str) -> DataFrame:
    """The standing levels with their quantities, read after a compaction."""
    t = _book(spark, d)
    t.compact()
    return t.read().select("exchange", "symbol", "side", "price_e8", F.col("new_quantity").alias("quantity"))


def _bars(spark: SparkSession, d: str) -> latebars.EventTimeBars:
    cols = ["exchange", "symbol", "trade_id", "timestamp", "collected_at", "price", "amount", "rec_no"]
    return latebars.EventTimeBars(spark).run(spark.read.parquet(f"{d}/trades.parquet").select(*cols))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _bars(spark, d).current().filter("n_late > 0").select("exchange", "symbol", "duration", "bar_start")


def p3_bars(spark: SparkSession, d: str) -> DataFrame:
    b = _bars(spark, d).current().filter("trade_count > 0")
    return b.select("exchange", "symbol", "duration", "bar_start", "open", "high", "low", "close", F.round("volume", 6).alias("volume"), "trade_count", "n_late")


def p3_dropped(spark: SparkSession, d: str) -> DataFrame:
    return _bars(spark, d).dropped().groupBy("exchange", "symbol", "duration").agg(F.count("*").alias("n"), F.max("late_by_ms").alias("worst_ms"))


def _flags(spark: SparkSession, d: str) -> DataFrame:
    ticker = spark.read.parquet(f"{d}/ticker.parquet").select("rec_no", "exchange", "symbol", "timestamp", "bid", "ask")
    trades = spark.read.parquet(f"{d}/trades.parquet").select("rec_no", "collected_at", "exchange", "symbol", "trade_id", "timestamp", "price")
    return spikes.flags(ticker, trades)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _flags(spark, d).select("source_table", "rec_no").distinct()


def p4_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _flags(spark, d).groupBy("source_table", "reason").agg(F.count("*").alias("n"))


def p4_fences(spark: SparkSession, d: str) -> DataFrame:
    """Fences for each source, field and hour; the sketches behind them are not deterministic in their last digits."""
    ticker, trades = spark.read.parquet(f"{d}/ticker.parquet"), spark.read.parquet(f"{d}/trades.parquet")
    return spikes.fences(spikes.readings(ticker, trades))


#: The consistent ticker table, and the names under which venues are known to send its columns.
TICKER_COLUMNS = {
    "symbol": "string", "timestamp": "epoch_ms", "bid": "double", "ask": "double", "bid_volume": "double", "ask_volume": "double", "last": "double",
    "open": "double", "high": "double", "low": "double", "vwap": "double", "base_volume": "double", "quote_volume": "double", "info_json": "string",
}
TICKER_NAMES = {"bidVolume": "bid_volume", "askVolume": "ask_volume", "baseVolume": "base_volume", "quoteVolume": "quote_volume"}


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(spread(spark.read.parquet(f"{d}/ticker_raw.parquet").select("exchange", "file_seq", "raw")))


def p5_table(spark: SparkSession, d: str) -> DataFrame:
    """The typed table; values under names that the files' profiles show to measure the same as a column are replayed into it."""
    raw = spark.read.parquet(f"{d}/ticker_raw.parquet").withColumn("exchange", normal.exchange("exchange"))
    later = drift.renames(spread(raw.select("exchange", "file_seq", "raw")), TICKER_COLUMNS, TICKER_NAMES, ["exchange", "file_seq"])
    t = drift.ingest(raw, TICKER_COLUMNS, TICKER_NAMES, ["exchange", "file_seq", "line_no"])
    return drift.replay(t, TICKER_COLUMNS, later)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Remains of earlier consolidations, from the records clustered along the curve."""
    return smallfiles.superseded(smallfiles.file_records(spark, f"{d}/ticker.parquet"))


def p6_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The consolidated table, read back from its files."""
    path = f"{d}/ticker.parquet"
    c = smallfiles.compact(spark, path)
    cols = ["rec_no", "timestamp", "bid", "ask", "base_volume"]
    return spark.read.schema(spark.read.parquet(path).schema).parquet(c.path).select(normal.exchange("exchange").alias("exchange"), normal.instrument("symbol").alias("symbol"), *cols)


def queries() -> dict:
    return {n: f for n, f in globals().items() if n[:1] == "p" and n[1:2].isdigit()}


_TRADES_ONCE = """(select * exclude (rn) from (select *, lower(trim(exchange)) ex, row_number() over (partition by lower(trim(exchange)), trade_id, "timestamp" order by collected_at, segment_no, rec_no) rn from trades)
 where rn = 1 or trade_id is null or "timestamp" is null)"""
_BAR_TRADES = f"""(select ex, symbol, coalesce(trade_id, cast(rec_no as varchar)) id, "timestamp" ts, price, amount, collected_at arrival, d duration, ts - ts % (d * 1000) bar_start,
 collected_at - (ts - ts % (d * 1000)) - d * 1000 late from {_TRADES_ONCE}, (values (60), (300), (900), (3600)) v(d) where "timestamp" is not null)"""
_LEVELS = """(select * from (select lower(trim(exchange)) exchange, symbol, case when lower(trim(side)) = 'bid' then 'bid' else 'ask' end side, cast(round(price_level * 1e8) as bigint) price_e8, sequence_num, new_quantity,
 lower(trim(event_type)) = 'delete' or coalesce(new_quantity = 0, false) gone from orderbook)
 qualify row_number() over (partition by exchange, symbol, side, price_e8 order by sequence_num desc, gone desc) = 1)"""


_READINGS = f"""(select 'ticker' tbl, lower(trim(exchange)) ex, replace(symbol, '-', '/') sy, "timestamp" ts, rec_no id, null tid, v, f from (select distinct rec_no, exchange, symbol, "timestamp", bid, ask from ticker qualify row_number() over (partition by rec_no) = 1), lateral (values (bid, 1), (ask, 2)) u(v, f)
 union all select 'trades', ex, symbol, "timestamp", rec_no, trade_id, price, 1 from {_TRADES_ONCE})"""
_FLAGS = f"""(with r as (select * from {_READINGS} where ts is not null and v is not null),
 w as (select *, abs(v - lag(v) over o) dl, median(v) over (partition by tbl, ex, sy, f order by ts, id rows between 5 preceding and 1 preceding) mb, median(v) over (partition by tbl, ex, sy, f order by ts, id rows between 1 following and 5 following) ma
  from r window o as (partition by tbl, ex, sy, f order by ts, id)),
 m as (select tbl, ex, sy, f, median(dl) md from w where dl > 0 group by all),
 spike as (select w.* from w join m using (tbl, ex, sy, f) where (v - mb) * (v - ma) > 0 and least(abs(v - mb), abs(v - ma)) > 10 * md),
 k as (select *, (bid = lag(bid) over o and ask = lag(ask) over o) is not true chg from (select distinct on (rec_no) rec_no, lower(trim(exchange)) ex, replace(symbol, '-', '/') sy, "timestamp" ts, bid, ask from ticker where bid is not null and ask is not null) window o as (partition by ex, sy order by ts)),
 k2 as (select *, sum(chg::int) over (partition by ex, sy order by ts) run from k),
 k3 as (select *, count(*) over (partition by ex, sy, run) len from k2),
 bad as (select tbl, id rec_no, 'spike' reason from spike union all select 'ticker', rec_no, 'stuck' from k3 where len >= 12 and not chg
  union all select 'ticker', rec_no, 'impossible' from ticker where bid <= 0 or ask <= 0 or bid > ask union all select 'trades', rec_no, 'impossible' from trades where price <= 0)
 select distinct tbl source_table, rec_no, reason from bad
 union select 'trades', t.rec_no, b.reason from bad b join trades x on b.tbl = 'trades' and x.rec_no = b.rec_no join trades t on lower(trim(t.exchange)) = lower(trim(x.exchange)) and t.trade_id = x.trade_id and t."timestamp" = x."timestamp")"""


_REC = """(select distinct lower(trim(exchange)) || chr(1) || replace(symbol, '-', '/') || chr(1) || date g, file_no, rec_no from ticker)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p6_found": f"""with r as {_REC}, n as (select file_no, count(*) n from r group by 1)
 select distinct a.file_no from r a join r b on a.g = b.g and a.rec_no = b.rec_no and a.file_no <> b.file_no join n on n.file_no = a.file_no join n m on m.file_no = b.file_no
 where m.n > n.n or (m.n = n.n and b.file_no < a.file_no) group by a.file_no, b.file_no, n.n having count(*) = n.n""",
        "p6_compacted": """select rec_no, "timestamp", bid, ask, base_volume, lower(trim(exchange)) exchange, replace(symbol, '-', '/') symbol from ticker qualify row_number() over (partition by rec_no order by file_no) = 1""",
        "p4_found": f"select distinct source_table, rec_no from {_FLAGS}",
        "p4_reasons": f"select source_table, reason, count(*) n from {_FLAGS} group by 1, 2",
        "p1_found": """select lower(trim(exchange)) exchange, trade_id, "timestamp" from trades where exchange is not null and trade_id is not null and "timestamp" is not null group by 1, 2, 3 having count(*) > 1""",
        "p1_trades_once": f"""select rec_no, ex exchange, symbol, trade_id, "timestamp", price, amount from {_TRADES_ONCE}""",
        "p2_found": f"select exchange, symbol, side, price_e8, sequence_num from {_LEVELS} where not gone",
        "p2_levels": f"select exchange, symbol, side, price_e8, new_quantity quantity from {_LEVELS} where not gone",
        "p3_found": f"select distinct ex exchange, symbol, cast(duration as integer) duration, bar_start from {_BAR_TRADES} where late > 5000 and late <= 900000",
        "p3_bars": f"""select ex exchange, symbol, cast(duration as integer) duration, bar_start, arg_min(price, (ts, id)) filter (price is not null) as "open", max(price) high, min(price) low, arg_max(price, (ts, id)) filter (price is not null) as "close",
 round(sum(amount) filter (price is not null), 6) volume, count(price) trade_count, count(*) filter (late > 5000) n_late from {_BAR_TRADES} where late <= 900000 group by 1, 2, 3, 4 having count(price) > 0""",
        "p3_dropped": f"select ex exchange, symbol, cast(duration as integer) duration, count(*) n, max(late) worst_ms from {_BAR_TRADES} where late > 900000 group by 1, 2, 3",
    }
