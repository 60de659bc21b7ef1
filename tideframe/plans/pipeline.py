"""Queries of the sources, sinks, parsers, jobs and table maintenance around the feature operators, each with its SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe import job
from tideframe.config import ChannelConfig, Config
from tideframe.functions import fs, normal, timefn
from tideframe.operators import book, dml, enrich, features, layout, parse
from tideframe.plans.workload import _BOOKS, _QUOTES, _TICKS, CFG, KEY, _dataset, _messages, _rounded, books, quotes, table, ticks
from tideframe.plans.workload_sql import _LAGGED, _OFI, _slope
from tideframe.session import scratch, spread
from tideframe.sources import segments, sinks, sync
from tideframe.streaming import live


def _log(spark: SparkSession, d: str, max_mb: float = 2.0) -> str:
    """All messages as a log of closed segments by hour of arrival."""
    root = scratch(spark, "log")
    m = _messages(spark, d)
    at = F.coalesce(F.get_json_object("value", "$.collected_at").cast("long"), F.lit(1_741_046_400_000))
    sinks.segment_log(m.select("value", at.alias("collected_at")).repartitionByRange(8, "collected_at").sortWithinPartitions("collected_at"), root, F.date_format(F.timestamp_millis("collected_at"), "yyyyMMdd'T'HH"), max_mb)
    return root


def a_segment_log(spark: SparkSession, d: str) -> DataFrame:
    """Written as size-rotated segments, listed and read back: messages by type, and lines that do not parse."""
    ok, bad = segments.read_ndjson(spark, segments.segments(spark, _log(spark, d) + "/ready"), parse.ENVELOPE)
    return parse.stats(ok).unionByName(bad.agg(F.lit("rejected").alias("type"), F.count("*").alias("n")))


def a_segments_of_a_day(spark: SparkSession, d: str) -> DataFrame:
    """Only segments whose names lie in the days asked for are read."""
    root = _log(spark, d)
    ok, _ = segments.read_ndjson(spark, segments.segments(spark, root + "/ready", "2025-03-04", "2025-03-04"), parse.ENVELOPE)
    return ok.groupBy("type", normal.exchange("exchange").alias("exchange")).agg(F.count("*").alias("n"))


def a_glob(spark: SparkSession, d: str) -> DataFrame:
    """Folders named by a glob with alternatives."""
    at = scratch(spark, "by-hour")
    t = ticks(spark, d).withColumn("hour", F.date_format(F.timestamp_millis("ts"), "HH"))
    sinks.write_dataset(t, at, ["date", "hour"])
    out = spark.read.option("basePath", at).parquet(f"{at}/date=2025-03-0*/hour={{22,23}}")
    return out.groupBy(F.date_format(F.timestamp_millis("ts"), "HH").alias("hour"), *KEY).agg(F.count("*").alias("n"), F.max("price").alias("high"))


def a_recursive(spark: SparkSession, d: str) -> DataFrame:
    """Flat files in folders of no meaning, read recursively by a name pattern."""
    at = scratch(spark, "nested")
    t = ticks(spark, d)
    sinks.write_dataset(t.filter("side = 'buy'"), f"{at}/a/b")
    sinks.write_dataset(t.filter("side is null or side <> 'buy'"), f"{at}/c")
    sinks.write_dataset(t.limit(0), f"{at}/empty")
    return segments.read_files_recursive(spark, at).groupBy("exchange").agg(F.count("*").alias("n"), F.min("price").alias("low"), F.count("side").alias("sides"))


def a_envelopes(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "trades").select("rec_no", "price", "trade_id")
    j = t.select("rec_no", parse.envelope(F.struct("price", "trade_id"), source=F.lit("x")).alias("m"), parse.raw_envelope(F.encode(F.coalesce("trade_id", F.lit("-")), "UTF-8")).alias("r"))
    raw = F.decode(F.unhex(F.get_json_object("r", "$.raw_bytes")), "UTF-8")
    return j.select("rec_no", F.get_json_object("m", "$.data.price").cast("double").alias("price"), F.get_json_object("m", "$.metadata.source").alias("source"), raw.alias("raw"))


def b_landing(spark: SparkSession, d: str) -> DataFrame:
    """Typed landing tables: rows and sums of each."""
    ok, _ = segments.parse_json(_messages(spark, d), parse.ENVELOPE)
    other = ok.limit(0).unionByName(table(spark, d, "bars").select(F.lit("candle").alias("type"), "exchange", "symbol", F.lit("m").alias("method"), F.to_json(F.struct("open")).alias("data"), F.lit(0).cast("long").alias("collected_at"), F.lit("x").alias("capture_ts"), F.lit(0).cast("long").alias("rec_no")))
    land = parse.landing(ok.unionByName(other))
    total = {"ticker": F.sum("bid_volume"), "trades": F.sum("amount"), "generic": F.sum(F.get_json_object("data_json", "$.open").cast("double"))}
    out = [land[n].agg(F.lit(n).alias("name"), F.count("*").alias("n"), F.count("exchange").alias("named"), F.round(t, 2).cast("float").alias("total")) for n, t in total.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


def b_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Several outputs of one source; an empty one writes nothing."""
    at, t = scratch(spark, "outputs"), ticks(spark, d)
    told = sinks.write_outputs({"buys": t.filter("side = 'buy'"), "sales": t.filter("side = 'sell'"), "none": t.filter("seq < 0")}, at, {"buys": ["exchange"]})
    out = None
    for n, wrote in told.items():
        one = spark.read.parquet(f"{at}/{n}").agg(F.lit(n).alias("name"), F.count("*").alias("n")) if wrote else spark.createDataFrame([(n, 0)], "name string, n long")
        out = one if out is None else out.unionByName(one)
    return out


def b_kept_columns(spark: SparkSession, d: str) -> DataFrame:
    """Partition columns that the files hold as well, read from the files alone."""
    at = scratch(spark, "kept")
    sinks.write_dataset(quotes(spark, d).select("exchange", "symbol", "rec_no", "bid"), at, ["exchange", "symbol"], keep_columns=True)
    return segments.read_files_recursive(spark, at).groupBy("exchange", "symbol").agg(F.count("*").alias("n"), F.max("bid").alias("high"))


def c_usable(spark: SparkSession, d: str) -> DataFrame:
    """Messages without a type, with empty data, or without exchange or symbol are no messages; channels are chosen."""
    t = table(spark, d, "trades")
    case = F.col("rec_no") % 8
    data = F.when(case == 0, "[]").when(case == 1, "{}").when(case == 2, F.lit(None)).when(case == 3, " ").otherwise(F.to_json(F.struct("price", "amount", "rec_no")))
    m = t.select(F.when(case != 4, "trades").alias("type"), F.when(case != 5, F.col("exchange")).alias("exchange"), "symbol", data.alias("data"), F.when(case == 6, "heartbeats").otherwise(F.col("side")).alias("channel"))
    kept = enrich.keyed(parse.usable(m))
    picked = enrich.only_channels(kept, "buy", "heartbeats", "BUY")
    return kept.agg(F.lit("usable").alias("step"), F.count("*").alias("n"), F.countDistinct("key").alias("keys")).unionByName(picked.agg(F.lit("picked").alias("step"), F.count("*").alias("n"), F.countDistinct("key").alias("keys")))


def _nested(df: DataFrame, channel: str, items: str, text) -> DataFrame:
    line = F.concat(F.lit('{"capture_ts":"x","data":{"channel":"' + channel + '","sequence_num":1,"timestamp":"2025-03-03T22:00:00Z","events":[{"type":"update","' + items + '":['), text, F.lit("]}]}}"))
    ok, _ = segments.parse_json(df.select(line.alias("value")), parse.events_schema())
    return ok


def d_event_ticker(spark: SparkSession, d: str) -> DataFrame:
    """Quotes as nested ticker events; a number that is none drops its item into the rejects, a missing one is 0."""
    q = spread(quotes(spark, d).filter("bid is not null"))
    s = lambda c: F.col(c).cast("string")
    text = F.to_json(F.struct(F.col("symbol").alias("product_id"), F.when(F.col("rec_no") % 50 == 0, F.lit("n/a")).otherwise(s("bid")).alias("price"), s("bid").alias("best_bid"), s("ask").alias("best_ask"), s("high").alias("high_24_h"), s("low").alias("low_24_h")))
    rows, bad = parse.events(_nested(q, "ticker", "tickers", text), "ticker")
    t = enrich.advanced_ticker(rows)
    g = t.groupBy("symbol").agg(F.count("*").alias("n"), F.count("mid_price").alias("mids"), F.avg("spread_bps").alias("bps"), F.max("range_24h").alias("widest"), F.sum((F.col("volume_24h") == 0).cast("int")).alias("no_volume"))
    none = [F.lit(0).cast("long").alias(c) for c in ("mids", "no_volume")] + [F.lit(0.0).alias(c) for c in ("bps", "widest")]
    return _rounded(g.unionByName(bad.agg(F.lit("rejected").alias("symbol"), F.count("*").alias("n"), *none)), ["symbol", "n", "mids", "no_volume"], ["bps", "widest"], 2)


def d_event_trades(spark: SparkSession, d: str) -> DataFrame:
    t = spread(ticks(spark, d))
    text = F.to_json(F.struct(F.col("symbol").alias("product_id"), F.col("seq").cast("string").alias("trade_id"), F.col("price").cast("string").alias("price"), F.col("amount").cast("string").alias("size"), F.upper("side").alias("side"), F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("time")))
    rows, _ = parse.events(_nested(t, "market_trades", "trades", text), "trades")
    x = enrich.advanced_trades(rows)
    return x.groupBy("symbol", F.nullif("side_normalized", F.lit("")).alias("side"), "hour").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).cast("float").alias("traded"))


def d_candles(spark: SparkSession, d: str) -> DataFrame:
    b = spread(table(spark, d, "bars").filter("open is not null and close is not null and high is not null and low is not null and volume is not null"))
    s = lambda c: F.col(c).cast("string").alias(c)
    text = F.to_json(F.struct(F.col("symbol").alias("product_id"), F.col("timestamp").cast("long").cast("string").alias("start"), *[s(c) for c in ("open", "high", "low", "close", "volume")]))
    rows, _ = parse.events(_nested(b, "candles", "candles", text), "candles")
    return rows.groupBy("symbol", "start").agg(F.count("*").alias("n"), F.max("high").alias("high"), F.min("low").alias("low"))


def d_universe(spark: SparkSession, d: str) -> DataFrame:
    """Bulk responses of three forms, an object of tickers, a list of tickers and a list of trades, flattened to a message a symbol."""
    q = quotes(spark, d).filter("bid is not null").select("exchange", "symbol", "rec_no", F.concat(F.lit('"'), "symbol", F.lit('"')).alias("k"), F.to_json(F.struct("symbol", "bid", "rec_no")).alias("t"))
    # A response holds some twenty records: the strings are bounded.
    few = [F.col("exchange"), F.expr("rec_no div 20").alias("r")]
    one = q.groupBy("exchange", "symbol", "rec_no").agg(F.min("t").alias("t"))  # names in an object are unique
    objects = one.groupBy(*few).agg(F.concat(F.lit("{"), F.array_join(F.collect_list(F.concat(F.lit('"'), "symbol", F.lit("|"), "rec_no", F.lit('":'), "t")), ","), F.lit("}")).alias("data")).select("exchange", F.lit("ticker").alias("type"), "data")
    lists = lambda kind: q.groupBy(*few).agg(F.concat(F.lit("["), F.array_join(F.collect_list("t"), ","), F.lit("]")).alias("data")).select("exchange", F.lit(kind).alias("type"), "data")
    u = parse.universe(objects.unionByName(lists("list")).unionByName(lists("trades")))
    trades = F.from_json("data", "array<struct<bid: double>>")
    n = F.when(F.col("type") == "trades", F.size(trades)).otherwise(1)
    high = F.when(F.col("type") == "trades", F.array_max(F.transform(trades, lambda x: x["bid"]))).otherwise(F.get_json_object("data", "$.bid").cast("double"))
    return u.groupBy("type", "exchange", F.substring_index("symbol", "|", 1).alias("symbol")).agg(F.sum(n).alias("n"), F.max(high).alias("high"))


def e_odd_times(spark: SparkSession, d: str) -> DataFrame:
    """The same instants as text in several forms, seconds, milliseconds and junk, with a fallback column; and the market-hours flag."""
    t = table(spark, d, "ticker").filter("timestamp is not null").select("rec_no", "file_no", "timestamp")
    ts = F.timestamp_millis(F.expr("timestamp div 1000 * 1000"))
    case = F.col("rec_no") % 7
    text = (
        F.when(case == 0, F.date_format(ts, "yyyy/MM/dd HH:mm:ss")).when(case == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(case == 2, F.expr("cast(timestamp div 1000 as string)")).when(case == 3, F.expr("cast(timestamp div 1000 * 1000 as string)"))
        .when(case == 4, F.date_format(ts, "dd MMM yyyy HH:mm:ss")).when(case == 5, F.lit("no time"))
    )
    f = timefn.add_time_fields(t.select("rec_no", "file_no", text.alias("text"), F.expr("timestamp div 1000").alias("seconds")), "text", "seconds", "t_")
    return f.select("rec_no", "file_no", "t_year", "t_hour", "t_minute", "t_second", "t_date", timefn.market_hours(F.to_timestamp("t_datetime")).alias("open"))


def g_raw_arrays(spark: SparkSession, d: str) -> DataFrame:
    f = book.snapshot_features(books(spark, d), CFG.max_levels, CFG.bands_bps, keep_raw_arrays=True, carry=["seq"])
    return _rounded(f.select("seq", F.size("bids").alias("n_bids"), F.size("asks").alias("n_asks"), F.col("bids")[0]["price"].alias("bid"), F.col("asks")[0]["size"].alias("ask_size")), ["seq", "n_bids", "n_asks"], ["bid", "ask_size"])


def i_feature_windows(spark: SparkSession, d: str) -> DataFrame:
    """Realised volatility, flow sums and slope statistics of the feature row, every book."""
    day = 86_400
    cfg = features.FeatureConfig(horizons=(30 * day, 60 * day), hf_emit_interval=0.001, spread_regime_window=60 * day, kyle_lambda_window=60 * day, depth_window=60 * day, slope_window=60 * day)
    f = features.hf_features(books(spark, d), None, cfg, every_row=True)
    return _rounded(f, ["seq"], ["rv_2592000s", "rv_5184000s", "ofi_sum_2592000s", "kyle_lambda", "kyle_lambda_r2", "bid_slope_mean_5184000s", "ask_slope_mean_5184000s"], 1)


def j_collisions_found(spark: SparkSession, d: str) -> DataFrame:
    """Names that two folders share: the files of the listing, and the same files once more in another folder."""
    f = table(spark, d, "ticker_files").select("path").distinct()
    u = f.unionByName(f.select(F.concat(F.lit("moved/"), F.regexp_extract("path", r"([^/]+)$", 1)).alias("path")))
    return u.groupBy(F.regexp_extract("path", r"([^/]+)$", 1).alias("name")).agg(F.count("*").alias("n")).filter("n > 1")


def m_arrival(spark: SparkSession, d: str) -> DataFrame:
    """Order of arrival of messages: by segment name, then line; compared by what it must hold."""
    ok, _ = segments.read_ndjson(spark, segments.segments(spark, _log(spark, d) + "/ready"), parse.ENVELOPE)
    a = job.with_arrival(ok)
    hour = F.substring("_file", 9, 11)
    return a.groupBy(hour.alias("hour")).agg(F.count("*").alias("n"), F.countDistinct("seq").alias("places"))


def n_stream_bars(spark: SparkSession, d: str) -> DataFrame:
    """Windows of event time by a stream over the ticks, each emitted once when the watermark has passed it."""
    at, out = scratch(spark, "stream"), scratch(spark, "stream-out")
    t = ticks(spark, d).select(*KEY, "ts", "seq", "price", "amount")
    t.repartition(4).write.parquet(at)
    s = spark.readStream.schema(t.schema).parquet(at)
    q = live.start(live.windowed_bars(s, 900, "5 minutes"), lambda b, n: sinks.write_dataset(b, f"{out}/batch={n}"), scratch(spark, "stream-state"))
    q.awaitTermination()
    return spark.read.parquet(out).select(*KEY, "window_start", "open", "high", "low", "close", F.round("volume", 5).cast("float").alias("volume"), "trades")


def n_etl(spark: SparkSession, d: str) -> DataFrame:
    """The job over the log: segments claimed, parsed once, channels enriched and written; those of a failed run are taken back first."""
    root = _log(spark, d)
    cfg = Config(raw_dir=root, processed_dir=root + "/out", channels={"ticker": ChannelConfig(), "trades": ChannelConfig(partition_cols=["exchange"])}, delete_after_processing=False)
    out = root + "/out"
    ready = segments.segments(spark, root + "/ready")
    claimed = [f"{root}/processing/{p.rsplit('/', 1)[-1]}" for p in ready]
    for a, b in zip(ready, claimed):
        fs.rename(spark, a, b)
    stats = job.process_segments(spark, claimed, out, cfg)
    counts = spark.createDataFrame([("messages", stats["messages"]), ("rejected", stats["rejected"])], "name string, n long")
    tr = spark.read.parquet(f"{out}/trades").agg(F.lit("trades").alias("name"), F.count("*").alias("n"))
    tk = spark.read.parquet(f"{out}/ticker").agg(F.lit("ticker").alias("name"), F.count("*").alias("n"))
    return counts.unionByName(tr).unionByName(tk)


def o_chain(spark: SparkSession, d: str) -> DataFrame:
    """Delete, then update, then merge, on one dataset."""
    t = _dataset(spark, d)
    t.delete(F.col("base_volume") < 5000)
    t.update(F.col("bid") > F.col("ask"), {"bid": F.col("ask")})
    new = quotes(spark, d).filter("bid is not null").select("exchange", "symbol", "date", F.when(F.col("base_volume") >= 5000, F.col("rec_no")).otherwise(-F.col("rec_no")).alias("rec_no"), F.lit(1.5).alias("bid"), F.lit(None).cast("double").alias("ask"), "base_volume").distinct()
    t.upsert(new, ["rec_no"], ["bid", "ask"])
    return t.read().select("exchange", "date", "symbol", "rec_no", "bid", "ask")


def o_dry_run(spark: SparkSession, d: str) -> DataFrame:
    """What a delete would do; nothing is done."""
    t = _dataset(spark, d)
    s = t.delete(F.col("base_volume") < 5000, dry_run=True)
    return t.read().agg(F.count("*").alias("rows_now")).select("rows_now", F.lit(s.rows_before).cast("long").alias("rows_before"), F.lit(s.rows_deleted).cast("long").alias("rows_deleted"), F.lit(s.partitions).cast("long").alias("partitions"))


def p_migrate(spark: SparkSession, d: str) -> DataFrame:
    """Another partitioning in place, with a backup until it reads back."""
    at = scratch(spark, "migrate")
    sinks.write_dataset(ticks(spark, d), at, ["exchange"])
    layout.migrate(spark, at, ["symbol", "side"], lambda x: x.withColumn("side", F.coalesce("side", F.lit("unknown"))))
    return spark.read.parquet(at).groupBy(F.col("symbol").cast("string").alias("symbol"), F.col("side").cast("string").alias("side")).agg(F.count("*").alias("n"), F.max("price").alias("high"))


def p_validate(spark: SparkSession, d: str) -> DataFrame:
    """The five checks of a dataset: one required column has nulls, no file is named as expected, and files of different folders share names, as Spark writes them."""
    at = scratch(spark, "validate")
    sinks.write_dataset(quotes(spark, d).select("exchange", "symbol", "rec_no", "bid"), at, ["exchange"])
    r = layout.validate(spark, at, ["exchange"], ["rec_no", "bid"])
    return spark.createDataFrame([(k, v) for k, v in r.checks.items()], "name string, ok boolean")


def p_reprocess(spark: SparkSession, d: str) -> DataFrame:
    """A channel's dataset made anew from kept segments after its partitioning changed."""
    root = _log(spark, d)
    cfg = Config(processed_dir=root + "/out", channels={"trades": ChannelConfig(partition_cols=["exchange"])})
    out = cfg.layout("x")["processed"]
    kept = root + "/ready"
    job.process_segments(spark, segments.segments(spark, kept), out, cfg)
    cfg.channels["trades"].partition_cols = ["symbol"]
    job.migrate_schema(spark, "x", cfg, ["trades"], archive=root + "/old", segments_from=kept)
    folder = F.regexp_extract(F.input_file_name(), r"symbol=([^/]+)", 1)
    t = spark.read.parquet(f"{out}/trades").select(folder.alias("folder"), "price", "amount")
    return t.groupBy("folder").agg(F.count("*").alias("n"), F.max("price").alias("high"))


def q_compact_sync(spark: SparkSession, d: str) -> DataFrame:
    """Jobs of a schedule, two rounds: one file a folder, copied; the second round finds all there."""
    a, b = scratch(spark, "from"), scratch(spark, "to")
    q = quotes(spark, d).select("exchange", "rec_no", "file_no", "bid")
    for part in ("file_no % 2 = 0", "file_no % 2 = 1"):
        sinks.write_dataset(q.filter(part), a, ["exchange"])
    list(sync.scheduled(spark, [{"source": a, "target": b, "suffix": ".parquet", "compact": True}], 0, 2))
    files = layout.partitions(spark, b).agg(F.max("files").alias("most_files")).first()[0]
    return spark.read.parquet(b).groupBy(F.col("exchange").cast("string").alias("exchange")).agg(F.count("*").alias("n"), F.max("bid").alias("high")).withColumn("most_files", F.lit(files).cast("long"))


def r_chain(spark: SparkSession, d: str) -> DataFrame:
    """Own operators one after the other: one that drops rows, one that multiplies them, one that adds a column."""
    drop = lambda x: x.filter("side is not null")
    twice = lambda x: x.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    value = lambda x: x.withColumn("value", F.col("price") * F.col("amount") * F.col("copy"))
    return enrich.chain(ticks(spark, d), drop, twice, value).groupBy(*KEY, "copy").agg(F.count("*").alias("n"), F.round(F.max("value"), 3).cast("float").alias("most"))


def queries() -> dict:
    return {n: f for n, f in globals().items() if n[:1] in "abcdegijmnopqr" and n[1:2] == "_" and callable(f)}


_OPEN = """(select *, "timestamp" // 900000 * 900000 w from (select *, ts as "timestamp" from """ + _TICKS + "))"


def oracle_sql() -> dict[str, str]:
    n_ticker, n_trades = "(select count(*) from ticker)", "(select count(*) from trades)"
    day = "make_timestamp(collected_at * 1000)::date = date '2025-03-04'"
    roll = lambda f, c, w: f"(coalesce({f}({c}) over (partition by exchange, symbol order by ts range between {w - 1} preceding and current row), 0) - coalesce({f}({c}) over (partition by exchange, symbol, ts order by seq rows between 1 following and unbounded following), 0))"
    month = 86_400_000 * 30
    w = 2 * month
    std = lambda n, s, ss: f"sqrt(case when {n} > 1 then greatest(({ss} - {s} * {s} / {n}) / ({n} - 1), 0) else 0 end)"
    held = lambda c: f"coalesce(last_value(case when {c} is not null then {c}s / {c}n end ignore nulls) over (partition by exchange, symbol order by ts, seq rows between unbounded preceding and current row), 0)"
    single = lambda e, n: f"cast(round({e}, 4) + 0.0 as float) {n}"
    n, ka, kb, kaa, kbb, kab = "n2", "s2", "o2", "ss2", "oo2", "so2"
    cov, va, vb = f"({kab} / {n} - {ka} / {n} * {kb} / {n})", f"({kaa} / {n} - {ka} / {n} * {ka} / {n})", f"({kbb} / {n} - {kb} / {n} * {kb} / {n})"
    windows = f"""with f as (select *, case when pm is null then 0.0 else ln(mid / pm) end ret, {_OFI} ofi, {_slope("bids")} bsl, {_slope("asks")} asl from (select *, least(len(bids), len(asks), 10) n10 from {_LAGGED})),
 x as (select *, {roll("count", "ret", month)} n1, {roll("sum", "ret", month)} s1, {roll("sum", "(ret * ret)", month)} ss1, {roll("sum", "ofi", month)} o1, {roll("count", "ret", w)} n2, {roll("sum", "ret", w)} s2, {roll("sum", "(ret * ret)", w)} ss2, {roll("sum", "ofi", w)} o2,
 {roll("sum", "(ofi * ofi)", w)} oo2, {roll("sum", "(ret * ofi)", w)} so2, {roll("count", "bsl", w)} bsln, {roll("sum", "bsl", w)} bsls, {roll("count", "asl", w)} asln, {roll("sum", "asl", w)} asls from f)
 select seq, {single(std("n1", "s1", "ss1"), "rv_2592000s")}, {single(std("n2", "s2", "ss2"), "rv_5184000s")}, {single("o1", "ofi_sum_2592000s")}, {single(f"case when n2 >= 2 and {vb} >= 1e-10 then {cov} / {vb} else 0 end", "kyle_lambda")},
 {single(f"case when n2 >= 2 and {vb} >= 1e-10 and {va} >= 1e-10 then {cov} * {cov} / ({va} * {vb}) else 0 end", "kyle_lambda_r2")}, {single(held("bsl"), "bid_slope_mean_5184000s")}, {single(held("asl"), "ask_slope_mean_5184000s")} from x"""
    return {
        "i_feature_windows": windows,
        "a_segment_log": f"select 'ticker' \"type\", count(*) n from ticker union all select 'trades', count(*) from trades union all select 'rejected', count(*) from trades where rec_no % 100 = 0",
        "a_segments_of_a_day": f"select 'ticker' \"type\", lower(trim(exchange)) exchange, count(*) n from ticker where {day} group by 2 union all select 'trades', lower(trim(exchange)), count(*) from trades where {day} group by 2",
        "a_glob": f"select strftime(make_timestamp(ts * 1000), '%H') as hour, exchange, symbol, count(*) n, max(price) high from {_TICKS} where date like '2025-03-0%' and hour(make_timestamp(ts * 1000)) in (22, 23) group by 1, 2, 3",
        "a_recursive": f"select exchange, count(*) n, min(price) low, count(side) sides from {_TICKS} group by 1",
        "a_envelopes": "select rec_no, price, 'x' source, coalesce(trade_id, '-') raw from trades",
        "b_landing": """select 'ticker' name, count(*) n, count(exchange) named, cast(round(sum(coalesce("bidVolume", bid_volume)), 2) as float) total from ticker union all select 'trades', count(*), count(exchange), cast(round(sum(amount), 2) as float) from trades
 union all select 'generic', count(*), count(exchange), cast(round(sum("open"), 2) as float) from bars""",
        "b_outputs": f"select 'buys' name, count(*) n from {_TICKS} where side = 'buy' union all select 'sales', count(*) from {_TICKS} where side = 'sell' union all select 'none', 0",
        "b_kept_columns": f"select exchange, replace(symbol, '/', '-') symbol, count(*) n, max(bid) high from {_QUOTES} group by 1, 2",
        "c_usable": """with k as (select exchange || ':' || symbol k, rec_no % 8 c, side from trades where rec_no % 8 in (6, 7) and exchange is not null and symbol is not null) select 'usable' step, count(*) n, count(distinct k) keys from k
 union all select 'picked', count(*), count(distinct k) from k where c = 6 or side in ('buy', 'BUY')""",
        "d_event_ticker": f"""with q as (select *, bid > 0 and ask > 0 ok, high > 0 and low > 0 rg from {_QUOTES} where bid is not null), g as (select symbol, count(*) n, cast(count(*) filter (ok) as bigint) mids, count(*) no_volume, avg((ask - bid) / ((bid + ask) / 2) * 10000) filter (ok) bps, max(high - low) filter (rg) widest from q where rec_no % 50 <> 0 group by 1)
 select symbol, n, mids, no_volume, cast(round(bps, 5) as float) bps, cast(round(widest, 5) as float) widest from g union all select 'rejected', count(*), 0, 0, 0, 0 from q where rec_no % 50 = 0""",
        "d_event_trades": f"select symbol, side, cast(hour(make_timestamp(ts * 1000)) as integer) as hour, count(*) n, cast(round(sum(price * amount), 2) as float) traded from {_TICKS} group by 1, 2, 3",
        "d_candles": """select symbol, cast(cast("timestamp" as bigint) as varchar) as start, count(*) n, max(high) high, min(low) low from bars where "open" is not null and "close" is not null and high is not null and low is not null and volume is not null group by 1, 2""",
        "d_universe": f"""with o as (select exchange, symbol, rec_no, min(bid) bid from {_QUOTES} where bid is not null group by 1, 2, 3), a as (select exchange, symbol, bid from {_QUOTES} where bid is not null)
 select 'ticker' "type", exchange, symbol, count(*) n, max(bid) high from o group by 2, 3 union all select 'list', exchange, symbol, count(*), max(bid) from a group by 2, 3 union all select 'trades', exchange, symbol, count(*), max(bid) from a group by 2, 3""",
        "e_odd_times": """select rec_no, file_no, cast(year(t) as integer) t_year, cast(hour(t) as integer) t_hour, cast(minute(t) as integer) t_minute, cast(second(t) as integer) t_second, strftime(t, '%Y-%m-%d') t_date, hour(t) >= 9 and hour(t) < 16 as "open"
 from (select rec_no, file_no, make_timestamp("timestamp" // 1000 * 1000000) t from ticker where "timestamp" is not null)""",
        "g_raw_arrays": f"select seq, cast(len(bids) as integer) n_bids, cast(len(asks) as integer) n_asks, cast(bids[1].price as float) bid, cast(asks[1].size as float) ask_size from {_BOOKS}",
        "j_collisions_found": "select regexp_extract(path, '([^/]+)$', 1) name, 2 * count(*) n from (select distinct path from ticker_files) group by 1",
        "m_arrival": "with h as (select strftime(make_timestamp(collected_at * 1000), '%Y%m%dT%H') as hour from ticker union all select strftime(make_timestamp(collected_at * 1000), '%Y%m%dT%H') from trades) select hour, count(*) n, count(*) places from h group by 1",
        "n_stream_bars": f"""with m as (select max(ts) - 300000 mark from {_TICKS}) select exchange, symbol, w window_start, arg_min(price, (ts, seq)) as "open", max(price) high, min(price) low, arg_max(price, (ts, seq)) as "close", cast(round(sum(amount), 5) as float) volume, count(price) trades
 from {_OPEN}, m where w + 900000 <= mark group by 1, 2, 3""",
        "n_etl": f"select 'messages' name, {n_ticker} + {n_trades} n union all select 'rejected', count(*) from trades where rec_no % 100 = 0 union all select 'trades', {n_trades} union all select 'ticker', {n_ticker}",
        "o_chain": f"""with q as (select distinct exchange, symbol, date, rec_no, bid, ask, base_volume from {_QUOTES} where bid is not null),
 kept as (select exchange, date, symbol, rec_no, case when bid > ask then ask else bid end bid, ask from q where base_volume >= 5000)
 select k.exchange, k.date, k.symbol, k.rec_no, cast(1.5 as double) bid, k.ask from kept k union all select distinct exchange, date, symbol, -rec_no, cast(1.5 as double), cast(null as double) from q where base_volume < 5000 or base_volume is null""",
        "o_dry_run": f"""with q as (select distinct exchange, symbol, date, rec_no, bid, ask, base_volume from {_QUOTES} where bid is not null) select count(*) rows_now, count(*) rows_before, count(*) filter (base_volume < 5000 or base_volume is null) rows_deleted,
 cast(count(distinct (exchange, date)) filter (base_volume < 5000 or base_volume is null) as bigint) partitions from q""",
        "p_migrate": f"select replace(symbol, '/', '-') symbol, coalesce(side, 'unknown') side, count(*) n, max(price) high from {_TICKS} group by 1, 2",
        "p_validate": f"select * from (values ('files', true), ('partition_columns', true), ('names', false), ('collisions', false), ('required', (select count(*) = count(bid) from ticker))) v(name, ok)",
        "p_reprocess": "select replace(symbol, '/', '-') folder, count(*) n, max(price) high from trades group by 1",
        "q_compact_sync": f"select exchange, count(*) n, max(bid) high, cast(1 as bigint) most_files from {_QUOTES} group by 1",
        "r_chain": f"select exchange, symbol, copy, count(*) n, cast(round(max(price * amount * copy), 3) as float) most from {_TICKS}, (values (1), (2)) v(copy) where side is not null group by 1, 2, 3",
    }
