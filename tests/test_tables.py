"""Sources, sinks, parsing, times, changes to datasets, layout, sync, configuration, the job and streams."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideframe import job
from tideframe.config import ChannelConfig, Config, FeatureConfig, load_config, write_example
from tideframe.functions import fs, normal, timefn
from tideframe.operators import dml, enrich, latebars, layout, parse
from tideframe.operators import features as feat
from tideframe.session import scratch
from tideframe.sources import segments, sinks, sync
from tideframe.streaming import live


def test_time_fields(spark):
    rows = [(1, "2025-11-20T12:00:00Z"), (2, "2025-11-20T00:20:00+05:00"), (3, "2025-11-20T12:00:00.123456789Z"), (4, "2025-11-20T12:00:00.5"), (5, "junk"), (6, None), (7, "1763640000000"), (8, "20 Nov 2025"), (9, "2025-11-22 01:02:03")]
    d = timefn.add_time_fields(spark.createDataFrame(rows, "id int, t string"), "t")
    g = {r.id: r for r in d.collect()}
    assert (g[1].year, g[1].hour, g[1].date, g[1].day_of_week, g[1].is_weekend) == (2025, 12, "2025-11-20", 3, False)
    assert g[2].hour == 0 and g[2].date == "2025-11-20"
    assert g[3].microsecond == 123456 and g[4].microsecond == 500000
    assert g[5].year is None and g[6].date is None
    assert g[7].date == "2025-11-20" and g[8].date == "2025-11-20" and g[9].is_weekend
    n = timefn.add_time_fields(spark.createDataFrame([(1700481600.0, None), (1700481600000.0, None), (None, 1700481600)], "a double, b long"), "a", "b", "p_")
    assert {r.p_date for r in n.collect()} == {"2023-11-20"}
    assert timefn.add_time_fields(n, "missing").columns == n.columns
    u = spark.createDataFrame([("2025-11-20T12:00:00+02:00",), ("x",)], "t string").select(F.unix_millis(timefn.to_utc(F.col("t"))).alias("m")).collect()
    assert u[0].m == 1763632800000 and u[1].m is None


def test_normal_forms(spark):
    d = spark.createDataFrame([(" Kelvane ", "A-B", "OFFER", "b"), (None, None, "x", None)], "e string, s string, side string, t string")
    r = d.select(normal.exchange("e").alias("e"), normal.instrument("s").alias("s"), normal.book_side("side").alias("b"), normal.trade_side("t").alias("t")).collect()
    assert tuple(r[0]) == ("kelvane", "A/B", "ask", "buy") and tuple(r[1]) == (None, None, None, None)


MSG = {
    "ticker": {"type": "ticker", "exchange": "ax", "symbol": "A/B", "method": "m", "collected_at": 1000, "data": {"timestamp": 0, "bid": 10, "ask": 11.5, "last": None, "info": {"k": 1}}},
    "trades": {"type": "trades", "exchange": "ax", "symbol": "A/B", "method": "m", "collected_at": 2000, "data": [{"id": "1", "timestamp": 1500, "side": "buy", "price": 1.5, "amount": 2}, {"id": "2", "price": 3}]},
    "single": {"type": "trades", "exchange": "ax", "symbol": "A/B", "collected_at": 2500, "data": {"id": "3", "timestamp": 2400, "price": 4, "datetime": "2024-02-03T00:00:00Z"}},
    "book": {"type": "orderbook", "exchange": "ax", "symbol": "A/B", "collected_at": 3000, "data": {"bids": [[10, 1], [9, 2]], "nonce": 5}},
    "other": {"type": "bidask", "exchange": "ax", "symbol": "A/B", "collected_at": 3000, "data": {"x": 1}},
    "empty": {"type": "trades", "exchange": "ax", "symbol": "A/B", "collected_at": 1, "data": []},
}


def write_segment(folder, name, messages, extra=()):
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / name, "w") as f:
        for m in messages:
            f.write(json.dumps({**m, "data": json.dumps(m["data"]) if False else m["data"]}) + "\n")
        f.writelines(x + "\n" for x in extra)


def test_unified_messages(spark, tmp_path):
    write_segment(tmp_path, "segment_20251120T14_00001.ndjson", MSG.values(), ["", "   ", '{"type": "tra', "[1, 2]"])
    ok, bad = segments.read_ndjson(spark, str(tmp_path), parse.ENVELOPE)
    assert ok.count() == 6 and bad.count() == 2
    t = parse.ticker(ok).first()
    assert (t.bid, t.ask, t.timestamp, t.date, t.product_id) == (10.0, 11.5, 1000, "1970-01-01", "A/B") and t.last is None
    g = {r.trade_id: r for r in parse.trades(ok).collect()}
    assert set(g) == {"1", "2", "3"} and g["2"].timestamp == 2000 and g["2"].side is None and g["3"].date == "2024-02-03"
    b = parse.orderbook(ok, depth=1).first()
    assert b.bids == [[10.0, 1.0]] and b.asks == [] and b.nonce == 5
    s = {r.type: r.n for r in parse.stats(ok).collect()}
    assert s == {"ticker": 1, "trades": 3, "orderbook": 1, "bidask": 1}
    land = parse.landing(ok)
    assert land["trades"].count() == 3 and land["generic"].first().data_json == '{"x":1}' and land["orderbook"].first().bids[0].size == 1.0
    assert json.loads(land["ticker"].first().info_json) == {"k": 1}
    u = parse.universe(spark.createDataFrame([("ax", '{"A/B": {"bid": 1}, "C/D": {"bid": 2}}')], "exchange string, data string"))
    assert sorted((r.symbol, json.loads(r.data)["bid"]) for r in u.collect()) == [("A/B", 1), ("C/D", 2)]


def test_event_messages(spark):
    data = lambda c, e: json.dumps({"capture_ts": "2025-11-20T12:00:00Z", "data": {"channel": c, "timestamp": "2025-11-20T12:00:01Z", "sequence_num": 3, "events": e}, "metadata": {}})
    lines = [
        data("ticker", [{"type": "update", "tickers": [{"product_id": "BTC-USD", "price": "95000.5", "best_bid": "1", "best_ask": "2"}, {"product_id": "X", "price": "none"}]}]),
        data("l2_data", [{"type": "snapshot", "product_id": "BTC-USD", "updates": [{"side": "offer", "price_level": "5", "new_quantity": "1.5", "event_time": "t"}]}]),
        data("market_trades", [{"type": "update", "trades": [{"trade_id": "1", "product_id": "P", "price": "2", "size": "3", "side": "BUY", "time": "2025-11-20T12:00:00Z"}]}]),
        data("candles", [{"candles": [{"start": "1", "high": "2", "product_id": "P"}]}]), data("heartbeats", []), data("unknown", []),
    ]
    ok, bad = segments.parse_json(spark.createDataFrame([(x,) for x in lines], "value string"), parse.events_schema())
    assert bad.count() == 0
    t, rejects = parse.events(ok, "ticker")
    r = enrich.advanced_ticker(t).first()
    assert r.price == 95000.5 and r.volume_24h == 0.0 and r.mid_price == 1.5 and r.exchange == "coinbase" and r.hour == 12
    assert t.count() == 1 and rejects.count() == 1
    b = enrich.level2(parse.events(ok, "orderbook")[0]).first()
    assert b.is_snapshot and b.side_normalized == "ask" and b.symbol == "BTC-USD"
    x = enrich.advanced_trades(parse.events(ok, "trades")[0]).first()
    assert x.value == 6.0 and x.side_normalized == "buy"
    c = parse.events(ok, "candles")[0].first()
    assert c.event_type == "unknown" and c.start == "1" and c.low == 0.0


def test_segments_by_date(spark, tmp_path):
    for n in ("segment_20251119T23_00002.ndjson", "segment_20251120T00_00001.ndjson", "segment_20251121T00_00001.ndjson", "other.ndjson"):
        (tmp_path / n).write_text("{}\n")
    names = [p.rsplit("/", 1)[-1] for p in segments.segments(spark, str(tmp_path), "2025-11-19", "2025-11-20")]
    assert names == ["segment_20251119T23_00002.ndjson", "segment_20251120T00_00001.ndjson"]
    assert len(segments.segments(spark, str(tmp_path))) == 4


ROWS = "product_id string, trade_id string, price double, side string, date string, w int"


def dataset(spark, rows=None):
    at = scratch(spark, "ds")
    rows = rows or [("A/B", str(i), float(i), "buy" if i % 2 else None, f"2025-11-{20 + i % 2}", i) for i in range(20)]
    assert sinks.write_dataset(spark.createDataFrame(rows, ROWS), at, ["product_id", "date"])
    return dml.Dataset(spark, at, ["product_id", "date"])


def test_sinks(spark):
    d = dataset(spark)
    assert {r.product_id for r in d.read().select("product_id").collect()} == {"A-B"}
    assert not sinks.write_dataset(d.read().limit(0), scratch(spark, "e"), ["date"])
    with pytest.raises(ValueError):
        sinks.write_dataset(d.read(), scratch(spark, "e"), ["nope"])
    at = scratch(spark, "kept")
    sinks.write_dataset(d.read(), at, ["product_id", "date"], keep_columns=True)
    one = fs.files(spark, at)[0].path
    assert "product_id=A-B" in one and set(spark.read.parquet(one).columns) >= {"product_id", "date"}
    assert spark.read.parquet(at).count() == 20
    out = sinks.write_outputs({"a": d.read(), "b": d.read().limit(0)}, scratch(spark, "multi"))
    assert out == {"a": True, "b": False}


def test_delete_update_upsert(spark):
    d = dataset(spark)
    assert d.delete(F.col("price") < 3, dry_run=True).rows_deleted == 3 and d.read().count() == 20
    s = d.delete(F.col("price") < 3, {"product_id": "A/B"})
    assert (s.rows_deleted, s.rows_after, s.partitions) == (3, 17, 2) and d.read().count() == 17
    d.delete(F.col("side") == "sell")  # null sides go as well
    assert d.read().filter("side is null").count() == 0 and d.read().filter("date = '2025-11-20'").count() == 0
    n = d.read().count()
    s = d.update(F.col("price") > 10, {"price": 0.0, "side": "late"})
    assert s.rows_updated == 5 and d.read().filter("price = 0").count() == 5 and d.read().filter("side = 'late'").count() == 0
    with pytest.raises(ValueError):
        d.update(F.lit(True), {"nope": 1})
    new = spark.createDataFrame([("A/B", "3", None, "x", "2025-11-21", 7), ("A/B", "3", None, "x", "2025-11-21", 7), ("C/D", "1", 1.0, None, "2025-11-22", None), ("A/B", "99", 9.0, None, "2025-11-21", None)], ROWS)
    s = d.upsert(new, ["trade_id"])
    assert (s.rows_updated, s.rows_inserted) == (1, 2) and d.read().count() == n + 2
    r = d.read().filter("trade_id = '3'").first()
    assert r.price == 3.0 and r.side == "x" and r.w == 7
    assert d.upsert(new.limit(0), ["trade_id"]).rows_inserted == 0
    with pytest.raises(ValueError):
        d.upsert(new.drop("date"), ["trade_id"])
    fs.write_text(spark, f"{d.path}/{dml.MARKER}", "x")
    with pytest.raises(RuntimeError):
        d.delete(F.lit(True))
    fs.delete(spark, f"{d.path}/{dml.MARKER}")
    back = dml.Dataset(spark, d.path, d.parts, backup=scratch(spark, "backup"))
    back.delete(F.lit(True))
    assert not fs.files(spark, d.path)


def test_partition_values_that_are_escaped_in_folder_names(spark):
    at = scratch(spark, "escaped")
    odd = ["BTC-USDT:USDT", "5%", "a=b", "#1'", "01", "1", "2025-03-04 10:00:00", None]
    rows = [(s, i, float(i)) for s in odd for i in range(4)]
    sinks.write_dataset(spark.createDataFrame(rows, "symbol string, k int, v double"), at, ["symbol"])
    d = dml.Dataset(spark, at, ["symbol"])
    held = lambda: Counter((r.symbol, r.k, r.v) for r in d.read().collect())
    assert d.delete(F.col("k") == 0).rows_deleted == len(odd)
    assert held() == Counter(r for r in rows if r[1])
    assert d.update(F.col("k") == 1, {"v": -1.0}).rows_updated == len(odd)
    want = {(s, k): -1.0 if k == 1 else v for s, k, v in rows if k}
    assert held() == Counter((*k, v) for k, v in want.items())
    new = [(s, k, 9.0) for s in [*odd[:-1], "new:%"] for k in (2, 7)]
    s = d.upsert(spark.createDataFrame(new, "symbol string, k int, v double"), ["k"])
    assert (s.rows_updated, s.rows_inserted) == (len(odd) - 1, len(odd) + 1)
    want |= {(s, k): v for s, k, v in new}
    assert held() == Counter((*k, v) for k, v in want.items())
    with pytest.raises(RuntimeError):
        d.update(F.col("k") == 7, {"symbol": "elsewhere"})
    assert held() == Counter((*k, v) for k, v in want.items())
    assert d.delete(F.lit(True)).rows_after == 0 and not fs.files(spark, at)


@pytest.mark.parametrize("how", ["update", "upsert", "delete", "flat"])
def test_a_failed_move_loses_nothing(spark, monkeypatch, how):
    """Each rename of a change fails in turn: the dataset stays whole and can be changed at once."""
    rows = [(p, i, float(i)) for p in "abcd" for i in range(10)]
    at, parts = scratch(spark, "faulty"), [] if how == "flat" else ["p"]
    sinks.write_dataset(spark.createDataFrame(rows, "p string, k int, v double"), at, parts)
    d = dml.Dataset(spark, at, parts)
    held = lambda: Counter((r.p, r.k, r.v) for r in d.read().collect())
    rename, calls = fs.rename, Counter()
    change = {
        "update": lambda: d.update(F.lit(True), {"v": 1.0}), "flat": lambda: d.update(F.lit(True), {"v": 1.0}), "delete": lambda: d.delete(F.col("k") < 9),
        "upsert": lambda: d.upsert(spark.createDataFrame([(p, 3, 5.0) for p in "abcde"], "p string, k int, v double"), ["k"]),
    }[how]
    for fails in range(4):
        calls.clear()

        def faulty(s, a, b):
            calls["n"] += 1
            if calls["n"] == fails + 1:
                raise OSError("injected")
            rename(s, a, b)

        monkeypatch.setattr(fs, "rename", faulty)
        if how == "flat" and fails > 1:
            break
        with pytest.raises(RuntimeError):
            change()
        monkeypatch.setattr(fs, "rename", rename)
        assert held() == Counter(rows) and not fs.exists(spark, f"{at}/{dml.MARKER}") and not [f for f in fs.files(spark, at) if "_staging" in f.path]
    monkeypatch.setattr(fs, "rename", rename)
    assert not change().failed and held() != Counter(rows)


def test_an_interrupted_change_is_taken_back(spark, monkeypatch):
    rows = [(p, i, float(i)) for p in "abcd" for i in range(10)]
    at = scratch(spark, "broken")
    sinks.write_dataset(spark.createDataFrame(rows, "p string, k int, v double"), at, ["p"])
    d = dml.Dataset(spark, at, ["p"])
    rename, calls = fs.rename, Counter()

    def dies(s, a, b):
        calls["n"] += 1
        if calls["n"] > 5:
            raise OSError("gone for good")
        rename(s, a, b)

    monkeypatch.setattr(fs, "rename", dies)
    with pytest.raises(Exception):
        d.update(F.lit(True), {"v": 1.0})
    monkeypatch.setattr(fs, "rename", rename)
    with pytest.raises(RuntimeError):
        d.update(F.lit(True), {"v": 1.0})  # refused until it is taken back
    assert dml.recover(spark, at) == "moving" and dml.recover(spark, at) == ""
    assert Counter((r.p, r.k, r.v) for r in d.read().collect()) == Counter(rows)
    d.isolate = True
    monkeypatch.setattr(fs, "rename", lambda s, a, b: (_ for _ in ()).throw(OSError("x")) if "p=c" in a else rename(s, a, b))
    assert d.update(F.lit(True), {"v": 1.0}).failed == [("c",)]
    got = {r.p: r.s for r in d.read().groupBy("p").agg(F.sum("v").alias("s")).collect()}
    assert got == {"a": 10.0, "b": 10.0, "c": 45.0, "d": 10.0}


def test_many_partitions_are_found_by_a_join(spark, monkeypatch):
    rows = [(f"d{i % 9}" if i % 9 else None, i % 2 and "x" or None, i) for i in range(90)]
    at = scratch(spark, "many")
    sinks.write_dataset(spark.createDataFrame(rows, "p string, q string, k int"), at, ["p", "q"])
    d = dml.Dataset(spark, at, ["p", "q"])
    monkeypatch.setattr(dml, "NAMED", 3)
    assert d.update(F.col("k") >= 0, {"k": 7}).rows_updated == 90 and d.read().filter("k = 7").count() == 90
    plan = d._in(d.read(), [{"p": f"d{i}", "q": "x"} for i in range(1, 9)])._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan


def test_compaction_and_repair_are_swapped_or_not_at_all(spark, monkeypatch):
    at = scratch(spark, "tiny")
    for i in range(3):
        spark.createDataFrame([(p, i) for p in ("a:b", "c d+e")], "p string, k int").coalesce(1).write.mode("append").partitionBy("p").parquet(at)
    rows = Counter((r.p, r.k) for r in spark.read.parquet(at).collect())
    rename, calls = fs.rename, Counter()
    for fails in range(4):
        calls.clear()

        def faulty(s, a, b):
            calls["n"] += 1
            if calls["n"] == fails + 1:
                raise OSError("injected")
            rename(s, a, b)

        monkeypatch.setattr(fs, "rename", faulty)
        with pytest.raises(RuntimeError):
            layout.compact(spark, at)
        monkeypatch.setattr(fs, "rename", rename)
        assert Counter((r.p, r.k) for r in spark.read.parquet(at).collect()) == rows and len(fs.files(spark, at)) == 6
    s = layout.compact(spark, at)
    assert (s["files_before"], s["files_after"], s["rows"]) == (6, 2, 6)
    assert Counter((r.p, r.k) for r in spark.read.parquet(at).collect()) == rows and len(fs.files(spark, at)) == 2
    spark.createDataFrame([("a:b", 9)], "p string, k int").coalesce(1).write.mode("append").partitionBy("p").parquet(at)
    assert layout.compact(spark, at, max_file_mb=0.5)["files_before"] == 2 and len(fs.files(spark, at)) == 2


def test_addresses_workers_read():
    from tideframe.functions import workerfs

    assert workerfs.uri("s3a://b/k") == "s3://b/k" and workerfs.uri("s3n://b/k") == "s3://b/k" and workerfs.uri("dbfs:/x/y") == "/dbfs/x/y"
    assert workerfs.uri("file:///tmp/x") == "/tmp/x" and workerfs.uri("/tmp/a:b") == "/tmp/a:b" and workerfs.uri("hdfs://n/x") == "hdfs://n/x"


def test_deduplicate_with_ties_and_nulls(spark):
    rows = [("A", "1", 1.0, None, "d", i) for i in range(9)] + [("A", None, 2.0, None, "d", 1), ("A", None, 1.0, None, "d", 1)]
    d = dataset(spark, rows)
    s = d.deduplicate(["trade_id"], [F.col("price")])
    assert s.rows_after == 2 and sorted(r.price for r in d.read().collect()) == [1.0, 1.0]


def test_layout(spark):
    d = dataset(spark)
    for _ in range(3):
        sinks.write_dataset(d.read(), d.path, ["product_id", "date"])
    n = d.read().count()
    before = len(fs.files(spark, d.path))
    assert layout.compact(spark, d.path, dry_run=True)["files_after"] == 2
    s = layout.compact(spark, d.path, sort_by=["price", "nope"])
    assert before > 2 and len(fs.files(spark, d.path)) == 2 and d.read().count() == n == s["rows"]
    assert layout.validate(spark, d.path, ["product_id", "date"], ["price"]).ok
    p = layout.partitions(spark, d.path)
    assert sorted(r.partition for r in p.collect()) == ["product_id=A-B/date=2025-11-20", "product_id=A-B/date=2025-11-21"]
    to = scratch(spark, "to")
    r = layout.repartition(spark, d.path, to, ["hour"], lambda x: x.withColumn("hour", F.col("price") % 3))
    assert r["rows"] == n and r["partitions"] == 3
    with pytest.raises(ValueError):
        layout.repartition(spark, d.path, to, ["nope"])
    layout.migrate(spark, d.path, ["side"])
    assert spark.read.parquet(d.path).count() == n
    assert layout.estimate(spark.read.parquet(d.path), ["date"]).first().total_rows == n


def test_mismatched_files_are_repaired(spark):
    at = scratch(spark, "bad")
    spark.createDataFrame([("A/B", 1), ("A/B", 2)], "symbol string, v int").write.parquet(at + "/symbol=A-B")
    assert layout.mismatches(spark, at, ["symbol"]).count() > 0
    assert layout.repair(spark, at, ["symbol"]) > 0
    assert layout.mismatches(spark, at, ["symbol"]).count() == 0
    assert spark.read.option("recursiveFileLookup", "true").parquet(at).filter("symbol = 'A-B'").count() == 2


def test_sync(spark):
    d, to, seen = dataset(spark), scratch(spark, "to"), []
    s = sync.sync(spark, d.path, to, ".parquet", on_success=lambda a, b: seen.append(b))
    assert s["copied"] == len(seen) > 0 and spark.read.parquet(to).count() == 20
    assert sync.sync(spark, d.path, to, ".parquet")["skipped"] == s["copied"]
    assert sync.sync_jobs(spark, [{"source": d.path, "target": scratch(spark, "to"), "suffix": ".parquet", "compact": True}])[0]["copied"] == 2


def test_backlog(spark):
    f = spark.createDataFrame([(10, 0), (20, 500_000)], "size long, modified_ms long")
    assert layout.backlog_health(f, 700_000).first().status == "critical" and layout.backlog_health(f, 550_000).first().status == "ok"
    assert layout.backlog_health(f.limit(0), 1).first().files == 0


def test_configuration(tmp_path, monkeypatch):
    c = FeatureConfig.from_options({"hf_sample_interval": 2.0, "horizons": [1, 2], "unknown": 1})
    assert c.hf_emit_interval == 2.0 and c.horizons == (1, 2) and c.max_levels == 20
    write_example(str(tmp_path / "c.json"))
    monkeypatch.setenv("TIDEFRAME_CONFIG", str(tmp_path / "c.json"))
    assert load_config().to_dict() == Config().to_dict()
    monkeypatch.setenv("TIDEFRAME_CONFIG", str(tmp_path / "none.json"))
    with pytest.raises(FileNotFoundError):
        load_config()


def books_and_trades(n=60):
    r = random.Random(1)
    out = []
    for i in range(n):
        t = 1_700_000_000_000 + i * 400
        out.append({"type": "orderbook", "exchange": "ax", "symbol": "A/B", "collected_at": t, "data": {"timestamp": t, "bids": [[100 - 0.5 * k - r.random(), 1 + k] for k in range(3)], "asks": [[101 + 0.5 * k, 2 + k] for k in range(3)]}})
        out.append({"type": "trades", "exchange": "ax", "symbol": "A/B", "collected_at": t, "data": [{"id": str(i), "timestamp": t, "side": "buy", "price": 100.5, "amount": 1}]})
        out.append({"type": "ticker", "exchange": "ax", "symbol": "A/B", "collected_at": t, "data": {"timestamp": t, "bid": 100, "ask": 101}})
    return out


def test_the_job_from_segments_to_datasets(spark, tmp_path):
    cfg = Config(raw_dir=f"file://{tmp_path}/raw", processed_dir=f"file://{tmp_path}/out", channels={"ticker": ChannelConfig(), "trades": ChannelConfig(), "orderbook": ChannelConfig(processor_options={"bar_durations": [5], "horizons": [5], "max_levels": 3})})
    m = books_and_trades()
    write_segment(tmp_path / "raw/ready/s", "segment_20231114T22_00001.ndjson", m[:90], ['{"broken'])
    write_segment(tmp_path / "raw/ready/s", "segment_20231114T22_00002.ndjson", m[90:])
    s = job.drain(spark, "s", cfg)
    assert s == {"messages": 180, "rejected": 1}
    out = f"file://{tmp_path}/out/s"
    assert spark.read.parquet(out + "/ticker").count() == 60 and spark.read.parquet(out + "/trades").count() == 60
    assert 20 <= spark.read.parquet(out + "/orderbook_hf").count() <= 30 and spark.read.parquet(out + "/orderbook_bars").count() == 4
    assert job.drain(spark, "s", cfg)["messages"] == 0 and job.retry(spark, "s", cfg) == 0


def test_the_job_as_a_stream(spark, tmp_path):
    cfg = Config(raw_dir=f"file://{tmp_path}/raw", processed_dir=f"file://{tmp_path}/out", delete_after_processing=False)
    m = books_and_trades(20)
    write_segment(tmp_path / "raw/ready/s", "segment_20231114T22_00001.ndjson", m[:30])
    q = job.watch(spark, "s", cfg, f"file://{tmp_path}/cp", once=True)
    q.awaitTermination(120)
    write_segment(tmp_path / "raw/ready/s", "segment_20231114T22_00002.ndjson", m[30:])
    q = job.watch(spark, "s", cfg, f"file://{tmp_path}/cp", once=True)  # a restart takes only what is new
    q.awaitTermination(120)
    assert spark.read.parquet(f"file://{tmp_path}/out/s/trades").count() == 20


def test_the_stream_writes_what_the_batch_job_writes(spark, tmp_path):
    """Several micro-batches, restarts between them, one-sided and missing books, a quiet key, a gap, broken lines."""
    r, m = random.Random(4), []
    t = 1_700_000_000_000
    for i in range(160):
        t += 60_000 if i == 90 else r.choice([50, 150, 400, 900])
        for k in ("A/B", "C/D") if i % 40 == 0 else ("A/B",):
            side = lambda s: [[100 + s * (0.5 * n + r.random()), 1 + r.randint(0, 9)] for n in range(0 if r.random() < 0.2 else r.randint(1, 4))]
            m.append({"type": "orderbook", "exchange": "ax", "symbol": k, "collected_at": t, "data": {"timestamp": t, "bids": side(-1), "asks": side(1)}})
        if r.random() < 0.4:
            m.append({"type": "trades", "exchange": "ax", "symbol": "A/B", "collected_at": t, "data": [{"id": str(i), "timestamp": t, "side": r.choice(["buy", "sell"]) if i < 60 else "buy", "price": 100.5, "amount": r.randint(1, 5)}]})
        m.append({"type": "ticker", "exchange": "ax", "symbol": "A/B", "collected_at": t, "data": {"timestamp": t, "bid": 100, "ask": 101}})
    o = {"bar_durations": [2, 5, 20], "horizons": [2, 5], "max_levels": 3, "spread_regime_window": 5, "kyle_lambda_window": 6, "depth_window": 5, "slope_window": 4, "hf_emit_interval": 0.5}
    channels = {"ticker": ChannelConfig(enabled=False), "trades": ChannelConfig(partition_cols=["exchange"]), "orderbook": ChannelConfig(processor_options=o)}
    cfg = lambda n: Config(raw_dir=f"file://{tmp_path}/{n}", processed_dir=f"file://{tmp_path}/{n}/out", channels=channels, max_files_per_trigger=1)
    n, outs = len(m) // 4, {}
    for i in range(4):
        part = m[i * n : (i + 1) * n if i < 3 else None]
        for job_ in ("batch", "stream"):
            write_segment(tmp_path / job_ / "ready/s", f"segment_20231114T22_0000{i}.ndjson", part, ['{"broken'])
        q = job.watch(spark, "s", cfg("stream"), f"file://{tmp_path}/cp", once=True, delay_ms=0)
        q.awaitTermination(120)
        assert q.exception() is None
    assert job.drain(spark, "s", cfg("batch"))["rejected"] == 4
    stats = [json.loads(p.read_text()) for p in sorted((tmp_path / "stream/out/s/_stats").glob("batch=*.json"))]
    assert sum(s["messages"] for s in stats) == len(m) and sum(s["rejected"] for s in stats) == 4
    assert sum(s["late"] for s in stats) == 0
    assert not (tmp_path / "stream/out/s/ticker").exists()
    for name in ("trades", "orderbook_hf", "orderbook_bars"):
        for job_ in ("batch", "stream"):
            d = spark.read.parquet(f"file://{tmp_path}/{job_}/out/s/{name}").drop("batch")
            outs[job_] = sorted((str([(c, f"{0.0 + round(x, 6):.6f}" if isinstance(x, float) else x) for c, x in sorted(v.asDict().items()) if c not in ("seq",)]) for v in d.collect()))
        assert len(outs["batch"]) > 10 and outs["stream"] == outs["batch"], name


def stream_of(spark, tmp_path, df, parts, name):
    """The rows as a file stream of several micro-batches, in order of ``ts``."""
    at = str(tmp_path / name)
    rows = df.orderBy("ts").collect()
    step = -(-len(rows) // parts)
    for i in range(parts):
        part = rows[i * step : (i + 1) * step]
        if part:
            spark.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(at)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(at)


def drain_to(spark, tmp_path, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / ("cp_" + name))).trigger(availableNow=True).start()
    q.awaitTermination(180)
    return spark.table(name)


BOOKS = "exchange string, symbol string, ts long, seq long, bids array<array<double>>, asks array<array<double>>"


def test_stateful_features_equal_the_batch(spark, tmp_path):
    r = random.Random(3)
    rows = [("x", f"s{i % 2}", 1_000_000 + 1000 * i, i, [[100 - r.random(), float(r.randint(1, 5))] for _ in range(2)], [[101 + r.random(), float(r.randint(1, 5))] for _ in range(2)]) for i in range(80)]
    end = [("x", "zz", 10_000_000, 999, [], []), ("x", "zz", 20_000_000, 1000, [], [])]  # moves the watermark past all others
    d = spark.createDataFrame(rows + end, BOOKS)
    cfg = FeatureConfig(horizons=(5, 15), bar_durations=(20,), max_levels=2, hf_emit_interval=3.0)
    got = drain_to(spark, tmp_path, live.stateful_features(stream_of(spark, tmp_path, d, 4, "b"), cfg, "5 seconds"), "live_hf").filter("symbol <> 'zz'")
    batch = {x.seq: x for x in feat.hf_features(d, None, cfg).filter("symbol <> 'zz'").collect()}
    hf = {x.seq: x for x in got.filter("kind = 'hf'").collect()}
    assert set(hf) == set(batch)
    for s, x in hf.items():
        b = batch[s]
        assert (x.log_return_step, x.ofi_step, x.mlofi_step) == pytest.approx((b.log_return_step, b.ofi_step, b.mlofi_step))
        assert x.rv == pytest.approx([b.rv_5s, b.rv_15s], abs=1e-9) and x.ofi_sum == pytest.approx([b.ofi_sum_5s, b.ofi_sum_15s])
    bars = {(x.symbol, x.ts): (x.open, x.high, x.low, x.close, x["count"]) for x in got.filter("kind = 'bar'").collect()}
    want = {(x.symbol, x.bar_start): (x.open, x.high, x.low, x.close, x["count"]) for x in feat.feature_bars(d, cfg).filter("symbol <> 'zz'").collect()}
    assert bars == want


def test_stateful_book(spark, tmp_path):
    rows = [("x", "s", 1_000_000 + 1000 * i, i, "bid" if i % 2 else "ask", float(90 + i % 7 if i % 2 else 110 + i % 5), float(i % 3), i % 3 == 0) for i in range(40)] + [("x", "zz", 10**8 + k, k, "bid", 1.0, 1.0, False) for k in (0, 10**7)]
    d = spark.createDataFrame(rows, "exchange string, symbol string, ts long, sequence_num long, side string, price_level double, new_quantity double, removed boolean")
    got = {r.sequence_num: (r.best_bid, r.best_ask) for r in drain_to(spark, tmp_path, live.stateful_book(stream_of(spark, tmp_path, d, 3, "q"), "5 seconds"), "live_book").filter("symbol = 's'").collect()}
    sides, want = {"bid": {}, "ask": {}}, {}
    for _, s, _, q, side, p, v, gone in rows[:40]:
        sides[side].pop(p, None) if gone else sides[side].__setitem__(p, v)
        b, a = max(sides["bid"], default=None), min(sides["ask"], default=None)
        want[q] = (b, a) if b is not None and a is not None else (None, None)
    assert got == want


def test_windowed_bars_and_late_bars_as_streams(spark, tmp_path):
    rows = [("x", "s", 1000 * i, i, float(i % 5), 1.0) for i in range(60)] + [("x", "s", 10_000_000 + i, 100 + i, 1.0, 1.0) for i in range(2)]
    d = spark.createDataFrame(rows, "exchange string, symbol string, ts long, seq long, price double, amount double")
    got = drain_to(spark, tmp_path, live.windowed_bars(stream_of(spark, tmp_path, d, 3, "w"), 10, "5 seconds"), "live_bars")
    assert [r.volume for r in got.orderBy("window_start").collect()] == [10.0] * 6
    t = spark.createDataFrame([("x", "s", str(i % 50), 1000 * (i % 50), 1000 * i, 1.0, 1.0, i) for i in range(80)], "exchange string, symbol string, trade_id string, timestamp long, collected_at long, price double, amount double, rec_no long")
    b = latebars.EventTimeBars(spark, scratch(spark, "live"))
    q = live.start(stream_of(spark, tmp_path, t.withColumn("ts", F.col("collected_at")), 4, "t"), live.late_bars_sink(b), str(tmp_path / "cp_late"))
    q.awaitTermination(180)
    once = latebars.EventTimeBars(spark).run(t, 1)
    cols = ["exchange", "symbol", "duration", "bar_start", "trade_count", "n_late", "volume"]
    assert sorted(map(str, b.current().select(*cols).collect())) == sorted(map(str, once.current().select(*cols).collect()))


def test_landing_sink(spark, tmp_path):
    write_segment(tmp_path / "in", "segment_20231114T22_00001.ndjson", MSG.values())
    q = live.start(live.messages(live.read_segments(spark, str(tmp_path / "in"))), live.landing_sink(str(tmp_path / "land")), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "land/trades")).count() == 3


def test_envelopes(spark):
    d = spark.createDataFrame([(1, bytearray(b"\x0aB"))], "a int, b binary").select(parse.envelope(F.struct("a"), source=F.lit("s")).alias("e"), parse.raw_envelope(F.col("b")).alias("r")).first()
    assert json.loads(d.e)["data"] == {"a": 1} and json.loads(d.e)["metadata"] == {"source": "s"} and json.loads(d.r)["raw_bytes"] == "0a42"


def test_commands_and_schema_migration(spark, tmp_path):
    from tideframe.__main__ import parser, run

    cfg = Config(raw_dir=f"file://{tmp_path}/raw", processed_dir=f"file://{tmp_path}/out", delete_after_processing=False)
    (tmp_path / "c.json").write_text(json.dumps(cfg.to_dict()))
    write_segment(tmp_path / "raw/ready/s", "segment_20231114T22_00001.ndjson", books_and_trades(10))
    go = lambda *a: run(parser().parse_args(["--config", str(tmp_path / "c.json"), *a]))
    assert go("health", "s")["files"] == 1
    assert go("etl", "s", "--start", "2023-11-14")["messages"] == 30
    out = f"file://{tmp_path}/out/s"
    assert go("compact", f"{out}/trades", "--dry-run")["folders"] == 1
    assert go("validate", f"{out}/trades", "--columns", "exchange", "symbol", "date")["partition_columns"]
    assert go("sync", f"{out}/trades", f"file://{tmp_path}/copy")["copied"] == 1
    s = job.migrate_schema(spark, "s", cfg, ["trades"], f"file://{tmp_path}/old", cfg.layout("s")["processing"])
    assert s["messages"] == 30 and spark.read.parquet(out + "/trades").count() == 10 and spark.read.parquet(f"file://{tmp_path}/old/trades").count() == 10
    assert go("retry", "s")["segments"] == 1
