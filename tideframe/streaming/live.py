"""Structured Streaming: segments as they close, to datasets, features and bars.

A file stream takes files by modification time, not by name, so order-dependent state never trusts arrival: rows of a key wait in
its state until the watermark has passed them and are then worked off by (ts, seq). On input that is not later than the watermark's
delay the results equal those of the batch operators; later rows are dropped by the engine and counted there.
"""

from __future__ import annotations

import math
import pickle
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tideframe import schemas
from tideframe.config import FeatureConfig
from tideframe.functions import fs
from tideframe.functions.normal import once
from tideframe.operators import book, latebars, parse
from tideframe.session import ship
from tideframe.sources.sinks import write_dataset


def read_segments(spark: SparkSession, folder: str, max_files: int = 100, clean: str | None = None, archive: str | None = None) -> DataFrame:
    """Lines of closed segments as they appear; ``clean`` (archive or delete) disposes of finished files."""
    r = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).option("pathGlobFilter", "*.ndjson")
    if clean:
        r = r.option("cleanSource", clean)
        if clean == "archive":
            r = r.option("sourceArchiveDir", archive)
    return r.load(folder).select("value", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def messages(lines: DataFrame) -> DataFrame:
    """Envelopes of the unified interface; lines that do not parse are dropped."""
    m = lines.filter(F.trim("value") != "").select("*", once(F.from_json("value", parse.ENVELOPE)).alias("_m")).filter("_m.type is not null")
    return m.select("_m.*", *[c for c in lines.columns if c != "value"])


def start(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None, mode: str = "append"):
    """Run ``sink`` for each micro-batch; ``every`` (as "30 seconds") polls, without it what is there is drained."""
    w = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def channel_sink(root: str, partition_by: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Writes each channel of a micro-batch to its dataset, from one parse. A batch done again replaces its own folder."""

    def sink(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        for name, fn in (("ticker", parse.ticker), ("trades", parse.trades), ("orderbook", parse.orderbook)):
            at = f"{root}/{name}/batch={number}"
            fs.delete(batch.sparkSession, at)
            write_dataset(fn(batch), at, partition_by)
        batch.unpersist()

    return sink


def landing_sink(root: str) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch to the typed landing tables."""

    def sink(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        for name, d in parse.landing(batch).items():
            at = f"{root}/{name}/batch={number}"
            fs.delete(batch.sparkSession, at)
            write_dataset(d, at)
        batch.unpersist()

    return sink


def late_bars_sink(bars: latebars.EventTimeBars) -> Callable[[DataFrame, int], None]:
    return lambda batch, number: bars.process(batch, number)


def windowed_bars(trades: DataFrame, seconds: int, delay: str = "10 seconds") -> DataFrame:
    """OHLCV by key and window of event time, each emitted once when the watermark has passed it. trades: exchange, symbol, ts (ms), seq, price, amount."""
    t = trades.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", delay)
    p = F.struct("ts", "seq", "price")
    g = t.groupBy("exchange", "symbol", F.window("event_time", f"{seconds} seconds").alias("w")).agg(
        F.min(p).alias("_o"), F.max("price").alias("high"), F.min("price").alias("low"), F.max(p).alias("_c"), F.sum("amount").alias("volume"), F.count("price").alias("trades")
    )
    return g.select("exchange", "symbol", F.unix_millis("w.start").alias("window_start"), F.col("_o.price").alias("open"), "high", "low", F.col("_c.price").alias("close"), "volume", "trades")


class _Window:
    """Sum and sample variance of the values of the last ``h`` ms, kept row by row."""

    def __init__(self, h: int):
        self.h, self.rows, self.n, self.s, self.ss = h, deque(), 0, 0.0, 0.0

    def add(self, t: int, x: float) -> None:
        while self.rows and self.rows[0][0] <= t - self.h:
            _, y = self.rows.popleft()
            self.n, self.s, self.ss = self.n - 1, self.s - y, self.ss - y * y
        self.rows.append((t, x))
        self.n, self.s, self.ss = self.n + 1, self.s + x, self.ss + x * x

    @property
    def std(self) -> float:
        return math.sqrt(max(0.0, (self.ss - self.s * self.s / self.n) / (self.n - 1))) if self.n > 1 else 0.0


class _Key:
    """State of one key: waiting rows, the last book, windows, open bars, the last emission."""

    def __init__(self, cfg: FeatureConfig):
        self.waiting: list[tuple] = []
        self.last: tuple | None = None
        self.returns = {h: _Window(h * 1000) for h in cfg.horizons}
        self.flows = {h: _Window(h * 1000) for h in cfg.horizons}
        self.bars: dict[int, list] = {}
        self.emitted = 0

    def step(self, cfg: FeatureConfig, ts: int, seq: int, bids: list, asks: list) -> Iterator[tuple]:
        mid = (bids[0][0] + asks[0][0]) / 2 if bids and asks else None
        ret = ofi = ml = 0.0
        if self.last is not None and mid and mid > 0 and self.last[0] and self.last[0] > 0:
            ret = math.log(mid / self.last[0])
            up = _side(bids, self.last[1], 1), _side(asks, self.last[2], -1)
            n = cfg.ofi_levels
            ofi = up[0][0] - up[1][0]
            ml = sum(v * math.exp(-cfg.ofi_decay_alpha * i) for i, v in enumerate(up[0][:n])) - sum(v * math.exp(-cfg.ofi_decay_alpha * i) for i, v in enumerate(up[1][:n]))
        self.last = (mid, bids, asks)
        for h in cfg.horizons:
            self.returns[h].add(ts, ret)
            self.flows[h].add(ts, ofi)
        for d in cfg.bar_durations:
            start = ts - ts % (d * 1000)
            bar = self.bars.get(d)
            if bar is not None and start > bar[0]:
                yield ("bar", bar[0], 0, None, None, None, None, None, None, d, *bar[1:6])
                bar = None
            if bar is None:
                bar = self.bars[d] = [start, mid, mid, mid, mid, 0]
            if mid is not None:
                bar[1] = mid if bar[1] is None else bar[1]
                bar[2] = mid if bar[2] is None else max(bar[2], mid)
                bar[3] = mid if bar[3] is None else min(bar[3], mid)
                bar[4] = mid
            bar[5] += 1
        if ts - self.emitted >= cfg.hf_emit_interval * 1000:
            self.emitted = ts
            yield ("hf", ts, seq, mid, ret, ofi, ml, [self.returns[h].std for h in cfg.horizons], [self.flows[h].s for h in cfg.horizons], None, None, None, None, None, None)


def _side(now: list, before: list, sign: int) -> list[float]:
    """Flow of each level both books have; sign 1 for bids, -1 for asks."""
    out = []
    for (p, s), (q, r) in zip(now, before):
        better = (p - q) * sign
        out.append(s if better > 0 else -r if better < 0 else s - r)
    return out or [0.0]


LIVE = schemas.of(
    exchange="string", symbol="string", kind="string", ts="long", seq="long", mid="double", log_return_step="double", ofi_step="double", mlofi_step="double", rv=T.ArrayType(T.DoubleType()), ofi_sum=T.ArrayType(T.DoubleType()),
    duration="int", open="double", high="double", low="double", close="double", count="int",
)
_NAMES = LIVE.names[2:]


def stateful_features(books: DataFrame, cfg: FeatureConfig = FeatureConfig(), delay: str = "10 seconds") -> DataFrame:
    """Feature rows (kind hf) and closed bars (kind bar) of a stream of books: exchange, symbol, ts (ms), seq, bids, asks.

    ``rv`` and ``ofi_sum`` hold a value for each horizon. The state of a key is durable: a restarted query goes on where it
    stopped.
    """
    ship(books.sparkSession)
    b = book.normalise(books.filter("ts is not null and exchange is not null and symbol is not null")).select("exchange", "symbol", "ts", "seq", "bids", "asks")
    b = b.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", delay)

    def work(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        k = pickle.loads(state.get[0]) if state.exists else _Key(cfg)
        for f in frames:
            for r in f.itertuples(index=False):
                k.waiting.append((int(r.ts), int(r.seq), [(x["price"], x["size"]) for x in r.bids], [(x["price"], x["size"]) for x in r.asks]))
        mark = state.getCurrentWatermarkMs()
        k.waiting.sort(key=lambda x: x[:2])
        out, n = [], 0
        while n < len(k.waiting) and k.waiting[n][0] <= mark:
            out += k.step(cfg, *k.waiting[n])
            n += 1
        del k.waiting[:n]
        state.update((pickle.dumps(k),))
        if k.waiting:
            state.setTimeoutTimestamp(max(mark + 1, k.waiting[0][0] + 1))
        if out:
            yield pd.DataFrame([(*key, *row) for row in out], columns=["exchange", "symbol", *_NAMES]).astype({"duration": "Int32", "count": "Int32"})

    return b.groupBy("exchange", "symbol").applyInPandasWithState(work, LIVE, schemas.of(blob="binary"), "append", GroupStateTimeout.EventTimeTimeout)


QUOTES = schemas.of(exchange="string", symbol="string", sequence_num="long", best_bid="double", best_ask="double")


def stateful_book(changes: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """Best quotes after each message of a level-2 stream, once the watermark has passed it.

    changes: exchange, symbol, ts (ms), sequence_num, side (bid or ask), price_level, new_quantity, removed.
    """
    ship(changes.sparkSession)
    c = changes.filter("ts is not null and sequence_num is not null and side is not null and price_level is not null")
    c = c.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", delay)

    def work(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, sides, done = pickle.loads(state.get[0]) if state.exists else ([], {"bid": {}, "ask": {}}, -1)
        for f in frames:
            waiting += [(int(r.sequence_num), int(r.ts), bool(r.removed), r.side, float(r.price_level), float(r.new_quantity) if r.new_quantity == r.new_quantity and r.new_quantity is not None else 0.0) for r in f.itertuples(index=False)]
        mark = state.getCurrentWatermarkMs()
        waiting.sort()
        # A row whose time lies far ahead waits alone: it holds up no other, and counts as overtaken if others of greater sequence went first.
        known, waiting = [w for w in waiting if w[1] <= mark], [w for w in waiting if w[1] > mark]
        n, out = len(known), []
        for i, (seq, _, gone, side, price, qty) in enumerate(known):
            if seq >= done:  # an overtaken message no longer changes what came after it
                if gone:
                    sides[side].pop(price, None)
                else:
                    sides[side][price] = qty
                done = seq
                if i + 1 == n or known[i + 1][0] != seq:
                    bid, ask = max(sides["bid"], default=None), min(sides["ask"], default=None)
                    both = bid is not None and ask is not None
                    out.append((*key, seq, bid if both else None, ask if both else None))
        state.update((pickle.dumps((waiting, sides, done)),))
        if waiting:
            state.setTimeoutTimestamp(max(mark + 1, min(w[1] for w in waiting) + 1))
        if out:
            yield pd.DataFrame(out, columns=QUOTES.names).astype({"best_bid": "float64", "best_ask": "float64"})

    return c.groupBy("exchange", "symbol").applyInPandasWithState(work, QUOTES, schemas.of(blob="binary"), "append", GroupStateTimeout.EventTimeTimeout)
