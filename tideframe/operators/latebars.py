"""Problem 3: bars by event time, corrected for trades that arrive late, up to a cut-off.

``EventTimeBars.process`` is one micro-batch of a keyed state machine, called by a stream's
``foreachBatch`` or by ``run`` over a table split by arrival. Its state lies under ``root`` and is found there again by another
process: a manifest (batches taken in, watermark), the bars that can still change (one snapshot), those that are closed
(in slots of a day) and the identifiers seen (in slots of an hour). A micro-batch reads the snapshot and the identifiers of
its own hours, so that its cost does not depend on how many came before. The manifest is written last: a micro-batch that
breaks off leaves no trace in the state.

Each micro-batch upserts the bars it touched; trades beyond the cut-off go to ``dropped``. The watermark is the
greatest arrival seen; a bar leaves the snapshot when it has passed the bar's cut-off. Identifiers are kept
for ever, or for ``forget_after_ms`` of event time, so that a delivery repeated a day later is neither counted nor dropped.

Defined results: rows without a timestamp lie in no bar; a row without a trade_id is a trade of its own;
a trade one of whose deliveries has no arrival counts as on time; rows without a price do not enter prices or counts, but
may be late; of equal times the least (trade_id, record) opens and the greatest closes. A batch number that was taken in is
not taken in again. Batches must come in order of arrival (rows without arrival first); the result then does not depend on how
many there are, nor on restarts.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe import schemas
from tideframe.functions import fs, normal
from tideframe.session import scratch

#: Seconds, as published by the venue feeds.
DURATIONS = (60, 300, 900, 3600)

_BAR = ["exchange", "symbol", "duration", "bar_start"]
_POINT = schemas.of(t="long", id="string", p="double")
_KEY = {"exchange": "string", "symbol": "string", "duration": "int", "bar_start": "long"}
_SUMS = ("n_on_time", "n_late", "n_priced", "volume", "batches")
BAR_SCHEMA = schemas.of(**_KEY, n_on_time="long", n_late="long", n_priced="long", volume="double", batches="long", high="double", low="double", first=_POINT, last=_POINT, last_arrival="long")
SEEN_SCHEMA = schemas.of(exchange="string", trade_id="string", timestamp="long")
DROPPED_SCHEMA = schemas.of(**_KEY, trade_id="string", timestamp="long", arrival="long", late_by_ms="long")
MANIFEST = "_state.json"
#: Width in ms and number of the slots of time that identifiers and closed bars lie in. Slots are used again in turn, so that neither
#: the manifest nor the folders of a micro-batch grow with the age of the stream, nor with senseless times.
SLOTS = {"seen": (3_600_000, 4096), "bars": (86_400_000, 1024)}
#: The slot of the bars that can still change.
OPEN = -1
#: Pieces of a slot from which they are merged into one.
PIECES = 8


def _merge(df: DataFrame) -> DataFrame:
    """Partial aggregates of the same bar added up."""
    return df.groupBy(*_BAR).agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.max("high").alias("high"), F.min("low").alias("low"), F.min("first").alias("first"), F.max("last").alias("last"), F.max("last_arrival").alias("last_arrival"), F.max("touched").alias("touched"),
    )


def _shown(bars: DataFrame) -> DataFrame:
    return bars.select(
        *_BAR, F.col("first.p").alias("open"), "high", "low", F.col("last.p").alias("close"), "volume", F.col("n_priced").alias("trade_count"), "n_on_time", "n_late", (F.col("batches") - 1).alias("corrections"),
    )


def _slot(what: str, time: Column) -> Column:
    width, n = SLOTS[what]
    return F.pmod(F.floor(time / F.lit(width)), F.lit(n)).cast("int")


class EventTimeBars:
    def __init__(self, spark: SparkSession, root: str | None = None, durations: tuple[int, ...] = DURATIONS, publish_delay_ms: int = 5_000, lateness_ms: int = 900_000, forget_after_ms: int | None = None, upsert: Callable[[DataFrame, int], None] | None = None):
        """``upsert`` is given the bars a micro-batch touched, with its number, before the batch counts as taken in: a sink that keys by bar sees each at least once."""
        self.upsert = upsert
        self.spark, self.root = spark, (root or scratch(spark, "bars")).rstrip("/")
        self.durations, self.publish_delay_ms, self.lateness_ms, self.forget_after_ms = tuple(durations), publish_delay_ms, lateness_ms, forget_after_ms
        rules = [list(durations), publish_delay_ms, lateness_ms]
        self.state = {"rules": rules, "taken": [], "watermark": None, "seen": {}, "bars": {}}
        if fs.has_text(spark, f"{self.root}/{MANIFEST}"):
            self.state = json.loads(fs.read_text(spark, f"{self.root}/{MANIFEST}"))
            if self.state["rules"] != rules:
                raise ValueError(f"{self.root} holds bars of other durations or limits: {self.state['rules']}")

    @property
    def watermark(self) -> int | None:
        return self.state["watermark"]

    def taken(self, batch: int) -> bool:
        return any(a <= batch <= b for a, b in self.state["taken"])

    def _pieces(self, what: str, schema: T.StructType, slots: list[str]) -> DataFrame:
        paths = [f"{self.root}/{what}/batch={b}/slot={s}" for s in slots for b in self.state[what].get(s, [])]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _add(self, df: DataFrame, what: str, slot: Column, time: str, batch: int, state: dict, replaced: tuple[str, ...] = ()) -> list[str]:
        """A piece of each slot ``df`` has rows of; slots of many pieces are merged on the way. Gives the folders no longer in use.

        Of the slots in ``replaced`` the rows given are all that stays.
        """
        full = [s for s, b in self.state[what].items() if len(b) >= PIECES and s not in replaced]
        if full:
            df = df.unionByName(self._pieces(what, df.schema, full))
        at = f"{self.root}/{what}/batch={batch}"
        d = df.withColumn("slot", slot).hint("rebalance", F.col("slot"))
        d.sortWithinPartitions("slot", time).write.mode("overwrite").option("compression", "zstd").partitionBy("slot").parquet(at)
        anew = {*full, *replaced}
        dead = [f"{self.root}/{what}/batch={b}/slot={s}" for s in anew for b in state[what].pop(s, [])]
        for name in fs.subdirs(self.spark, at):
            s = name.split("=", 1)[1]
            state[what][s] = [*state[what].get(s, []), batch]
        return dead

    def process(self, rows: DataFrame, batch: int) -> None:
        """Take in one micro-batch; one whose number was taken in already is passed over.

        rows: exchange, symbol, trade_id, timestamp, collected_at, price, amount, rec_no (any others are ignored).
        """
        if self.taken(batch):
            return
        state = json.loads(json.dumps(self.state))
        r = rows.filter("timestamp is not null").select(
            normal.exchange("exchange").alias("exchange"), normal.instrument("symbol").alias("symbol"), "trade_id", "timestamp",
            F.when(F.col("trade_id").isNull(), F.col("rec_no")).alias("own"), "collected_at", "price", "amount", "rec_no",
        )
        # Deliveries of one trade are combined before the shuffle, whatever their number.
        trades = (
            r.groupBy("exchange", "trade_id", "timestamp", "own")
            .agg(F.min(F.struct("collected_at", "rec_no", "symbol", "price", "amount")).alias("d"))
            .select("exchange", "trade_id", "timestamp", "own", F.col("d.collected_at").alias("arrival"), "d.symbol", "d.price", "d.amount", F.coalesce("trade_id", F.col("own").cast("string")).alias("id"))
        )
        at = f"{self.root}/new"
        trades.write.mode("overwrite").parquet(at)
        trades = self.spark.read.schema(trades.schema).parquet(at)
        known = F.when(F.col("trade_id").isNotNull(), _slot("seen", F.col("timestamp")))
        top, hours, lo, hi = trades.agg(F.max("arrival"), F.collect_set(known), F.min("timestamp"), F.max("timestamp")).first()
        hours = [str(h) for h in hours if str(h) in self.state["seen"]]
        if hours:
            seen = self._pieces("seen", SEEN_SCHEMA, hours).filter(F.col("timestamp").between(lo, hi))
            trades = trades.join(seen, ["exchange", "trade_id", "timestamp"], "left_anti")
            trades.write.mode("overwrite").parquet(at + "_only")
            trades = self.spark.read.schema(trades.schema).parquet(at + "_only")
        dead = self._add(trades.filter("trade_id is not null").select(*SEEN_SCHEMA.names), "seen", _slot("seen", F.col("timestamp")), "timestamp", batch, state)

        d = F.explode(F.array(*[F.lit(x) for x in self.durations]))
        placed = trades.withColumn("duration", d).withColumn("bar_start", F.expr("timestamp - pmod(timestamp, duration * 1000L)"))
        late_by = F.coalesce(F.col("arrival") - F.col("bar_start") - F.col("duration") * 1000, F.lit(0))
        placed = placed.withColumn("late_by_ms", late_by)
        placed.filter(F.col("late_by_ms") > self.lateness_ms).select(*DROPPED_SCHEMA.names).write.mode("overwrite").parquet(f"{self.root}/dropped/batch={batch}")

        on_time, priced = F.col("late_by_ms") <= self.publish_delay_ms, F.col("price").isNotNull()
        point = F.when(priced, F.struct(F.col("timestamp").alias("t"), "id", F.col("price").alias("p")))
        fresh = placed.filter(F.col("late_by_ms") <= self.lateness_ms).groupBy(*_BAR).agg(
            F.count(F.when(on_time, 1)).alias("n_on_time"), F.count(F.when(~on_time, 1)).alias("n_late"), F.count("price").alias("n_priced"),
            F.sum(F.when(priced, F.coalesce("amount", F.lit(0.0)))).alias("volume"), F.lit(1).cast("long").alias("batches"), F.max("price").alias("high"), F.min("price").alias("low"),
            F.min(point).alias("first"), F.max(point).alias("last"), F.max("arrival").alias("last_arrival"),
        )
        fresh = fresh.withColumn("touched", F.lit(True)).unionByName(self._open().withColumn("touched", F.lit(False)))
        fresh = _merge(fresh).select(*BAR_SCHEMA.names, "touched")
        marks = [x for x in (self.watermark, top) if x is not None]
        state["watermark"] = max(marks) if marks else None
        closes = F.col("bar_start") + F.col("duration") * 1000 + self.lateness_ms < F.lit(state["watermark"]).cast("long")
        dead += self._add(fresh, "bars", F.when(closes, _slot("bars", F.col("bar_start"))).otherwise(F.lit(OPEN)), "bar_start", batch, state, (str(OPEN),))
        if self.upsert is not None:
            mine = [f"{self.root}/bars/batch={batch}/slot={s}" for s, b in state["bars"].items() if batch in b]
            self.upsert((self.spark.read.schema(fresh.schema).parquet(*mine) if mine else self.spark.createDataFrame([], fresh.schema)).filter("touched").transform(_shown), batch)
        if self.forget_after_ms is not None and state["watermark"] is not None:
            dead += self._forget(state)
        state["taken"] = _with(self.state["taken"], batch)
        fs.write_text(self.spark, f"{self.root}/{MANIFEST}", json.dumps(state))
        self.state = state
        for p in [*dead, at, at + "_only"]:
            fs.delete(self.spark, p)

    def _forget(self, state: dict) -> list[str]:
        """Slots of identifiers that lie wholly before the time up to which they are kept."""
        width, n = SLOTS["seen"]
        oldest, newest = (state["watermark"] - self.forget_after_ms) // width, state["watermark"] // width
        if newest - oldest + 2 >= n:
            return []
        keep = {str(x % n) for x in range(oldest, newest + 2)}
        gone = [s for s in state["seen"] if s not in keep]
        return [f"{self.root}/seen/batch={b}/slot={s}" for s in gone for b in state["seen"].pop(s)]

    def _open(self) -> DataFrame:
        return self._pieces("bars", BAR_SCHEMA, [str(OPEN)])

    def current(self) -> DataFrame:
        """Each bar as last upserted; ``corrections`` counts the batches that changed it after its first."""
        return _shown(_merge(self._pieces("bars", BAR_SCHEMA, list(self.state["bars"])).withColumn("touched", F.lit(True))))

    def dropped(self) -> DataFrame:
        """Trades beyond the cut-off of a bar, by bar."""
        if not self.state["taken"]:
            return self.spark.createDataFrame([], DROPPED_SCHEMA)
        full = T.StructType([*DROPPED_SCHEMA.fields, T.StructField("batch", T.LongType())])
        mine = F.lit(False)
        for a, b in self.state["taken"]:
            mine = mine | F.col("batch").between(a, b)
        return self.spark.read.schema(full).parquet(f"{self.root}/dropped").filter(mine).drop("batch")

    def run(self, rows: DataFrame, slices: int = 3) -> "EventTimeBars":
        """Replay a table in arrival order as ``slices`` micro-batches of about equal size."""
        cuts = rows.agg(F.percentile_approx("collected_at", [i / slices for i in range(1, slices)], 1000)).first()[0] if slices > 1 else []
        edges = [None, *sorted(set(cuts or [])), None]
        for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
            part = rows
            if lo is not None:
                part = part.filter(F.col("collected_at") > lo)
            if hi is not None:
                part = part.filter((F.col("collected_at") <= hi) | (F.col("collected_at").isNull() if lo is None else F.lit(False)))
            elif lo is None:
                part = rows
            self.process(part, i)
        return self


def _with(ranges: list, n: int) -> list:
    """Ranges of numbers with one more number."""
    out: list = []
    for a, b in sorted([*ranges, [n, n]]):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out
