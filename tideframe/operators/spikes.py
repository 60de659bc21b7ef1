"""Problem 4: readings that cannot be or do not fit their own source.

Quantile sketches of the sizes of changes are built for each source, field and hour on the map side and merged
to one for each source; they bracket the median, which is then counted out exactly within the
bracket. An ordered scan compares each reading with its neighbours (implausible change, against ten times
that median) and finds runs without any variation. ``fences`` gives the interquartile fences for each source, field and hour.

A fence by the hour alone cannot decide what is a spike here, since a spike is defined against the five
readings on either side; it is a report of its own, and the flags come from the neighbours.

Defined results: null and NaN readings are no readings and are left out of the series; a record without
timestamp is only judged as impossible; records of equal time are ordered by their least record
number; a source without any non-zero change has no spikes; an empty table gives no flags.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe import schemas
from tideframe.functions import normal
from tideframe.operators.ordered import OrderedTable
from tideframe.session import materialise, small

NEIGHBOURS = 5
SPIKE_FACTOR = 10.0
STUCK_RUN = 12
#: Different values sorted in one task for one source; a bracket that holds more is narrowed by another sketch.
BRACKET_ROWS = 200_000
#: Quantiles read from a sketch to narrow a bracket.
GRID = 64
SKETCH_K = 1024

_SRC = ["tbl", "exchange", "symbol"]
_SCAN = schemas.of(tbl="string", exchange="string", symbol="string", ts="long", id="long", trade_id="string", field="int", value="double", delta="double", dev="double", stuck="boolean")


def readings(ticker: DataFrame, trades: DataFrame) -> DataFrame:
    """One row for each ticker record and each trade: tbl, exchange, symbol, ts, id, trade_id, a (bid or price), b (ask)."""
    num = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    t = ticker.select("rec_no", F.struct(normal.exchange("exchange").alias("exchange"), normal.instrument("symbol").alias("symbol"), F.col("timestamp").alias("ts"), num("bid").alias("a"), num("ask").alias("b")).alias("r"))
    t = t.groupBy("rec_no").agg(F.min("r").alias("r")).select(F.lit("ticker").alias("tbl"), "r.exchange", "r.symbol", "r.ts", F.col("rec_no").alias("id"), F.lit(None).cast("string").alias("trade_id"), "r.a", "r.b")
    own = F.when(F.col("trade_id").isNull() | F.col("timestamp").isNull(), F.col("rec_no"))
    x = trades.select(normal.exchange("exchange").alias("exchange"), "trade_id", F.col("timestamp").alias("ts"), own.alias("own"), F.struct("collected_at", "rec_no", normal.instrument("symbol").alias("symbol"), num("price").alias("a")).alias("r"), "rec_no")
    x = x.groupBy("exchange", "trade_id", "ts", "own").agg(F.min("r").alias("r"), F.min("rec_no").alias("id"))
    x = x.select(F.lit("trades").alias("tbl"), "exchange", "r.symbol", "ts", "id", "trade_id", "r.a", F.lit(None).cast("double").alias("b"))
    return t.unionByName(x)


def impossible() -> Column:
    """Zero or less, or a bid above the ask; nulls are no case."""
    return F.coalesce(F.col("a") <= 0, F.lit(False)) | F.coalesce(F.col("b") <= 0, F.lit(False)) | F.coalesce(F.col("a") > F.col("b"), F.lit(False))


def _columns(t: pa.Table):
    """Code of the source by row, and the columns as arrays with NaN for null."""
    import numpy as np
    import pyarrow.compute as pc

    n = t.num_rows
    new = np.zeros(n, bool)
    for c in _SRC:
        x = t[c].combine_chunks().fill_null("")
        if n > 1:
            new[1:] |= pc.not_equal(x.slice(1), x.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    num = lambda c: pc.fill_null(t[c].cast(pa.float64()), float("nan")).to_numpy()
    return np.cumsum(new), num("a"), num("b")


def _source(t: pa.Table, i: int) -> list:
    return [t[c][i].as_py() for c in _SRC]


def _edge(t: pa.Table) -> dict:
    """What a partition tells its neighbours of its first and last source."""
    import numpy as np

    src, a, b = _columns(t)
    out = {"first": _source(t, 0), "last": _source(t, t.num_rows - 1), "whole": bool(src[-1] == src[0])}
    for side, code in (("head", src[0]), ("tail", src[-1])):
        own = src == code
        for name, v in (("a", a), ("b", b)):
            x = v[own & ~np.isnan(v)]
            out[side + name] = (x[:NEIGHBOURS] if side == "head" else x[-NEIGHBOURS:]).tolist()
        both = own & ~np.isnan(a) & ~np.isnan(b)
        pa_, pb_ = a[both], b[both]
        if len(pa_):
            at = 0 if side == "head" else -1
            same = (pa_ == pa_[at]) & (pb_ == pb_[at])
            other = np.flatnonzero(~same)
            run = len(same) if not len(other) else (other[0] if side == "head" else len(same) - 1 - other[-1])
            out[side + "run"] = [float(pa_[at]), float(pb_[at]), int(run), not len(other)]
    return out


def _contexts(edges: dict[int, dict]) -> dict[int, dict]:
    """What lies just before and after each partition, gathered from as many of its neighbours as it takes."""
    order = sorted(edges)
    out = {}
    for k, p in enumerate(order):
        me, ctx = edges[p], {}
        for where, key, their, end, step in (("before", "first", "last", "tail", -1), ("after", "last", "first", "head", 1)):
            got: dict = {"a": [], "b": []}
            run, running = 0, "headrun" if where == "before" else "tailrun"
            mine = me.get(running)
            open_run = mine is not None
            j = k + step
            while 0 <= j < len(order):
                e = edges[order[j]]
                if e[their] != me[key]:
                    break
                for f in "ab":
                    got[f] = (e[end + f] + got[f])[-NEIGHBOURS:] if where == "before" else (got[f] + e[end + f])[:NEIGHBOURS]
                r = e.get(end + "run")
                if open_run and r:
                    if r[:2] == mine[:2]:
                        run += r[2]
                        open_run = r[3]
                    else:
                        open_run = False
                if not e["whole"] or (not open_run and all(len(got[f]) >= NEIGHBOURS for f in "ab")):
                    break
                j += step
            ctx[where] = got | {"run": run}
        out[p] = ctx
    return out


def _judge(t: pa.Table, ctx: dict) -> pa.Table:
    """delta and dev of each reading, and whether it lies in a stuck run, other than as its first."""
    import numpy as np

    src, a, b = _columns(t)
    parts = []
    for field, name, v in ((1, "a", a), (2, "b", b)):
        at = np.flatnonzero(~np.isnan(v))
        before, after = ctx["before"][name], ctx["after"][name]
        if not len(at):
            continue
        x = np.concatenate([before, v[at], after])
        s = np.concatenate([np.full(len(before), src[0]), src[at], np.full(len(after), src[-1])])
        n, lo, hi = len(x), len(before), len(before) + len(at)

        def beside(step: int) -> tuple:
            m = np.full((hi - lo, NEIGHBOURS), np.nan)
            for k in range(1, NEIGHBOURS + 1):
                i = np.arange(lo, hi) + step * k
                ok = (i >= 0) & (i < n)
                j = np.clip(i, 0, n - 1)
                m[:, k - 1] = np.where(ok & (s[j] == s[lo:hi]), x[j], np.nan)
            prev = m[:, 0].copy()
            m.sort(axis=1)
            c = NEIGHBOURS - np.isnan(m).sum(axis=1)
            r = np.arange(len(m))
            med = (m[r, np.maximum(c - 1, 0) // 2] + m[r, np.minimum(c // 2, NEIGHBOURS - 1)]) / 2
            return np.where(c > 0, med, np.nan), prev

        (mb, prev), (ma, _) = beside(-1), beside(1)
        own = x[lo:hi]
        d1, d2 = own - mb, own - ma
        with np.errstate(invalid="ignore"):
            dev = np.where(d1 * d2 > 0, np.minimum(np.abs(d1), np.abs(d2)), 0.0)
            delta = np.abs(own - prev)
        parts.append((at, np.full(len(at), field, "i4"), own, np.nan_to_num(delta), np.nan_to_num(dev), np.zeros(len(at), bool)))
    both = np.flatnonzero(~np.isnan(a) & ~np.isnan(b))
    if len(both):
        new = np.ones(len(both), bool)
        new[1:] = (src[both][1:] != src[both][:-1]) | (a[both][1:] != a[both][:-1]) | (b[both][1:] != b[both][:-1])
        run = np.cumsum(new) - 1
        length = np.bincount(run)
        place = np.arange(len(both)) - np.flatnonzero(new)[run]
        if src[both[0]] == src[0]:
            length[0] += ctx["before"]["run"]
            place[run == 0] += ctx["before"]["run"]
        if src[both[-1]] == src[-1]:
            length[-1] += ctx["after"]["run"]
        hit = both[(length[run] >= STUCK_RUN) & (place > 0)]
        parts.append((hit, np.zeros(len(hit), "i4"), np.full(len(hit), np.nan), np.zeros(len(hit)), np.zeros(len(hit)), np.ones(len(hit), bool)))
    if not parts:
        at, cols = np.empty(0, "i8"), [np.empty(0, k) for k in ("i4", "f8", "f8", "f8", "?")]
    else:
        at, *cols = [np.concatenate(c) for c in zip(*parts)]
    base = t.select([*_SRC, "ts", "id", "trade_id"]).take(pa.array(at, pa.int64()))
    for n, c in zip(("field", "value", "delta", "dev", "stuck"), cols):
        base = base.append_column(n, pa.array(c))
    return base.cast(pa.schema([(n, base.schema.field(n).type if n not in ("tbl", "exchange", "symbol", "trade_id") else pa.string()) for n in base.schema.names]))


def judged(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """The ordered scan over all readings with a time, as a table in the shared folder."""
    timed = rows.filter("ts is not null")
    t = OrderedTable(timed, [*_SRC, "ts", "id"], partitions, timed.count())
    return materialise(t.scan(_judge, _SCAN, _contexts(t.edges(_edge))), "judged")


def exact_medians(values: DataFrame, by: list[str], value: str, hour: str, bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """The exact median of ``value`` for each group, found by sketches that are merged across partitions and hours.

    A sketch only says where to look: the rows below its bracket are counted, and those within are counted
    out by value. Should the median not lie in the bracket, or the bracket hold too many rows, that is
    seen from the counts and the bracket is moved or narrowed, so the result never depends on the sketch.
    """
    hours = values.groupBy(*by, hour).agg(F.kll_sketch_agg_double(value, F.lit(SKETCH_K)).alias("s"))
    q = lambda p: F.kll_sketch_get_quantile_double(F.col("s"), F.lit(p))
    br = hours.groupBy(*by).agg(F.kll_merge_agg_double("s").alias("s")).select(*by, q(0.49).alias("lo"), q(0.51).alias("hi"))
    while True:
        br = materialise(br, "bracket")
        held = values.select(*by, value).join(small(br, br.count()), by)
        v, lo, hi = F.col(value), F.col("lo"), F.col("hi")
        counts = materialise(
            held.groupBy(*by).agg(F.count("*").alias("n"), F.sum((v < lo).cast("long")).alias("below"), F.sum(((v >= lo) & (v <= hi)).cast("long")).alias("inside"), F.approx_count_distinct(F.when((v >= lo) & (v <= hi), v)).alias("many"), F.first("lo").alias("lo"), F.first("hi").alias("hi")),
            "bracket-counts",
        )
        low, high = F.expr("(n + 1) div 2"), F.expr("n div 2 + 1")
        miss_low, miss_high = low <= F.col("below"), high > F.col("below") + F.col("inside")
        wide = (F.col("many") > bracket_rows) & (F.col("lo") < F.col("hi")) & ~miss_low & ~miss_high
        worst = counts.agg(F.max((miss_low | miss_high).cast("int")), F.max(wide.cast("int"))).first()
        if not worst[0] and not worst[1]:
            break
        inner = held.join(counts.filter(wide).select(*by, "below", "inside", "n"), by).filter((v >= lo) & (v <= hi))
        at = (low - F.col("below")) / F.col("inside")
        grid = F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(value, F.lit(SKETCH_K)), F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
        tight = inner.groupBy(*by).agg(grid.alias("g"), F.first("below").alias("below"), F.first("inside").alias("inside"), F.first("n").alias("n"))
        slot = lambda e: F.get("g", F.least(F.greatest(e, F.lit(0)), F.lit(GRID)).cast("int"))
        tight = tight.select(*by, slot(F.floor(at * GRID) - 1).alias("lo2"), slot(F.floor(at * GRID) + 2).alias("hi2"))
        inf = F.lit(math.inf)
        br = counts.join(tight, by, "left").select(*by, F.when(miss_low, -inf).otherwise(F.coalesce("lo2", "lo")).alias("lo"), F.when(miss_high, inf).otherwise(F.coalesce("hi2", "hi")).alias("hi"))
    from pyspark.sql import Window as W

    inside = held.filter((F.col(value) >= F.col("lo")) & (F.col(value) <= F.col("hi"))).groupBy(*by, value).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(W.partitionBy(*by).orderBy(value).rowsBetween(W.unboundedPreceding, 0))
    ranked = inside.withColumn("upto", upto).join(small(counts, counts.count()).select(*by, "n", "below"), by)
    take = lambda r: F.min(F.when(F.col("upto") + F.col("below") >= r, F.col(value)))
    return ranked.groupBy(*by).agg(((take(low) + take(high)) / 2).alias("median"))


def fences(rows: DataFrame, expand: float = 3.0) -> DataFrame:
    """Interquartile fences for each source, field and hour, from sketches merged across partitions."""
    q = lambda p: F.kll_sketch_get_quantile_double(F.col("s"), F.lit(p))
    v = rows.filter("ts is not null").select(*_SRC, F.expr("ts div 3600000").alias("hour"), F.expr("stack(2, 1, a, 2, b) as (field, value)")).filter("value is not null")
    s = v.groupBy(*_SRC, "field", "hour").agg(F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("s"), F.count("*").alias("n")).select(*_SRC, "field", "hour", "n", q(0.25).alias("q1"), q(0.75).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return s.select(*_SRC, "field", "hour", "n", "q1", "q3", (F.col("q1") - expand * iqr).alias("low"), (F.col("q3") + expand * iqr).alias("high"))


def flags(ticker: DataFrame, trades: DataFrame, partitions: int | None = None) -> DataFrame:
    """source_table, rec_no and reason (impossible, spike, stuck); every delivery of a flagged trade."""
    rows = materialise(readings(ticker, trades), "readings")
    j = judged(rows, partitions)
    by = [*_SRC, "field"]
    m = materialise(exact_medians(j.filter("delta > 0").withColumn("hour", F.expr("ts div 3600000")), by, "delta", "hour"), "medians")
    spike = j.filter("dev > 0").join(small(m, m.count()), by).filter(F.col("dev") > SPIKE_FACTOR * F.col("median"))
    cols = ["tbl", "exchange", "trade_id", "ts", "id"]
    bad = (
        spike.select(*cols, F.lit("spike").alias("reason"))
        .unionByName(j.filter("stuck").select(*cols, F.lit("stuck").alias("reason")))
        .unionByName(rows.filter(impossible()).select(*cols, F.lit("impossible").alias("reason")))
    )
    bad = materialise(bad.distinct(), "bad")
    again = trades.select(normal.exchange("exchange").alias("exchange"), "trade_id", F.col("timestamp").alias("ts"), "rec_no")
    copies = bad.filter("tbl = 'trades' and trade_id is not null and ts is not null")
    deliveries = again.join(small(copies, copies.count()).select("exchange", "trade_id", "ts", "reason"), ["exchange", "trade_id", "ts"])
    return bad.select(F.col("tbl").alias("source_table"), F.col("id").alias("rec_no"), "reason").unionByName(deliveries.select(F.lit("trades").alias("source_table"), "rec_no", "reason")).distinct()
