"""As-of and interval joins without pair explosion.

``asof_last`` brings to each left row the values of the latest right row of its key at or before it, by a union and a
running last value; hot keys are split in time with the last right row carried over. ``book_states`` rebuilds the best quotes
after every change of a level-2 feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideframe.functions import normal
from tideframe.session import materialise

#: Stretches of time over which last values are found before they are carried on, in units of the time column.
STRETCH = 3_600_000


def asof_last(left: DataFrame, right: DataFrame, by: list[str], ts: str, values: list[str], seq: str | None = None, strict: bool = False, tolerance: int | None = None, prefix: str = "asof_", hot: list | None = None) -> DataFrame:
    """Adds ``prefix + value`` for each value and ``prefix + ts``: those of the right row as of the left row's time.

    At equal times a right row counts (unless ``strict``), or, with ``seq`` on both sides, if its seq is not greater. Null if there
    is none, or it is more than ``tolerance`` back. Rows with a null key or time match nothing. No task holds a
    key's whole history: last values are found within stretches of time and carried across them, unless it is known (``hot``
    is empty) that no key of either side is hot: then one running value does, and both sides are read once.
    """
    cols = left.columns
    rank = F.lit(1 if strict else 0)
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType)
    s = F.col(seq) if seq else F.lit(0)
    l = left.select(*[F.col(c) for c in cols], F.lit(None).cast(_struct(right, ts, values)).alias("_v"), s.alias("_s"), F.lit(1 - (1 if strict else 0)).alias("_k"), F.lit(True).alias("_left"))
    v = F.struct(F.col(ts), *[F.col(c) for c in values])
    r = right.filter(F.col(ts).isNotNull()).select(*[F.col(c) if c in (*by, ts) else none(left, c).alias(c) for c in cols], v.alias("_v"), s.alias("_s"), rank.alias("_k"), F.lit(False).alias("_left"))
    if hot is not None and not hot:
        u = l.unionByName(r.dropna(subset=by))
        j = u.withColumn("_got", F.last("_v", ignorenulls=True).over(W.partitionBy(*by).orderBy(ts, "_s", "_k").rowsBetween(W.unboundedPreceding, 0))).filter("_left")
        return _brought(j, cols, ts, values, tolerance, prefix)
    u = l.unionByName(r).withColumn("_st", F.expr(f"`{ts}` div {STRETCH}"))
    order = [F.col(ts), F.col("_s"), F.col("_k")]
    inner = F.last("_v", ignorenulls=True).over(W.partitionBy(*by, "_st").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    ends = u.filter("_v is not null").groupBy(*by, "_st").agg(F.max(F.struct(ts, "_s", "_k", "_v")).alias("_e"))
    marks = u.select(*by, "_st").distinct().join(ends, [*by, "_st"], "left")
    carried = F.last("_e._v", ignorenulls=True).over(W.partitionBy(*by).orderBy("_st").rowsBetween(W.unboundedPreceding, -1))
    marks = marks.select(*by, "_st", carried.alias("_carry"))
    j = u.withColumn("_in", inner).filter("_left").join(marks, [*by, "_st"], "left").withColumn("_got", F.coalesce("_in", "_carry"))
    return _brought(j, cols, ts, values, tolerance, prefix)


def _brought(j: DataFrame, cols: list[str], ts: str, values: list[str], tolerance: int | None, prefix: str) -> DataFrame:
    if tolerance is not None:
        j = j.withColumn("_got", F.when(F.col(ts) - F.col(f"_got.{ts}") <= tolerance, F.col("_got")))
    return j.select(*cols, F.col(f"_got.{ts}").alias(prefix + ts), *[F.col(f"_got.{c}").alias(prefix + c) for c in values])


def fill_forward(df: DataFrame, by: list[str], ts: str, seq: str, values: list[str], stretch: int = STRETCH, hot: list | None = None) -> DataFrame:
    """Nulls of the value columns replaced by the last value before them in their key, by (ts, seq).

    Where there are hot keys (or it is not known), last values are found within stretches of time and carried across
    them, so no task holds such a key's whole history; the rows are written once for that.
    """
    if hot is not None and not hot:
        w = W.partitionBy(*by).orderBy(ts, seq).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in values})
    df = materialise(df, "unfilled")
    d = df.withColumn("_st", F.expr(f"`{ts}` div {stretch}"))
    order = F.struct(ts, seq)
    ends = d.groupBy(*by, "_st").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_e_{c}") for c in values])
    w = W.partitionBy(*by).orderBy("_st").rowsBetween(W.unboundedPreceding, -1)
    carry = ends.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col("_st").alias("_ks"), *[F.last(f"_e_{c}", ignorenulls=True).over(w).alias(f"_c_{c}") for c in values])
    inner = W.partitionBy(*by, "_st").orderBy(ts, seq).rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumns({c: F.last(c, ignorenulls=True).over(inner) for c in values})
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)] + [F.col("_st").eqNullSafe(F.col("_ks"))]
    return d.join(carry, on, "left").select(*[F.coalesce(c, f"_c_{c}").alias(c) if c in values else F.col(c) for c in df.columns])


def _struct(df: DataFrame, ts: str, values: list[str]):
    from pyspark.sql import types as T

    return T.StructType([df.schema[c] if c != ts else T.StructField(ts, df.schema[ts].dataType) for c in (ts, *values)])


def range_join(left: DataFrame, right: DataFrame, by: list[str], point: str, low: str, high: str, width: int) -> DataFrame:
    """Left points within right intervals [low, high): an equi-join on time buckets of ``width``, then the exact test.

    Long intervals take a row for each bucket they touch, so choose the width near the usual length.
    """
    l = left.withColumn("_b", F.floor(F.col(point) / width))
    r = right.filter(F.col(high) > F.col(low)).withColumn("_b", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor((F.col(high) - 1) / width))))
    return l.join(r, [*by, "_b"]).filter((F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))).drop("_b")


def level_intervals(changes: DataFrame, by: list[str], seq: str, price: str, quantity: str, side: str, removed: Column | None = None) -> DataFrame:
    """For each change of a level the stretch of sequence [from_seq, to_seq) in which its quantity stands; removals stand nowhere."""
    gone = F.coalesce(removed if removed is not None else F.col(quantity) <= 0, F.lit(False))
    d = changes.withColumns({"_side": normal.book_side(side), "_gone": gone}).filter(F.col("_side").isNotNull() & F.col(price).isNotNull() & F.col(seq).isNotNull())
    one = d.groupBy(*by, "_side", price, seq).agg(F.max(F.struct("_gone", quantity)).alias("_v"))
    nxt = F.lead(seq).over(W.partitionBy(*by, "_side", price).orderBy(seq))
    return one.select(*by, F.col("_side").alias("side"), price, F.col(f"_v.{quantity}").alias(quantity), F.col(seq).alias("from_seq"), nxt.alias("to_seq"), F.col("_v._gone").alias("_gone")).filter("not _gone").drop("_gone")


#: Size of a block of sequences in blocks of the level below.
RADIX = 16


def _blocks(iv: DataFrame, low: str, high: str, levels: int, radix: int) -> DataFrame:
    """Adds ``_lv`` and ``_b``: each interval [low, high) as the fewest blocks of sizes radix^level, numbered by their place.

    At every level the blocks that lie in the interval but in no block of the next level that does: two stretches of less than radix each.
    """
    d = iv.withColumn("_lv", F.explode(F.array(*[F.lit(i) for i in range(levels + 1)])))
    size = F.element_at(F.array(*[F.lit(radix**i).cast("long") for i in range(levels + 2)]), F.col("_lv") + 1)
    d = d.withColumn("_s", size)
    down = lambda x, s: f"(({x} - pmod({x}, {s})) div {s})"
    up = lambda x, s: down(f"({x} + {s} - 1)", s)
    d = d.withColumns({"_a": F.expr(up(low, "_s")), "_e": F.expr(down(high, "_s")), "_a1": F.expr(up(low, f"(_s * {radix})")) * radix, "_e1": F.expr(down(high, f"(_s * {radix})")) * radix})
    some = lambda lo, hi: F.when(F.col(lo) < F.col(hi), F.sequence(F.col(lo), F.col(hi) - 1)).otherwise(F.array().cast("array<bigint>"))
    inner = (F.col("_a1") < F.col("_e1")) & (F.col("_lv") < levels)
    d = d.withColumn("_b", F.explode(F.when(inner, F.concat(some("_a", "_a1"), some("_e1", "_e"))).otherwise(some("_a", "_e"))))
    return d.drop("_s", "_a", "_e", "_a1", "_e1")


def book_states(changes: DataFrame, by: list[str], seq: str = "sequence_num", price: str = "price_level", quantity: str = "new_quantity", side: str = "side", removed: Column | None = None, width: int = RADIX) -> DataFrame:
    """Best quotes after each message of a level-2 feed: best_bid, best_bid_size, best_ask, best_ask_size, mid_price, spread, spread_bps.

    Each level stands from its change to the next of the same level; a snapshot sets its levels and clears none. A level
    that stands for long does not meet every message: its stretch of sequences is covered by blocks of growing size, at most
    twice ``width`` for each power of it in its length; blocks are reduced to the best of each side, and a message asks the one block of each size
    it lies in. Null until both sides have a level.
    """
    iv = level_intervals(changes, by, seq, price, quantity, side, removed)
    ticks = changes.filter(F.col(seq).isNotNull()).select(*by, F.col(seq).cast("long").alias("seq")).distinct()
    ends = ticks.groupBy(*by).agg((F.max("seq") + 1).alias("_end"))
    iv = materialise(iv.join(ends, by).withColumn("to_seq", F.coalesce("to_seq", "_end")).drop("_end"), "levels")
    longest = iv.agg(F.max(F.col("to_seq") - F.col("from_seq"))).first()[0] or 1
    levels = 0
    while width ** (levels + 1) <= longest and width ** (levels + 2) < 1 << 62:
        levels += 1
    best = lambda s, p, q: (F.max(F.when(F.col("side") == s, F.struct(F.col(p).alias("p"), F.col(q).alias("q")))) if s == "bid" else F.min(F.when(F.col("side") == s, F.struct(F.col(p).alias("p"), F.col(q).alias("q")))))
    standing = _blocks(iv, "from_seq", "to_seq", levels, width).groupBy(*by, "_lv", "_b").agg(best("bid", price, quantity).alias("_wb"), best("ask", price, quantity).alias("_wa"))
    asked = ticks.select(*by, "seq", F.posexplode(F.array(*[F.expr(f"(seq - pmod(seq, {width**i}L)) div {width**i}L") for i in range(levels + 1)])).alias("_lv", "_b"))
    j = asked.join(standing, [*by, "_lv", "_b"], "left").groupBy(*by, "seq").agg(F.max("_wb").alias("_bid"), F.min("_wa").alias("_ask")).withColumnRenamed("seq", seq)
    both = F.col("_bid").isNotNull() & F.col("_ask").isNotNull()
    b, a = F.when(both, F.col("_bid.p")), F.when(both, F.col("_ask.p"))
    mid = (b + a) / 2
    return j.select(*by, seq, b.alias("best_bid"), F.when(both, F.col("_bid.q")).alias("best_bid_size"), a.alias("best_ask"), F.when(both, F.col("_ask.q")).alias("best_ask_size"), mid.alias("mid_price"), (a - b).alias("spread"), F.when(mid > 0, (a - b) / mid * 10000).alias("spread_bps"))
