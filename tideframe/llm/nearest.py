"""Problem 7: the nearest record in time of the same entity, by expanding rings.

The right side is reduced to one row for each bucket of time: its earliest and latest record and, at the
first ring only, its distinct times, of which a bucket cannot hold more than it has milliseconds, whatever the tolerance. Every left row
meets exactly one row of the right side in each ring, so no ring forms pairs within a group. A match
is taken once no nearer record can exist; the other left rows go on to a ring twice as wide, up to the
tolerance.

Defined results: left rows without entity or time, or with no record near enough, have no match; of two records
equally near the earlier wins, of records of the same time the least value; repeated left rows each get
their match; an empty side gives no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.session import materialise

#: Width in ms from which the first ring's buckets are not made wider: a bucket of the first ring keeps at most this many distinct times.
FIRST_WIDTH = 1_024


def _bucket(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(width)).cast("long")


def _ring(points: DataFrame, by: list[str], width: int, own: bool) -> DataFrame:
    """For each bucket: the last record of the bucket(s) before, the first of those after, and with ``own`` its own records."""
    point = F.struct("_t", "_v")
    cells = points.groupBy(*by, _bucket(F.col("_t"), width).alias("_b")).agg(F.min(point).alias("lo"), F.max(F.struct("_t", -F.col("_v"))).alias("hi"), *([F.collect_list(point).alias("all")] if own else []))
    cells = cells.withColumn("hi", F.struct(F.col("hi._t").alias("_t"), (-F.col("hi.col2")).alias("_v")))
    none = F.lit(None).cast("struct<_t:bigint,_v:bigint>")
    empty = F.lit(None).cast("array<struct<_t:bigint,_v:bigint>>")
    reach = (1,) if own else (1, 2)
    posts = [F.struct((F.col("_b") + k).alias("_b"), F.col("hi").alias("left"), none.alias("right"), empty.alias("all")) for k in reach]
    posts += [F.struct((F.col("_b") - k).alias("_b"), none.alias("left"), F.col("lo").alias("right"), empty.alias("all")) for k in reach]
    if own:
        posts.append(F.struct(F.col("_b"), none.alias("left"), none.alias("right"), F.col("all")))
    p = cells.select(*by, F.explode(F.array(*posts)).alias("p")).select(*by, "p.*")
    return p.groupBy(*by, "_b").agg(F.max("left").alias("left"), F.min("right").alias("right"), *([F.first("all", ignorenulls=True).alias("all")] if own else []))


def match_nearest(left: DataFrame, right: DataFrame, by: list[str], left_time: str, left_id: str, right_time: str, right_value: str, tolerance_ms: int = 5_000, rings: int | None = None) -> DataFrame:
    """``left_id``, ``right_value`` and ``distance`` (ms) of every left row with a record within the tolerance.

    ``rings``: by default four, or as many as it takes from a first bucket of at most FIRST_WIDTH. Times and values are longs; ``by`` names the entity on both sides.
    """
    pts = right.select(*by, F.col(right_time).alias("_t"), F.col(right_value).alias("_v")).filter("_t is not null and _v is not null").groupBy(*by, "_t").agg(F.min("_v").alias("_v"))
    pts = materialise(pts, "points")
    todo = left.select(*by, F.col(left_time).alias("_t"), F.col(left_id).alias("_id")).filter("_t is not null")
    for c in by:
        todo = todo.filter(F.col(c).isNotNull())
    done = None
    if rings is None:
        rings = 4
        while -(-tolerance_ms // (1 << (rings - 1))) > FIRST_WIDTH:
            rings += 1
    radius = max(1, -(-tolerance_ms // (1 << (rings - 1))))
    width, own = radius, True
    while True:
        reach = min(radius, tolerance_ms)
        ring = _ring(pts, by, width, own)
        j = todo.withColumn("_b", _bucket(F.col("_t"), width)).join(ring, [*by, "_b"], "left")
        d = lambda s: F.struct(F.abs(s["_t"] - F.col("_t")).alias("d"), s["_t"].alias("at"), s["_v"].alias("v"))
        some = lambda c: F.when(F.col(c).isNotNull(), d(F.col(c)))
        near = [some("left"), some("right")]
        if own:
            near.append(F.array_min(F.transform("all", d)))
        best = F.least(*near)
        j = j.select(*by, "_t", "_id", F.when(best["d"] <= reach, best).alias("m"))
        if radius >= tolerance_ms:
            out = j.filter("m is not null")
            part = out.select("_id", "m")
            done = part if done is None else done.unionByName(part)
            break
        j = materialise(j, "ring")
        part = j.filter("m is not null").select("_id", "m")
        done = part if done is None else done.unionByName(part)
        todo = j.filter("m is null").select(*by, "_t", "_id")
        width, own, radius = radius, False, min(2 * radius, tolerance_ms)
    return done.select(F.col("_id").alias(left_id), F.col("m.v").alias(right_value), F.col("m.d").alias("distance"))
