"""Splitting of hot keys, so that no window of a key's whole history runs in one task.

``split_hot`` gives every row a chunk. Keys of up to ``rows_per_chunk`` rows have one chunk and cost nothing more;
larger ones are cut by time into chunks of about that many rows, and each chunk also receives, marked
``_halo``, the rows before it that its windows can reach: those within a horizon of time, or the last few. Windows
then run over (key, chunk), and halo rows are dropped by ``own``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideframe.session import materialise, small

ROWS_PER_CHUNK = 2_000_000
CHUNK, HALO = "_chunk", "_halo"
#: Time buckets that chunks are made of, in units of the time column (ms).
BUCKET = 60_000


def _floor(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(width)).cast("long")


def hot_keys(df: DataFrame, by: list[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> list:
    """Keys of more rows than a chunk holds; of these there are at most rows / rows_per_chunk."""
    return df.groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_chunk).drop("_n").collect()


def split_hot(df: DataFrame, by: list[str], ts: str, horizon: int = 0, last_rows: int = 0, order: list[str] | None = None, rows_per_chunk: int = ROWS_PER_CHUNK, bucket: int = BUCKET, hot: list | None = None) -> DataFrame:
    """``df`` with ``_chunk`` and ``_halo``. ``ts`` is a long; rows without it go to the first chunk of their key.

    ``hot``: the result of ``hot_keys``, where it is already known. ``horizon``: rows up to this much earlier than a chunk's start are its halo. ``last_rows``: so are
    the last rows, by ``order`` after ``ts``, before it.
    """
    whole = df.withColumns({CHUNK: F.lit(0).cast("long"), HALO: F.lit(False)})
    hot = hot_keys(df, by, rows_per_chunk) if hot is None else hot
    if not hot:
        return whole
    # The rows are asked several times below: from a table, so that what made them runs once, however splits follow one another.
    df = materialise(df, "split")
    # Sides are renamed, so that frames of one source can meet; null keys are keys like any other.
    ren = lambda t, *rest: t.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], *rest)
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]
    side = small(ren(df.sparkSession.createDataFrame([tuple(h) for h in hot], df.select(*by).schema)), len(hot))
    cold = df.join(side, on, "left_anti").withColumns({CHUNK: F.lit(0).cast("long"), HALO: F.lit(False)})
    rows = df.join(side, on, "left_semi").withColumn("_bk", F.coalesce(_floor(F.col(ts), bucket), F.lit(-(2**62))))
    hist = rows.groupBy(*by, "_bk").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*by).orderBy("_bk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    hist = ren(hist.withColumn(CHUNK, F.floor(before / rows_per_chunk).cast("long")), F.col("_bk").alias("_hb"), CHUNK)
    rows = rows.join(hist, [*on, F.col("_bk") == F.col("_hb")]).select(*df.columns, "_bk", CHUNK)
    parts = [cold, rows.withColumn(HALO, F.lit(False)).drop("_bk")]
    keyed = [f"_k{i}" for i in range(len(by))]
    if horizon > 0:
        starts = hist.groupBy(*keyed, F.col(CHUNK).alias("_for")).agg(F.min("_hb").alias("_b0")).withColumn("_start", F.col("_b0") * bucket)
        need = starts.select(*keyed, "_for", "_start", F.explode(F.sequence(_floor(F.col("_start") - horizon, bucket), F.col("_b0"))).alias("_nb"))
        cond = [*on, F.col("_bk") == F.col("_nb"), F.col(ts) > F.col("_start") - horizon, F.col(CHUNK) < F.col("_for")]
        parts.append(rows.join(need.filter("_for > 0"), cond).select(*df.columns, F.col("_for").alias(CHUNK), F.lit(True).alias(HALO)))
    if last_rows > 0:
        o = [F.col(ts), *[F.col(c) for c in order or []]]
        tail = rows.withColumn("_r", F.row_number().over(W.partitionBy(*by, CHUNK).orderBy(*[c.desc() for c in o]))).filter(F.col("_r") <= last_rows).drop("_r", "_bk")
        tail = tail.withColumn("_i", F.row_number().over(W.partitionBy(*by).orderBy(CHUNK, *o)))
        first = ren(tail.groupBy(*by, CHUNK).agg(F.min("_i").alias("_i0")), F.col(CHUNK).alias("_for"), "_i0")
        need = first.select(*keyed, "_for", F.explode(F.sequence(F.col("_i0") - last_rows, F.col("_i0") - 1)).alias("_want"))
        parts.append(tail.join(need, [*on, F.col("_i") == F.col("_want")]).select(*df.columns, F.col("_for").alias(CHUNK), F.lit(True).alias(HALO)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def own(df: DataFrame) -> DataFrame:
    """The rows that are not halo, without the helper columns."""
    return df.filter(~F.col(HALO)).drop(CHUNK, HALO)
