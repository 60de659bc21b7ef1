"""Feature rows and bars of books that come in micro-batches, by the batch operators over the new rows and a carried context.

The context of a key is what its next rows can still ask for: the rows of the longest window behind the newest row and of one
window more, from which the regimes in it come; the last row with each held measure and its window; the rows of the open bars;
the last row emitted; the row before all these. Trades are kept for a window behind the last of each side. Rows wait until the
newest time seen is ``delay_ms`` past them; a row that comes after its time was worked off is late, counted and left out. The
context is written once for each micro-batch under its number, so that one done again starts from the same context.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.config import FeatureConfig
from tideframe.functions import fs, normal
from tideframe.operators import features

KEY = ["exchange", "symbol"]
BOOK = [*KEY, "ts", "seq", "bids", "asks"]
TRADE = [*KEY, "ts", "seq", "side", "amount"]
HELD = ["bid_slope_regression", "ask_slope_regression", "cog_vs_mid"]
START = {"mark": -(1 << 62), "files": 0}


def before(spark: SparkSession, at: str, number: int) -> tuple[str | None, dict]:
    """The folder and the figures of the newest context before a micro-batch."""
    done = sorted((int(n) for n in fs.subdirs(spark, at) if int(n) < number and fs.exists(spark, f"{at}/{n}/figures.json")), reverse=True)
    for n in done[1:]:
        fs.delete(spark, f"{at}/{n}")
    return (f"{at}/{done[0]}", json.loads(fs.read_text(spark, f"{at}/{done[0]}/figures.json"))) if done else (None, dict(START))


def _with(df: DataFrame, by_key: DataFrame) -> DataFrame:
    """Adds the columns of a frame with a row a key; null keys meet."""
    k = by_key.select(*[F.col(c).alias(f"_k_{c}") for c in KEY], *[c for c in by_key.columns if c not in KEY])
    return df.join(k, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in KEY]), "left").drop(*[f"_k_{c}" for c in KEY])


def step(spark: SparkSession, at: str, number: int, books: DataFrame, trades: DataFrame, files: int, cfg: FeatureConfig, delay_ms: int) -> tuple[DataFrame, DataFrame, int]:
    """Rows and closed bars that a micro-batch makes known, and how many of its rows are late. ``seq`` must rise over all micro-batches."""
    old, figures = before(spark, at, number)
    here = f"{at}/{number}"
    fs.delete(spark, here)
    mark = figures["mark"]

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{here}/{name}")
        return spark.read.schema(df.schema).parquet(f"{here}/{name}")

    new_b = keep(books.filter("ts is not null").select(*BOOK, F.lit(False).alias("done"), F.lit(False).alias("emitted")), "new_books")
    new_t = keep(trades.filter("ts is not null").select(*TRADE), "new_trades")
    late = new_b.filter(F.col("ts") <= mark).count() + new_t.filter(F.col("ts") <= mark).count()
    newest = max((x for x in (d.agg(F.max("ts")).first()[0] for d in (new_b, new_t)) if x is not None), default=None)
    to = mark if newest is None else max(mark, newest - delay_ms)
    new_b, new_t = new_b.filter(F.col("ts") > mark), new_t.filter(F.col("ts") > mark)
    b = spark.read.schema(new_b.schema).parquet(f"{old}/books").unionByName(new_b) if old else new_b
    t = spark.read.schema(new_t.schema).parquet(f"{old}/trades").unionByName(new_t) if old else new_t
    ready, known = b.filter(F.col("ts") <= to), t.filter(F.col("ts") <= to)
    f = features.hf_features(ready.select(*BOOK), known, cfg, every_row=True)
    rows = keep(f.join(ready.select("seq", "done", "emitted"), "seq").select(*f.columns, "done", "emitted"), "rows")
    out = keep(features.downsample(rows.filter("not done or emitted"), KEY, "ts", int(cfg.hf_emit_interval * 1000)), "out")
    hf = out.filter("not done").select(*f.columns)

    last = ready.filter("done").groupBy(*KEY).agg(F.max("ts").alias("_last"))
    bars = features.feature_bars(ready.select(*BOOK), cfg)
    bars = _with(bars, last).filter(F.expr("_last is null or bar_start >= _last - pmod(_last, duration * 1000L)")).select(*bars.columns)

    window = 1000 * max(*cfg.horizons, cfg.depth_window, cfg.spread_regime_window, cfg.kyle_lambda_window, cfg.slope_window)
    longest = max(cfg.bar_durations) * 1000
    newest_row = _with(rows.select(*KEY, "ts", "seq", *HELD), rows.groupBy(*KEY).agg(F.max("ts").alias("_end")))
    has = [F.max(F.when(F.col(c).isNotNull(), F.col("ts"))) - window for c in HELD]
    opened = F.min(F.least(*[F.expr(f"_end - pmod(_end, {d * 1000}L)") for d in cfg.bar_durations], F.col("_end") - longest)) - 1
    cut = newest_row.groupBy(*KEY).agg((F.max(F.when(F.col("ts") <= F.col("_end") - window, F.col("ts"))) - window).alias("_a"), F.least(*has, opened).alias("_b"))
    sent = out.groupBy(*KEY).agg(F.max(F.struct("ts", "seq")).alias("_sent"))
    # Without a row a window back all rows are within it, and stay.
    s = _with(_with(ready, cut), sent).withColumn("_cut", F.when(F.col("_a").isNotNull(), F.least("_a", "_b", F.col("_sent.ts") - 1)))
    s = _with(s, s.filter("ts <= _cut").groupBy(*KEY).agg(F.max(F.struct("ts", "seq")).alias("_edge")))
    s = s.filter("_cut is null or ts > _cut or seq = _edge.seq").select(*BOOK, F.lit(True).alias("done"), F.coalesce(F.col("seq") == F.col("_sent.seq"), F.lit(False)).alias("emitted"))
    keep(s.unionByName(b.filter(F.col("ts") > to)), "books")
    k = known.withColumn("_s", normal.trade_side("side")).filter("_s in ('buy', 'sell') and amount is not null")
    sides = k.groupBy(*KEY, "_s").agg(F.max("ts").alias("_t")).groupBy(*KEY).agg((F.min("_t") - 1000 * max(cfg.horizons)).alias("_from"))
    keep(_with(k, sides).filter("ts > _from").select(*TRADE).unionByName(t.filter(F.col("ts") > to)), "trades")
    fs.write_text(spark, f"{here}/figures.json", json.dumps({"mark": to, "files": figures["files"] + files}))
    return hf, bars, late
