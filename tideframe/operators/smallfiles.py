"""Problem 6: very many small files consolidated into few of even size, clustered along a Hilbert curve.

``superseded`` finds the remains of earlier consolidations, files all of whose records lie in another file, from the records as ``file_records`` clusters them.
``compact`` keeps one row of every record (deletion vectors, as for repeated deliveries), gives it a Hilbert code of
exchange, symbol and time, counts the rows of each code exactly, cuts the curve into files of equal
row counts, shuffles once by file, writes, and compares row digests of source and destination.

Defined results: rows without a record number are no copies and are all kept; an empty table gives no
files; of files with the same records the one with the least number stays; a record listed twice in one
file counts once there.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tideframe.functions import fs, normal
from tideframe.operators import redelivery
from tideframe.session import BROADCAST_LIMIT, materialise, scratch, ship, small

#: Bits for each of the three dimensions: at most 2^18 codes, so the histogram is never larger than a few MB.
BITS = 6
#: Words of 64 bits in a file's signature, and narrow rows in a file of clustered records.
SIGNATURE, RECORD_ROWS = 4, 2_000_000


def hilbert_codes(axes: list, bits: int):
    """Position along the Hilbert curve of each point; axes are integer arrays below 2^bits.

    Works from the transposed form of the index: excess bits are undone from the top bit down, then the
    result is Gray-coded, then the bits of all axes are interleaved.
    """
    import numpy as np

    x = [np.array(a, dtype=np.int64) for a in axes]
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    code = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            code = (code << 1) | (((x[i] ^ t) >> b) & 1)
    return code


def hilbert(*axes: Column, bits: int = BITS) -> Column:
    @F.pandas_udf(T.LongType())
    def code(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_codes([a.to_numpy(), b.to_numpy(), c.to_numpy()], bits))

    return code(*axes)


def superseded(records: DataFrame) -> DataFrame:
    """file_no of every file whose records all lie in one other file of its group that holds more, or as many under a smaller number.

    records: group columns g (one), file_no, rec_no, best clustered (``clustered``). Files with the same records are first reduced to one by their digests;
    then each file only asks the files that hold its least common record. Of these only such are counted against it as hold its first and its last
    record too, and all bits of its signature. No step forms pairs within a group.
    """
    r = materialise(records.filter("file_no is not null and rec_no is not null").select("g", "file_no", "rec_no").distinct(), "records")
    h = [F.xxhash64("rec_no"), F.xxhash64(F.lit(7), "rec_no")]
    bits = [F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64({20 + i}, rec_no), 64) as int))")).alias(f"s{i}") for i in range(SIGNATURE)]
    signature = [f"s{i}" for i in range(SIGNATURE)]
    sets = r.groupBy("g", "file_no").agg(F.count("*").alias("n"), F.sum(h[0].cast("decimal(38,0)")).alias("h0"), F.bit_xor(h[1]).alias("h1"), F.min("rec_no").alias("lo"), F.max("rec_no").alias("hi"), *bits)
    sets = materialise(sets, "sets")
    same = ["g", "n", "h0", "h1", "lo", "hi"]
    classes = sets.groupBy(*same).agg(F.min("file_no").alias("rep"), F.count("*").alias("files"), *[F.first(c).alias(c) for c in signature])
    copies = sets.join(classes.filter("files > 1").select(*same, "rep"), same).filter("file_no <> rep").select("file_no")
    reps = materialise(classes.select("g", F.col("rep").alias("file_no"), "n", "lo", "hi", *signature), "classes")
    held = materialise(r.join(reps.select("g", "file_no", "n"), ["g", "file_no"]), "held")  # g, file_no, rec_no, n
    degree = held.groupBy("g", "rec_no").agg(F.count("*").alias("deg"))
    # Only records in more than one file can show a file to be contained; a file with any other record is out.
    shared = held.join(degree.filter("deg > 1"), ["g", "rec_no"])
    whole = shared.groupBy("g", "file_no", "n").agg(F.count("*").alias("c"), F.min(F.struct("deg", "rec_no")).alias("rare")).filter("c = n").select("g", "file_no", "n", F.col("rare.rec_no").alias("rec_no"))
    whole = materialise(whole.join(reps.drop("n"), ["g", "file_no"]), "askers")
    n = whole.count()
    other = held.select("g", "rec_no", F.col("file_no").alias("other"), F.col("n").alias("m"))
    ask = other.join(small(whole, n), ["g", "rec_no"]).filter((F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("other") < F.col("file_no"))))
    theirs = reps.select("g", F.col("file_no").alias("other"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), *[F.col(c).alias(f"{c}b") for c in signature])
    fits = (F.col("lo2") <= F.col("lo")) & (F.col("hi2") >= F.col("hi"))
    for c in signature:
        fits = fits & (F.col(c).bitwiseAND(F.bitwise_not(F.col(f"{c}b"))) == 0)
    ask = ask.join(theirs, ["g", "other"]).filter(fits).select("g", "file_no", "n", "other", "lo", "hi")
    for edge in ("lo", "hi"):
        ask = ask.join(held.select("g", F.col("file_no").alias("other"), F.col("rec_no").alias(edge)), ["g", "other", edge], "left_semi")
    ask = materialise(ask.select("g", "file_no", "n", "other"), "asked")
    mine = shared.select("g", "file_no", "rec_no").join(small(ask, ask.count()), ["g", "file_no"])
    found = mine.join(held.select("g", F.col("file_no").alias("other"), "rec_no"), ["g", "other", "rec_no"]).groupBy("g", "file_no", "n", "other").agg(F.count("*").alias("c")).filter("c = n")
    return found.select("file_no").unionByName(copies).distinct()


def ticker_records(ticker: DataFrame) -> DataFrame:
    g = F.concat_ws("\x01", normal.exchange("exchange"), normal.instrument("symbol"), "date")
    return ticker.select(g.alias("g"), "file_no", "rec_no")


def digest(df: DataFrame) -> tuple[int, int, int]:
    """Row count and two order-free digests over all columns; equal tables have equal digests."""
    cols = [F.col(c) for c in sorted(df.columns)]
    r = df.agg(F.count("*"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit(11), *cols))).first()
    return int(r[0]), int(r[1] or 0), int(r[2] or 0)


@dataclass
class Compaction:
    path: str
    files: int
    source: tuple[int, int, int]
    written: tuple[int, int, int]


def _shares(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Each value with its place among 2^BITS stretches of equal numbers of rows, in the order of the values: neighbours stay neighbours."""
    c = df.groupBy(value.alias(name)).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(W.orderBy(name).rowsBetween(W.unboundedPreceding, 0)) - F.col("_c")
    total = F.sum("_c").over(W.partitionBy())
    return c.select(F.coalesce(name, F.lit("")).alias(name), F.floor(upto * (1 << BITS) / total).cast("long").alias(f"{name}_at"))


def coded(df: DataFrame, narrow: DataFrame | None = None) -> DataFrame:
    """Adds ``_code``, the place along the Hilbert curve of exchange, instrument and time; axes are cut from ``narrow``, any frame with those three columns.

    The tables of exchanges and instruments have a row for each value that occurs, and are broadcast only if counted small.
    """
    narrow = (df if narrow is None else narrow).select("exchange", "symbol", "timestamp")
    span = narrow.agg(F.min("timestamp"), F.max("timestamp")).first()
    lo, width = span[0] or 0, max(1, ((span[1] or 0) - (span[0] or 0)) // (1 << BITS) + 1)
    out = df
    for name, value in (("_ex", normal.exchange("exchange")), ("_sy", normal.instrument("symbol"))):
        t = materialise(_shares(narrow, value, name), "shares")
        out = out.withColumn(name, F.coalesce(value, F.lit(""))).join(small(t, t.count()), name, "left")
    last = F.lit((1 << BITS) - 1)
    time = F.least(F.greatest(F.coalesce(F.expr(f"(timestamp - {lo}) div {width}"), F.lit(0)), F.lit(0)), last)
    code = hilbert(F.coalesce("_ex_at", F.lit(0)), F.coalesce("_sy_at", F.lit(0)), time)
    return out.withColumn("_code", code).drop("_ex", "_sy", "_ex_at", "_sy_at")


def clustered(df: DataFrame, out: str, rows_per_file: int, spread_by: list[Column], cols: list[str]) -> int:
    """Write ``df``, which has ``_code``, along the curve in files of about ``rows_per_file`` rows; gives the number of files.

    The histogram of the codes is exact (every row counts, combined on the map side) and never larger than 2^18 rows. Rows are
    shuffled once, by file. A code with more rows than an eighth of a file is spread over its stretch of the curve.
    """
    hist = df.groupBy("_code").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_code").rowsBetween(W.unboundedPreceding, -1))
    hist = materialise(hist.withColumn("_before", F.coalesce(before, F.lit(0))), "histogram")
    total = hist.agg(F.sum("_n")).first()[0] or 0
    n_files = max(1, -(-total // rows_per_file))
    per = -(-total // n_files) or 1
    place = F.col("_before") + F.when(F.col("_n") > per // 8, F.pmod(F.xxhash64(*spread_by), F.col("_n"))).otherwise(F.lit(0))
    placed = df.join(F.broadcast(hist), "_code").withColumn("_file", F.least(F.floor(place / per).cast("int"), F.lit(n_files - 1)))
    order = ["_code", *[c for c in ("timestamp",) if c in df.columns]]
    placed.repartitionById(n_files, F.col("_file")).sortWithinPartitions(*order).select(*cols).write.mode("overwrite").option("compression", "zstd").parquet(out)
    return n_files


def file_records(spark: SparkSession, path: str, rows_per_file: int = RECORD_ROWS) -> DataFrame:
    """g, file_no and rec_no of every row of the ticker table, clustered along the curve: records of one source and time, and so of one file and of its copies, lie together.

    The first half of ``compact``, on the narrow columns and all deliveries; raises if the written rows have another digest than those read.
    """
    ship(spark)
    t = spark.read.parquet(path).select("exchange", "symbol", "date", "timestamp", "file_no", "rec_no")
    c = coded(t)
    g = ticker_records(c).columns
    c = c.select(F.concat_ws("\x01", normal.exchange("exchange"), normal.instrument("symbol"), "date").alias("g"), "file_no", "rec_no", "timestamp", "_code")
    out = scratch(spark, "file-records")
    clustered(c, out, rows_per_file, [F.col("rec_no"), F.col("file_no")], g)
    written = spark.read.schema(c.select(*g).schema).parquet(out)
    if digest(written) != digest(ticker_records(t)):
        raise ValueError("records differ after clustering")
    return written


def compact(spark: SparkSession, path: str, target: str | None = None, rows_per_file: int | None = None, record: str = "rec_no", order: tuple[str, ...] = ("file_no",), limit: int = BROADCAST_LIMIT, target_mb: float = 128) -> Compaction:
    """Write the table's records once each, clustered and in files of about ``rows_per_file`` rows; raises if a row is lost or doubled.

    Without ``rows_per_file`` files hold as many rows as take ``target_mb`` in the table's own files.
    """
    ship(spark)
    if rows_per_file is None:
        size = sum(f.size for f in fs.files(spark, path))
        rows_per_file = max(1, int(spark.read.parquet(path).count() * target_mb * 1e6 / size)) if size else 1_000_000
    dv = redelivery.find_copies(spark, path, {record: F.col(record)}, [F.col(c) for c in order], limit)
    kept = redelivery.apply_vectors(spark, path, dv, limit=limit)
    out = target or scratch(spark, "compacted")
    clustered(coded(kept, spark.read.parquet(path)), out, rows_per_file, [F.col(record), F.col("timestamp")], kept.columns)
    written = spark.read.schema(kept.schema).parquet(out)
    result = Compaction(out, len(fs.files(spark, out)), digest(kept), digest(written))
    if result.source != result.written:
        fs.delete(spark, out)
        raise ValueError(f"rows differ after compaction: {result.source} and {result.written}")
    return result
