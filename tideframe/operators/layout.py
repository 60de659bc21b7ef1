"""Layout of Parquet datasets: repartition, compact, migrate, repair, validate, estimate."""

from __future__ import annotations

import datetime
import math
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.functions import fs
from tideframe.functions.swap import Swap
from tideframe.session import ship, small
from tideframe.sources.segments import file_listing, path_values
from tideframe.sources.sinks import partition_value, write_dataset

#: Fixed value: how data files are named.
FILE_NAME = r"part_\d{8}T\d{2}_[a-f0-9]{8}(_\d+)?\.parquet"


def repartition(spark: SparkSession, source: str, target: str, by: list[str], transform: Callable[[DataFrame], DataFrame] | None = None, validate: bool = True, delete_source: bool = False, dry_run: bool = False) -> dict:
    """Rewrite a dataset under other partition columns, which the transform may have made. The source goes only after the counts agree."""
    d = spark.read.option("mergeSchema", "true").parquet(source)
    out = d.transform(transform) if transform else d
    missing = [c for c in by if c not in out.columns]
    if missing:
        raise ValueError(f"no such columns to partition by: {missing}")
    stats = {"rows": out.count(), "partitions": out.select(*[partition_value(c).alias(c) for c in by]).distinct().count()}
    if dry_run:
        return stats
    write_dataset(out, target, by, mode="overwrite")
    if validate:
        got = spark.read.parquet(target).count()
        if got != stats["rows"]:
            raise ValueError(f"{stats['rows']} rows in the source, {got} in the target; the source is kept")
    if delete_source:
        fs.delete(spark, source)
    return stats


def partitions(spark: SparkSession, path: str) -> DataFrame:
    """Each folder with data files: partition, files, bytes."""
    base = path.rstrip("/")
    rel = F.regexp_replace(F.regexp_replace("path", r"/[^/]+$", ""), rf"^.*?{re.escape(base.split(':')[-1].lstrip('/'))}/?", "")
    return file_listing(spark, path).groupBy(rel.alias("partition")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def compact(spark: SparkSession, path: str, target_mb: float = 100, min_files: int = 2, max_file_mb: float | None = None, target_files: int | None = None, sort_by: list[str] | None = None, dry_run: bool = False) -> dict:
    """Rewrite each folder with at least ``min_files`` files (of at most ``max_file_mb``) into files of about ``target_mb``.

    Files are listed by a Spark job, and only folders come to the driver. All folders are rewritten by one job: rows go to their
    folder's files by range of their number within it. New files are counted, then swapped in (``functions.swap``): a folder all of
    whose files are rewritten as a whole, else file by file.
    """
    base = path.rstrip("/")
    listing = file_listing(spark, base).withColumn("folder", F.regexp_replace("path", r"/[^/]+$", ""))
    mine = F.lit(True) if max_file_mb is None else F.col("size") <= max_file_mb * 1e6
    a = listing.groupBy("folder").agg(F.count(F.when(mine, 1)).alias("n"), F.sum(F.when(mine, F.col("size"))).alias("bytes"), F.count("*").alias("all")).filter(F.col("n") >= min_files)
    todo = {r.folder: r for r in a.collect()}
    stats = {"folders": len(todo), "files_before": sum(r.n for r in todo.values()), "files_after": 0, "rows": 0}
    if not todo:
        return stats
    count = {k: target_files or max(1, math.ceil(r.bytes / (target_mb * 1e6))) for k, r in todo.items()}
    stats["files_after"] = sum(count.values())
    if dry_run:
        return stats
    first: dict[str, int] = {}
    total = 0
    for k in sorted(count):
        first[k] = total
        total += count[k]
    local = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    plan = small(spark.createDataFrame([(k, first[k], count[k]) for k in count], "_folder string, _first int, _count int").withColumn("_folder", local(F.col("_folder"))), len(count))  # one row a folder
    source = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*todo)
    if max_file_mb is not None:
        source = source.filter(F.col("_metadata.file_size") <= max_file_mb * 1e6)
    cols = list(source.columns)
    # Folders in the rows' metadata are escaped as addresses are.
    d = source.withColumn("_folder", local(F.url_decode(F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), r"/[^/]+$", ""), r"\+", "%2B")))).withColumn("_pos", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    d = d.join(plan, "_folder").withColumn("_file", F.col("_first") + F.pmod("_pos", F.col("_count")).cast("int"))
    keys = [c for c in sort_by or [] if c in cols]
    swap = Swap(spark, base)
    try:
        out = d.repartitionById(total, F.col("_file")).sortWithinPartitions("_file", *keys)
        out.select(*cols, "_file").write.partitionBy("_file").option("compression", "zstd").parquet(swap.staging)
        stats["rows"] = spark.read.parquet(swap.staging).count()
        due = source.count()
        if stats["rows"] != due:
            raise ValueError(f"{due} rows before compaction, {stats['rows']} after; nothing was changed")
        stamp = datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%dT%H")
        made: dict[int, list[str]] = {}
        for x in _data_files(spark, swap.staging):
            made.setdefault(int(re.search(r"_file=(\d+)", x)[1]), []).append(x)
        whole = {k for k, r in todo.items() if r.n == r["all"] and _inner(spark, k) == 0 and _plain(k) != _plain(base)}
        rest = small(spark.createDataFrame([(k,) for k in todo if k not in whole], "folder string"), len(todo))
        files: dict[str, list[str]] = {}
        if len(whole) < len(todo):
            for r in listing.filter(mine).join(rest, "folder").select("folder", "path").toLocalIterator():
                files.setdefault(r.folder, []).append(r.path)
        groups = []
        for k in sorted(count):
            rel = _plain(k)[len(_plain(base)) :].strip("/")
            old = [(k, f"{swap.old}/{rel}")] if k in whole else [(f, "/".join(x for x in (swap.old, rel, f.rsplit("/", 1)[-1]) if x)) for f in files[k]]
            new = [x for i in range(first[k], first[k] + count[k]) for x in made.get(i, [])]
            groups.append(old + [(x, f"{k}/part_{stamp}_{swap.tag}_{n}.parquet") for n, x in enumerate(new, first[k])])
    except Exception:
        swap.abandon()
        raise
    swap.make(groups)
    swap.finish()
    spark.catalog.refreshByPath(path)
    return stats


def _plain(path: str) -> str:
    """A path without the scheme of local files and doubled slashes, for comparison."""
    return re.sub(r"/+$", "", re.sub(r"^file:/+", "/", path))


def _inner(spark: SparkSession, folder: str) -> int:
    return len(fs.subdirs(spark, folder))


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    """Parquet files below a staging folder."""
    fsys, p = fs._fs(spark, folder)
    it, out = fsys.listFiles(p, True), []
    while it.hasNext():
        x = it.next().getPath().toString()
        if x.endswith(".parquet"):
            out.append(x)
    return sorted(out)


def migrate(spark: SparkSession, path: str, by: list[str], transform: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """Repartition in place: write beside, check, swap, and put the old folder back if reading the new one fails."""
    base, tag = path.rstrip("/"), uuid.uuid4().hex[:8]
    new, old = f"{base}_new_{tag}", f"{base}_old_{tag}"
    stats = repartition(spark, base, new, by, transform)
    fs.rename(spark, base, old)
    try:
        fs.rename(spark, new, base)
        if spark.read.parquet(base).count() != stats["rows"]:
            raise ValueError("the migrated dataset does not read back")
    except Exception:
        if fs.exists(spark, base):
            fs.rename(spark, base, new)
        fs.rename(spark, old, base)
        raise
    fs.delete(spark, old)
    return stats


def mismatches(spark: SparkSession, path: str, columns: list[str], quick: bool = False) -> DataFrame:
    """Files whose partition columns, as held in the file, differ from their path: path, column, in_path, in_file.

    Reads only those columns; with ``quick`` only of the first row group of each file.
    """
    none = "path string, column string, in_path string, in_file string"
    if quick:
        ship(spark)
        f = file_listing(spark, path).select("path").mapInArrow(_first_group(columns), "path string, column string, in_file string")
        f = f.select("path", "column", F.coalesce(*[F.when(F.col("column") == c, path_values(F.col("path"), c)[0]) for c in columns]).alias("in_path"), "in_file").distinct()
        return f.filter("in_path is not null and not (in_path <=> in_file)")
    d = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(path)
    have = [c for c in columns if c in d.columns]
    if not have:
        return spark.createDataFrame([], none)
    f = d.select(F.col("_metadata.file_path").alias("path"), *[F.col(c).cast("string").alias(c) for c in have]).distinct()
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), path_values(F.col("path"), c)[0].alias("in_path"), F.col(c).alias("in_file")) for c in have]))
    return f.select("path", pairs.alias("p")).select("path", "p.*").filter("in_path is not null and not (in_path <=> in_file)")


def _first_group(columns: list[str]):
    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        from tideframe.functions import workerfs

        for b in batches:
            out: dict[str, list] = {"path": [], "column": [], "in_file": []}
            for path in b.column(0).to_pylist():
                filesystem, at = workerfs.opened(path)
                with filesystem.open_input_file(at) as h:
                    f = pq.ParquetFile(h)
                    have = [c for c in columns if c in f.schema_arrow.names]
                    if not have or not f.num_row_groups:
                        continue
                    t = f.read_row_group(0, columns=have)
                for c in have:
                    for v in t[c].unique().to_pylist():
                        for k, x in zip(out, (path, c, None if v is None else str(v))):
                            out[k].append(x)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.string()) for k, v in out.items()})

    return run


def repair(spark: SparkSession, path: str, columns: list[str], dry_run: bool = False) -> int:
    """Normalise partition values held in files that do not match their path; gives the number of files rewritten."""
    bad = [r.path for r in mismatches(spark, path, columns).filter(F.translate("in_file", "/", "-") == F.col("in_path")).select("path").distinct().collect()]  # paths of files
    if dry_run or not bad:
        return len(bad)
    d = spark.read.option("recursiveFileLookup", "true").parquet(*bad)
    fixed = d.withColumns({c: partition_value(c) for c in columns if c in d.columns})
    local = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    number = small(spark.createDataFrame(list(enumerate(bad)), "_file int, _path string").withColumn("_path", local(F.col("_path"))), len(bad))
    fixed = fixed.withColumn("_path", local(F.col("_metadata.file_path"))).join(number, "_path").drop("_path")
    swap = Swap(spark, path)
    try:
        fixed.repartitionById(len(bad), F.col("_file")).write.partitionBy("_file").parquet(swap.staging)
        if spark.read.parquet(swap.staging).count() != d.count():
            raise ValueError("rows differ after the repair; nothing was changed")
        made = {int(re.search(r"_file=(\d+)", x)[1]): x for x in _data_files(spark, swap.staging)}
        groups = [[(old, f"{swap.old}/{i}/{old.rsplit('/', 1)[-1]}"), (made[i], old)] for i, old in enumerate(bad)]
    except Exception:
        swap.abandon()
        raise
    swap.make(groups)
    swap.finish()
    spark.catalog.refreshByPath(path)
    return len(bad)


@dataclass
class Report:
    checks: dict[str, bool] = field(default_factory=dict)
    details: dict[str, object] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return all(self.checks.values())


def validate(spark: SparkSession, path: str, columns: list[str], required: list[str] = (), name: str = FILE_NAME) -> Report:
    """Five checks: files there, partition columns in every path, names as expected, no two files of one name in different folders, required columns without nulls."""
    r = Report()
    files = file_listing(spark, path)
    r.details["files"] = n = files.count()
    r.checks["files"] = n > 0
    if not n:
        return r
    vals = files.select("name", *path_values(F.col("path"), *columns))
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    a = vals.agg(F.count(F.when(~whole, 1)), F.count(F.when(~F.col("name").rlike(f"^{name}$"), 1))).first()
    r.checks["partition_columns"], r.checks["names"] = a[0] == 0, a[1] == 0
    r.details["names_off"] = a[1]
    r.checks["collisions"] = (twice := files.groupBy("name").count().filter("count > 1").count()) == 0
    r.details["collisions"] = twice
    d = spark.read.option("mergeSchema", "true").parquet(path)
    nulls = d.agg(F.count("*"), *[F.count(F.when(F.col(c).isNull(), 1)) for c in required]).first()
    r.details["rows"] = nulls[0]
    r.checks["required"] = not any(nulls[1:])
    return r


def estimate(df: DataFrame, by: list[str], row_bytes: int = 1024) -> DataFrame:
    """Partitions, rows, rows a partition and MB at a size of one row."""
    p = df.groupBy(*[partition_value(c).alias(c) for c in by]).agg(F.count("*").alias("n"))
    return p.agg(F.count("*").alias("partitions"), F.sum("n").alias("total_rows"), F.avg("n").alias("avg_rows"), F.max("n").alias("max_rows"), (F.avg("n") * row_bytes / 1048576).alias("avg_mb"))


def backlog_health(files: DataFrame, now_ms: Column | int, warn_files: int = 20, max_files: int = 50, max_age_s: int = 600) -> DataFrame:
    """Count, bytes and age of the oldest of waiting files, with a status: ok, warning or critical."""
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    a = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.coalesce((now - F.min("modified_ms")) / 1000, F.lit(0.0)).alias("oldest_s"))
    return a.withColumn("status", F.when((F.col("files") > max_files) | (F.col("oldest_s") > max_age_s), "critical").when(F.col("files") > warn_files, "warning").otherwise(F.lit("ok")))
