"""Sources: NDJSON segments, Parquet datasets, and lists of files.

A segment's lines keep their place, (file name, line position), as ``_file`` and ``_line``: the order of arrival. Lines that do
not parse are counted and set aside, blank lines skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.functions import fs
from tideframe.functions.normal import once

#: Fixed value: how closed segments are named.
SEGMENT = r"segment_(\d{8})T(\d{2})_(\d+)\.ndjson"


def segments(spark: SparkSession, folder: str, start: str | None = None, end: str | None = None) -> list[str]:
    """Closed segments in name order, pruned by the date in their names (YYYY-MM-DD, inclusive; ``end`` defaults to ``start``).

    A name without a date counts as today's.
    """
    import datetime
    import re

    out = []
    for f in fs.files(spark, folder, ".ndjson"):
        name = f.path.rsplit("/", 1)[-1]
        if start is not None:
            m = re.fullmatch(SEGMENT, name)
            d = m[1] if m else datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%d")
            if not start.replace("-", "") <= d <= (end or start).replace("-", ""):
                continue
        out.append((f.path.rsplit("/", 1)[-1], f.path))
    return [p for _, p in sorted(out)]


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """value, _file and _line of each line that is not blank."""
    d = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    return d.filter(F.trim("value") != "").select("value", "_file", F.struct("_block", "_row").alias("_line"))


def parse_json(lines: DataFrame, schema: T.StructType, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """The parsed lines, as the schema's columns beside the others, and the lines that do not parse as an object."""
    bad = "_bad"
    full = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    j = lines.select("*", once(F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})).alias("_j"))
    ok = F.col("_j").isNotNull() & F.col(f"_j.{bad}").isNull() & F.trim(text).startswith("{")
    rest = [c for c in lines.columns if c != text]
    return j.filter(ok).select(*rest, *[F.col(f"_j.{f.name}").alias(f.name) for f in schema.fields]), j.filter(~F.coalesce(ok, F.lit(False))).select(*lines.columns)


def read_ndjson(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    return parse_json(read_lines(spark, paths), schema)


def read_dataset(spark: SparkSession, path: str | list[str], columns: list[str] | None = None, where: Column | None = None, merge: bool = True) -> DataFrame:
    """A Parquet dataset (folder, file or glob) whose files may differ in columns; filters and columns reach the scan."""
    d = spark.read.option("mergeSchema", str(merge).lower()).parquet(*([path] if isinstance(path, str) else path))
    if where is not None:
        d = d.filter(where)
    return d.select(*columns) if columns else d


def read_files_recursive(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """All files below a folder that match a name pattern, whatever folders they lie in."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(path)


def file_listing(spark: SparkSession, path: str, suffix: str = ".parquet") -> DataFrame:
    """path, name, size and modified_ms of each data file below a folder; many folders are listed by many tasks, and no name comes to the driver's Python."""
    if not fs.exists(spark, path):
        return spark.createDataFrame([], "path string, name string, size long, modified_ms long")
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return d.filter(F.col("path").endswith(suffix)).select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"), F.unix_millis("modificationTime").alias("modified_ms"))


def path_values(path: Column, *names: str) -> list[Column]:
    """Hive partition values in a path, as columns of those names; null where there is none."""
    return [F.nullif(F.regexp_extract(path, rf"(?:^|/){n}=([^/]+)", 1), F.lit("")).alias(n) for n in names]
