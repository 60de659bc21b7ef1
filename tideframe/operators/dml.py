"""DELETE, UPDATE and UPSERT on partitioned Parquet datasets.

New content of the touched partitions is written beside the dataset, counted by partition, and swapped in folder by folder (``functions.swap``:
a failure takes every move back, an interruption is taken back by ``recover``), then counted again as a reader finds it. With
``isolate`` a partition whose folders cannot be moved keeps its old content and is told in ``Stats.failed``; the others are changed.
Old folders move to the backup, or are deleted at the end. Folders are found by the values their names stand for,
whatever is escaped in them; the values are read as they stand, so ``01`` is not 1.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.functions import fs
from tideframe.functions.swap import MARKER, Swap, recover  # noqa: F401
from tideframe.session import small
from tideframe.sources.sinks import partition_value

#: Partitions named one by one in a filter; more are found by a join with their table.
NAMED = 64
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _unescape(name: str) -> str:
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


@dataclass
class Stats:
    rows_before: int = 0
    rows_after: int = 0
    rows_deleted: int = 0
    rows_updated: int = 0
    rows_inserted: int = 0
    partitions: int = 0
    dry_run: bool = False
    failed: list = field(default_factory=list)


class Dataset:
    """A dataset at ``path``, partitioned by ``partition_by`` (Hive folders; empty for a flat one)."""

    def __init__(self, spark: SparkSession, path: str, partition_by: list[str] | None = None, compression: str = "zstd", backup: str | None = None, isolate: bool = False):
        self.spark, self.path, self.parts, self.compression, self.backup, self.isolate = spark, path.rstrip("/"), partition_by or [], compression, backup, isolate

    def read(self) -> DataFrame:
        d = self.spark.read.option("mergeSchema", "true").parquet(self.path)
        if not self.parts:
            return d
        schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in self.parts else f for f in d.schema.fields])
        return self.spark.read.schema(schema).parquet(self.path)

    def _within(self, df: DataFrame, only: dict[str, str] | None) -> DataFrame:
        """Rows of the partitions with these values; any subset of the partition columns may be given."""
        unknown = set(only or {}) - set(self.parts)
        if unknown:
            raise ValueError(f"not partition columns: {sorted(unknown)}")
        for c, v in (only or {}).items():
            df = df.filter(F.col(c) == str(v).replace("/", "-"))
        return df

    def _folders(self, root: str) -> dict[tuple, list[str]]:
        """The partition folders below ``root`` by their values, relative to it."""
        rels = [""]
        for _ in self.parts:
            rels = [f"{r}/{n}" if r else n for r in rels for n in fs.subdirs(self.spark, f"{root}/{r}" if r else root) if "=" in n]
        out = defaultdict(list)
        for r in rels:
            v = dict(map(_unescape, n.split("=", 1)) for n in r.split("/"))
            out[tuple(None if v[c] == NULL_FOLDER else v[c] for c in self.parts)].append(r)
        return out

    def _counts(self, df: DataFrame) -> dict[tuple, int]:
        """Rows of each partition."""
        return {tuple(r[c] for c in self.parts): r["_n"] for r in df.groupBy(*self.parts).agg(F.count("*").alias("_n")).collect()}

    def _replace(self, content: DataFrame, touched: list, rows: int) -> list[tuple]:
        """Swap the touched partitions (one row each) for their part of ``content``, which has so many rows; partitions without rows go. Gives those that failed."""
        swap = Swap(self.spark, self.path, self.backup)
        try:
            # Rows of a partition are brought together; one of very many rows is spread over tasks and files.
            out = content.hint("rebalance", *[F.col(c) for c in self.parts]) if self.parts else content
            w = out.write.mode("overwrite").option("compression", self.compression)
            (w.partitionBy(*self.parts) if self.parts else w).parquet(swap.staging)
            counts = self._counts(self.spark.read.schema(content.schema).parquet(swap.staging)) if _staged(self.spark, swap.staging) else {}
            staged = sum(counts.values())
            if staged != rows:
                raise RuntimeError(f"{self.path}: {staged} rows were staged, {rows} are due; nothing was changed")
            groups, values = [], [()]
            if self.parts:
                values = [tuple(r[c] for c in self.parts) for r in touched]
                before, after = self._folders(self.path), self._folders(swap.staging)
                lost = [v for v in values if v not in before and v not in after] + [v for v in after if v not in set(values)]
                if lost:
                    raise RuntimeError(f"{self.path}: no folder where one is due, or one too many: {lost[:5]}; nothing was changed")
                groups = [[*[(f"{self.path}/{r}", f"{swap.old}/{r}") for r in before.get(v, [])], *[(f"{swap.staging}/{r}", f"{self.path}/{r}") for r in after.get(v, [])]] for v in values]
            else:
                name = lambda p: p.rsplit("/", 1)[-1]
                groups = [[*[(f.path, f"{swap.old}/{name(f.path)}") for f in fs.files(self.spark, self.path)], *[(f, f"{self.path}/{name(f)}") for f in _staged(self.spark, swap.staging)]]]
        except Exception:
            swap.abandon()
            raise
        failed = [values[i] for i in swap.make(groups, self.isolate)]
        self.spark.catalog.refreshByPath(self.path)
        try:
            found = self._counts(self._in(self.read(), touched)) if not self.parts or self._folders(self.path) else {}
            wrong = [v for v in values if v not in set(failed) and found.get(v, 0) != counts.get(v, 0)]
            if wrong:
                raise RuntimeError(f"{self.path}: other rows after the swap than are due in {wrong[:5]}; nothing was changed")
        except Exception:
            swap.undo()
            self.spark.catalog.refreshByPath(self.path)
            raise
        swap.finish()
        return failed

    def _touched(self, df: DataFrame) -> DataFrame:
        return df.select(*self.parts).distinct() if self.parts else df.limit(1)

    def delete(self, where: Column, only: dict[str, str] | None = None, dry_run: bool = False) -> Stats:
        """Keep the rows for which ``where`` is false; rows for which it is null go as well."""
        gone = ~F.coalesce(~where, F.lit(False))
        df = self._within(self.read(), only)
        hit = self._touched(df.filter(gone))
        n = df.agg(F.count("*"), F.count(F.when(gone, 1))).first()
        s = Stats(rows_before=n[0], rows_deleted=n[1], rows_after=n[0] - n[1], partitions=hit.count() if n[1] else 0, dry_run=dry_run)
        if n[1] and not dry_run:
            rows = hit.collect() if self.parts else []
            mine = self._in(df, rows)
            s.failed = self._replace(mine.filter(~where), rows, mine.count() - n[1])
        return s

    def _in(self, df: DataFrame, rows: list) -> DataFrame:
        """Rows of the listed partitions, by a filter or a join that prunes folders."""
        if not self.parts:
            return df
        if not rows:
            return df.filter(F.lit(False))
        values = [tuple(r[c] for c in self.parts) for r in rows]
        if len(values) > NAMED:
            # Plain equality lets the scan skip folders by the table's values; partitions of a null value are met beside it.
            whole, part = [v for v in values if None not in v], [v for v in values if None in v]
            names = [f"_t{i}" for i in range(len(self.parts))]
            table = lambda v: small(self.spark.createDataFrame(v, ", ".join(f"{n} string" for n in names)), len(v))
            # The scan skips folders only for a table under a condition; this one is true of all.
            out = df.join(table(whole).filter("_t0 >= ''"), [F.col(c) == F.col(n) for c, n in zip(self.parts, names)], "left_semi")
            some = F.lit(False)
            for c in self.parts:
                some = some | F.col(c).isNull()
            return out.unionByName(df.filter(some).join(table(part), [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(self.parts, names)], "left_semi")) if part else out
        conds = []
        for v in values:
            c = F.lit(True)
            for n, x in zip(self.parts, v):
                c = c & F.col(n).eqNullSafe(F.lit(x))
            conds.append(c)
        while len(conds) > 1:  # a balanced tree keeps the plan shallow
            conds = [conds[i] | conds[i + 1] if i + 1 < len(conds) else conds[i] for i in range(0, len(conds), 2)]
        return df.filter(conds[0])

    def update(self, where: Column, values: dict[str, Column | object], only: dict[str, str] | None = None, dry_run: bool = False) -> Stats:
        """Set columns where ``where`` holds, in the order given; each sees the columns set before it, in ``where`` too."""
        df = self._within(self.read(), only)
        missing = [c for c in values if c not in df.columns]
        if missing:
            raise ValueError(f"no such columns: {missing}")
        hit = self._touched(df.filter(where))
        n = df.agg(F.count("*"), F.count(F.when(where, 1))).first()
        s = Stats(rows_before=n[0], rows_after=n[0], rows_updated=n[1], partitions=hit.count() if n[1] else 0, dry_run=dry_run)
        if n[1] and not dry_run:
            rows = hit.collect() if self.parts else []
            mine = self._in(df, rows)
            s.failed = self._replace(set_columns(mine, where, values), rows, mine.count())
        return s

    def upsert(self, new: DataFrame, keys: list[str], update_cols: list[str] | None = None, dry_run: bool = False) -> Stats:
        """Merge rows by key within their partition: a null never overwrites, unknown keys are inserted. Repeated keys in ``new`` count once, the last by all columns."""
        missing = [c for c in (*keys, *self.parts) if c not in new.columns]
        if missing:
            raise ValueError(f"new rows lack columns: {missing}")
        new = new.withColumns({c: F.nullif(partition_value(c), F.lit("")) for c in self.parts})  # an empty value has the folder of null
        empty = not fs.files(self.spark, self.path)
        old = new.limit(0) if empty else self.read()
        on = [*keys, *self.parts]
        hit = new.select(*self.parts).distinct() if self.parts else new.limit(1)
        rows = hit.collect() if self.parts else []
        mine = self._in(old, rows)
        merged = merge_rows(mine, new, on, update_cols)
        k_old, k_new = mine.select(*on), new.select(*on).distinct()
        before, fresh = mine.count(), k_new.join(k_old, on, "left_anti").count()
        changed = k_old.join(k_new, on, "left_semi").count()
        s = Stats(rows_before=before, rows_after=before + fresh, rows_updated=changed, rows_inserted=fresh, partitions=len(rows) if self.parts else 1, dry_run=dry_run)
        if not dry_run and (changed or fresh):
            if empty:
                fs.mkdirs(self.spark, self.path)
            s.failed = self._replace(merged, rows, before + fresh)
        return s

    def deduplicate(self, keys: list[str], order: list[Column], only: dict[str, str] | None = None) -> Stats:
        """Keep the first row of each key by ``order``."""
        df = self._within(self.read(), only)
        kept = first_by(df, keys, order)
        n, m = df.count(), kept.count()
        if n > m:
            rows = self._touched(df).collect() if self.parts else []
            self._replace(kept, rows, m)
        return Stats(rows_before=n, rows_after=m, rows_deleted=n - m)


def _staged(spark: SparkSession, path: str) -> list[str]:
    f, p = fs._fs(spark, path)
    it, out = f.listFiles(p, True), []
    while it.hasNext():
        x = it.next().getPath().toString()
        if x.endswith(".parquet"):
            out.append(x)
    return sorted(out)


def set_columns(df: DataFrame, where: Column, values: dict[str, Column | object]) -> DataFrame:
    for c, v in values.items():
        df = df.withColumn(c, F.when(where, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)))
    return df


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first by ``order``; combined on the map side, so a hot key is no hot task. Null keys are one key."""
    rest = [c for c in df.columns if c not in keys]
    o = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    v = F.min(F.struct(*o, *rest)).alias("_v")
    return df.groupBy(*keys).agg(v).select(*[F.col(c) if c in keys else F.col(f"_v.{c}").alias(c) for c in df.columns])


def merge_rows(old: DataFrame, new: DataFrame, on: list[str], update_cols: list[str] | None = None) -> DataFrame:
    """``old`` with the values of ``new`` where keys meet and the new value is not null, and the rows of ``new`` whose keys are new."""
    cols = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    take = [c for c in (update_cols or new.columns) if c in new.columns and c not in on]
    rest = [c for c in new.columns if c not in on]
    one = new.groupBy(*on).agg(F.max(F.struct(*rest)).alias("_v")) if rest else new.select(*on).distinct().withColumn("_v", F.struct(F.lit(0).alias("_")))
    j = old.withColumn("_there", F.lit(True)).join(one, on, "full_outer")

    def value(c: str) -> Column:
        mine = F.col(c) if c in old.columns else F.lit(None)
        theirs = F.col(f"_v.{c}") if c in rest else None
        if c in on or theirs is None:
            return F.col(c) if c in on or c in old.columns else F.lit(None)
        on_match = F.coalesce(theirs, mine) if c in take else mine
        return F.when(F.col("_there"), on_match).otherwise(theirs)

    return j.select(*[value(c).alias(c) for c in cols])
