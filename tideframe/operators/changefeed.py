"""Problem 2: a change feed kept as a log-structured merge tree of Parquet runs.

``append`` writes sorted runs: within a run only the last change of a key by sequence is kept
(combined on the map side, so a hot key costs one row a task), rows are hashed into buckets by key and
sorted by key and sequence. Runs of about one size are merged into one as soon as there are ``RUNS_PER_TIER`` of them, so that
their number grows with the logarithm of the data only. ``read`` merges the runs of a bucket k ways in bounded buffers and drops
tombstones; no rows are shuffled for it. ``compact`` writes the merge of all as one run.

A tombstone outlives every merge, so that a change delivered again after the removal of its key stays without effect. With
``redelivery_horizon_ms`` tombstones taken in longer ago than that are dropped when all runs are merged: the longest time
after which a change may still be delivered again.

Defined results: repeated changes have no effect; of changes of one key with the same sequence a removal
wins, then the greater payload; rows with a null in the key or the sequence cannot be ordered and take no part;
an empty feed gives an empty table.
"""

from __future__ import annotations

import json
import math
import time

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.functions import fs as files
from tideframe.functions import workerfs
from tideframe.session import ship

#: Runs of one size from which they are merged; each size is this many times the one before, the least holds runs of up to BASE_BYTES.
RUNS_PER_TIER, BASE_BYTES = 16, 4_000_000
#: Runs merged at once: a task holds a buffer of ``batch_rows`` rows of each.
FAN_IN = 64
#: A bucket larger than this is split in a merge of all runs.
BUCKET_BYTES = 256_000_000


def _kway(root: str, runs: list[str], schema: pa.Schema, payload: list[str], keep_from: int | None, rows: int):
    """A function that merges the sorted runs of each bucket it is given; tombstones taken in before ``keep_from`` go (None: all)."""

    def source(filesystem, folder):
        import pyarrow.parquet as pq

        for path in workerfs.data_files(filesystem, folder):
            with filesystem.open_input_file(path) as f:
                yield from pq.ParquetFile(f).iter_batches(batch_size=rows)

    def merge(batches):
        import numpy as np
        import pyarrow.compute as pc

        filesystem, base = workerfs.opened(root)
        plain = [n for n in payload if not pa.types.is_nested(schema.field(n).type)]
        order = [("_k", "ascending"), *[(c, "descending") for c in ("_seq", "_gone", *plain)]]
        for batch in batches:
            for bucket in batch.column(0).to_pylist():
                feeds = [source(filesystem, f"{base}/{r}/_b={bucket}") for r in runs]
                heads: list = [None] * len(feeds)
                while True:
                    for i, f in enumerate(feeds):
                        if f is not None and (heads[i] is None or not heads[i].num_rows):
                            b = next(f, None)
                            heads[i], feeds[i] = (None, None) if b is None else (pa.Table.from_batches([b]).select(schema.names).cast(schema), f)
                    live = [i for i, h in enumerate(heads) if h is not None and h.num_rows]
                    if not live:
                        break
                    # Keys up to the least last key in the buffers are complete: no run holds more of them.
                    bound = min((heads[i]["_k"][-1].as_py() for i in live if feeds[i] is not None), default=None)
                    parts = []
                    for i in live:
                        n = heads[i].num_rows if bound is None else pc.sum(pc.less_equal(heads[i]["_k"], bound)).as_py() or 0
                        parts.append(heads[i].slice(0, n))
                        heads[i] = heads[i].slice(n)
                    t = pa.concat_tables(parts).sort_by(order)
                    k = t["_k"].combine_chunks()
                    first = np.ones(len(k), bool)
                    if len(k) > 1:
                        first[1:] = pc.not_equal(k.slice(1), k.slice(0, len(k) - 1)).to_numpy(zero_copy_only=False)
                    gone = t["_gone"].to_numpy()
                    first &= ~gone if keep_from is None else ~gone | (t["_at"].to_numpy() >= keep_from)
                    yield from t.filter(pa.array(first)).to_batches()

    return merge


class ChangeTable:
    """The current state of a keyed table under a stream of changes, at a path all executors can reach."""

    def __init__(self, spark: SparkSession, root: str, key: list[str], payload: list[str], buckets: int = 16, batch_rows: int = 65_536, redelivery_horizon_ms: int | None = None):
        self.spark, self.root, self.key, self.payload, self.batch_rows, self.redelivery_horizon_ms = spark, root.rstrip("/"), key, payload, batch_rows, redelivery_horizon_ms
        at = f"{self.root}/_manifest.json"
        self.state = json.loads(files.read_text(spark, at)) if files.has_text(spark, at) else {"buckets": buckets, "runs": [], "next": 0, "schema": None}

    def _save(self) -> None:
        files.write_text(self.spark, f"{self.root}/_manifest.json", json.dumps(self.state))

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64("_k"), F.lit(n)).cast("int")

    def append(self, changes: DataFrame, sequence: Column, removed: Column, run_of: Column | None = None, now_ms: int | None = None) -> None:
        """Add the changes as one run, or as one run for each value of ``run_of`` (a bounded number of arrival periods)."""
        run = F.coalesce(run_of, F.lit(0)).cast("long") if run_of is not None else F.lit(0).cast("long")
        rows = changes.select(*self.key, *self.payload, sequence.cast("long").alias("_seq"), F.coalesce(removed, F.lit(False)).alias("_gone"), run.alias("_r"))
        ok = F.col("_seq").isNotNull()
        for c in self.key:
            ok = ok & F.col(c).isNotNull()
        last = F.max(F.struct("_seq", "_gone", *self.payload)).alias("_v")
        key = F.concat_ws("\x01", *[F.col(c).cast("string") for c in self.key])
        n = self.state["buckets"]
        reduced = (
            rows.filter(ok).groupBy(*self.key, "_r").agg(last)
            .select(*self.key, *[F.col(f"_v.{c}").alias(c) for c in self.payload], F.col("_v._seq").alias("_seq"), F.col("_v._gone").alias("_gone"), key.alias("_k"), "_r")
            .select("*", F.lit(int(time.time() * 1000) if now_ms is None else now_ms).cast("long").alias("_at"), self._bucket(n).alias("_b"))
        )
        self.state["schema"] = json.loads(reduced.drop("_r", "_b").schema.json())
        batch = f"a{self.state['next']:06d}"
        (reduced.repartitionById(n, F.col("_b")).sortWithinPartitions("_r", "_b", "_k", "_seq")
         .write.mode("overwrite").option("compression", "zstd").partitionBy("_r", "_b").parquet(f"{self.root}/{batch}"))
        sizes = {f"{batch}/{d}": 0 for d in files.subdirs(self.spark, f"{self.root}/{batch}")}
        for f in files.files(self.spark, f"{self.root}/{batch}"):
            sizes["/".join(f.path.rsplit("/", 4)[1:3])] += f.size
        self.state["runs"] += [{"at": r, "bytes": b} for r, b in sizes.items()]
        self.state["next"] += 1
        self._save()
        self._tidy(now_ms)

    def _merged(self, runs: list[dict], keep_from: int | None) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = T.StructType.fromJson(self.state["schema"])
        ship(self.spark)
        n = self.state["buckets"]
        ids = self.spark.range(0, n, 1, n)
        return ids.mapInArrow(_kway(self.root, [r["at"] for r in runs], to_arrow_schema(schema), self.payload, keep_from, self.batch_rows), schema)

    def read(self) -> DataFrame:
        """Every key that stands, with its payload and ``_seq``, the sequence of the deciding change."""
        return self._merged(self.state["runs"], None).select(*self.key, *self.payload, "_seq")

    def _tidy(self, now_ms: int | None = None) -> None:
        """Merge runs of one size while there are too many of them, the small ones first; then split buckets that have grown too large."""
        while True:
            tiers: dict[int, list] = {}
            for r in self.state["runs"]:
                tiers.setdefault(max(0, int(math.log(max(r["bytes"], 1) / BASE_BYTES, RUNS_PER_TIER)) + 1) if r["bytes"] > BASE_BYTES else 0, []).append(r)
            full = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= RUNS_PER_TIER), None)
            if full is None:
                break
            self._replace(full[:FAN_IN], self.state["buckets"], now_ms)
        total = sum(r["bytes"] for r in self.state["runs"])
        if total > 2 * BUCKET_BYTES * self.state["buckets"]:
            self.compact(-(-total // BUCKET_BYTES), now_ms)

    def _replace(self, runs: list[dict], buckets: int, now_ms: int | None) -> None:
        """Put one run in the place of several. Tombstones stay unless these are all runs and the horizon has passed them."""
        whole = len(runs) == len(self.state["runs"])
        now = int(time.time() * 1000) if now_ms is None else now_ms
        keep = now - self.redelivery_horizon_ms if whole and self.redelivery_horizon_ms is not None else -(1 << 62)
        batch = f"c{self.state['next']:06d}"
        out = self._merged(runs, keep).withColumn("_b", self._bucket(buckets))
        if buckets != self.state["buckets"]:
            out = out.repartitionById(buckets, F.col("_b"))
        out.sortWithinPartitions("_b", "_k").write.mode("overwrite").option("compression", "zstd").partitionBy("_b").parquet(f"{self.root}/{batch}")
        size = sum(f.size for f in files.files(self.spark, f"{self.root}/{batch}"))
        gone = {r["at"] for r in runs}
        self.state["runs"] = [r for r in self.state["runs"] if r["at"] not in gone] + [{"at": batch, "bytes": size}]
        self.state["next"] += 1
        self.state["buckets"] = buckets
        self._save()
        for r in gone:
            files.delete(self.spark, f"{self.root}/{r}")

    def compact(self, buckets: int | None = None, now_ms: int | None = None) -> None:
        """Replace all runs by their merge, in ``buckets`` buckets if they are to change."""
        if self.state["runs"]:
            self._replace(list(self.state["runs"]), buckets or self.state["buckets"], now_ms)

    @property
    def runs(self) -> int:
        return len(self.state["runs"])
