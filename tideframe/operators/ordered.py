"""Scans in key and time order whose partitions may cut a key anywhere.

The rows are range-partitioned by key, time and identifier, so that one hot key fills as many partitions as
its rows need, and written in that order. A scan then works through every partition on its own, given what lies just
before and just after it. What that is, each partition tells in one short record; only these
records, one a partition, come to the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.functions import workerfs
from tideframe.session import scratch, ship


#: Rows a partition holds at most, about, where their number is known.
ROWS_PER_PARTITION = 500_000


class OrderedTable:
    """``rows`` is the number of rows of ``df`` if it is known: a task then holds a bounded number, whatever the session's setting."""

    def __init__(self, df: DataFrame, by: list[str], partitions: int | None = None, rows: int = 0):
        self.spark = df.sparkSession
        ship(self.spark)
        self.partitions = partitions or max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PARTITION))
        self.path = scratch(self.spark, "ordered")
        (df.repartitionByRange(self.partitions, *by).sortWithinPartitions(*by).withColumn("_p", F.spark_partition_id())
         .write.partitionBy("_p").parquet(self.path))

    def scan(self, fn: Callable[[pa.Table, object], pa.Table], schema: T.StructType, context: dict[int, object] | None = None) -> DataFrame:
        """``fn(rows of a partition in order, context[partition])`` for every partition that has rows."""
        path, n, ctx = self.path, self.partitions, self.spark.sparkContext.broadcast(context or {})

        def run(batches):
            import pyarrow.parquet as pq

            filesystem, base = workerfs.opened(path)
            for b in batches:
                for p in b.column(0).to_pylist():
                    names = workerfs.data_files(filesystem, f"{base}/_p={p}")  # parts of one task are numbered in order
                    if names:
                        t = pa.concat_tables([pq.read_table(x, filesystem=filesystem, partitioning=None) for x in names])
                        yield from fn(t, ctx.value.get(p)).combine_chunks().to_batches()

        return self.spark.range(0, n, 1, n).mapInArrow(run, schema)

    def edges(self, fn: Callable[[pa.Table], dict]) -> dict[int, dict]:
        """``fn`` of each partition that has rows; its result, a few hundred bytes, as JSON."""
        path, n = self.path, self.partitions

        def run(batches):
            import pyarrow.parquet as pq

            filesystem, base = workerfs.opened(path)
            for b in batches:
                for p in b.column(0).to_pylist():
                    names = workerfs.data_files(filesystem, f"{base}/_p={p}")
                    if names:
                        t = pa.concat_tables([pq.read_table(x, filesystem=filesystem, partitioning=None) for x in names])
                        yield pa.RecordBatch.from_pydict({"p": [p], "e": [json.dumps(fn(t))]}, schema=pa.schema([("p", pa.int32()), ("e", pa.string())]))

        schema = T.StructType([T.StructField("p", T.IntegerType()), T.StructField("e", T.StringType())])
        return {r.p: json.loads(r.e) for r in self.spark.range(0, n, 1, n).mapInArrow(run, schema).collect()}
