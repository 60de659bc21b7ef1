"""Problem 1: rows delivered more than once, removed by deletion vectors.

Only the identifier, the delivery order and the row's position in its file are shuffled. One
winner is selected for each identifier that occurs more than once; the positions of all its other
rows become deletion vectors, 64 rows of a file to a word. The wide payload is then read once and
filtered in place, without a shuffle.

Defined results: a row with a null in any identifier column is no copy of anything and is kept;
of equal delivery orders the row earliest by file path and row number wins; an empty table gives an
empty table; payload columns are passed through whatever their names (the operator's own columns
carry the prefix ``_tf_`` and are dropped).
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.functions import workerfs
from tideframe.session import BROADCAST_LIMIT, materialise, scratch, ship

_POS = ["_tf_file", "_tf_row"]
#: One vector covers this many rows, the bits of a long.
WORD = 64
#: Vectors kept in files are spread over this many directories by their file's name.
FILE_BUCKETS = 256


@dataclass
class DeletionVectors:
    """Positions to leave out: one row (file, word number, mask) for 64 rows with at least one deletion."""

    words: DataFrame
    n_words: int
    rows: DataFrame
    path: str | None = None

    @property
    def bytes(self) -> int:
        return self.n_words * 192


def scan(spark: SparkSession, path: str, **columns: Column) -> DataFrame:
    """The named expressions over a Parquet table with each row's file and row number."""
    return spark.read.parquet(path).select(
        *[c.alias(n) for n, c in columns.items()],
        F.col("_metadata.file_path").alias("_tf_file"),
        F.col("_metadata.row_index").alias("_tf_row"),
    )


def find_copies(spark: SparkSession, path: str, key: dict[str, Column], order: list[Column], limit: int = BROADCAST_LIMIT) -> DeletionVectors:
    """Deletion vectors of every row that is not the first delivery of its identifier.

    A hot identifier is combined on the map side, down to one candidate a task; finding its other rows
    is a join of the narrow scan with unique identifiers, whose large side may be split freely.
    """
    names = [f"_tf_k{i}" for i in range(len(key))]
    cols = dict(zip(names, key.values())) | {f"_tf_o{i}": c for i, c in enumerate(order)}
    narrow = scan(spark, path, **cols)
    for n in names:
        narrow = narrow.filter(F.col(n).isNotNull())
    first = F.min(F.struct(*[f"_tf_o{i}" for i in range(len(order))], *_POS)).alias("_tf_w")
    repeated = materialise(
        narrow.groupBy(*names).agg(first, F.count("*").alias("_tf_n")).filter("_tf_n > 1")
        .select(*names, F.col("_tf_w._tf_file").alias("_tf_wf"), F.col("_tf_w._tf_row").alias("_tf_wr")),
        "copies",
    )
    n = repeated.count()
    side = F.broadcast(repeated) if n * 256 <= limit else repeated
    losers = materialise(
        narrow.join(side, names).filter(~((F.col("_tf_file") == F.col("_tf_wf")) & (F.col("_tf_row") == F.col("_tf_wr")))).select(*names, *_POS),
        "losers",
    )
    words = materialise(
        losers.groupBy("_tf_file", F.expr(f"_tf_row div {WORD}").alias("_tf_word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(_tf_row % {WORD} as int))")).alias("_tf_mask")),
        "vectors",
    )
    return DeletionVectors(words, words.count(), losers.select(*[F.col(a).alias(b) for a, b in zip(names, key)], *_POS))


def _stored(spark: SparkSession, dv: DeletionVectors) -> str:
    """The vectors as files a scan task can look up by the name of the file it reads."""
    if dv.path is None:
        dv.path = scratch(spark, "vector-files")
        b = F.pmod(F.crc32(F.col("_tf_file")), F.lit(FILE_BUCKETS)).alias("_tf_b")
        (dv.words.select("*", b).repartition("_tf_b").sortWithinPartitions("_tf_b", "_tf_file").write.partitionBy("_tf_b").parquet(dv.path))
    return dv.path


def _filter_batches(root: str, deleted: bool):
    def run(batches):
        import zlib

        import numpy as np
        import pyarrow.dataset as ds
        from pyarrow import fs

        held: dict[str, tuple] = {}

        def of(file: str):
            if file not in held:
                held.clear()  # a task reads its files one after another
                filesystem, base = workerfs.opened(root)
                p = f"{base}/_tf_b={zlib.crc32(file.encode()) % FILE_BUCKETS}"
                if filesystem.get_file_info(p).type == fs.FileType.NotFound:
                    held[file] = (np.empty(0, "i8"), np.empty(0, "i8"))
                else:
                    t = ds.dataset(p, filesystem=filesystem, format="parquet").to_table(columns=["_tf_word", "_tf_mask"], filter=ds.field("_tf_file") == file)
                    w, m = t["_tf_word"].to_numpy(), t["_tf_mask"].to_numpy()
                    o = np.argsort(w)
                    held[file] = (w[o], m[o])
            return held[file]

        for b in batches:
            files, rows = b.column("_tf_file").to_pylist(), b.column("_tf_row").to_numpy(zero_copy_only=False)
            drop = np.zeros(len(rows), bool)
            names = np.array(files, dtype=object)
            for f in dict.fromkeys(files):
                w, m = of(f)
                if len(w):
                    at = np.flatnonzero(names == f)
                    i = np.minimum(np.searchsorted(w, rows[at] // WORD), len(w) - 1)
                    drop[at] = (w[i] == rows[at] // WORD) & ((m[i] >> (rows[at] % WORD)) & 1 == 1)
            yield b.filter(pa.array(drop if deleted else ~drop))

    return run


def apply_vectors(spark: SparkSession, path: str, dv: DeletionVectors, columns: list[str] | None = None, deleted: bool = False, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The table without (or, with ``deleted``, only) the rows the vectors delete; wide rows stay where they are read.

    Vectors of a counted size within ``limit`` are broadcast and tested inside the scan's own stage;
    beyond that every task reads the vectors of its own files from the shared folder.
    """
    df = spark.read.parquet(path)
    wide = df.select(*(columns or df.columns), F.col("_metadata.file_path").alias("_tf_file"), F.col("_metadata.row_index").alias("_tf_row"))
    if dv.bytes > limit:
        ship(spark)
        return wide.mapInArrow(_filter_batches(_stored(spark, dv), deleted), wide.schema).drop(*_POS)
    hit = F.coalesce(F.expr(f"getbit(_tf_mask, cast(_tf_row % {WORD} as int))") == 1, F.lit(False))
    joined = wide.withColumn("_tf_word", F.expr(f"_tf_row div {WORD}")).join(F.broadcast(dv.words), ["_tf_file", "_tf_word"], "left")
    return joined.filter(hit if deleted else ~hit).drop("_tf_word", "_tf_mask", *_POS)


def drop_copies(spark: SparkSession, path: str, key: dict[str, Column], order: list[Column], limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Exactly one row of each identifier, and every row without one."""
    return apply_vectors(spark, path, find_copies(spark, path, key, order, limit), limit=limit)
