"""Sinks: partitioned and flat datasets, several outputs of one plan, typed landing tables, NDJSON segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.functions import fs


def partition_value(c: str):
    """The form in which a value stands in paths: ``/`` becomes ``-``; a missing one reads back as null."""
    return F.translate(F.col(c).cast("string"), "/", "-")


def write_dataset(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "append", keep_columns: bool = False, max_records: int = 0, compression: str = "zstd") -> bool:
    """Append to a dataset, one file for each partition and task with rows; an empty frame writes nothing and gives False.

    Partition values are normalised, in the data too. With ``keep_columns`` the files hold the partition columns as well, under
    their own names, for readers that open single files. Rows are brought together by partition, but a hot partition is
    spread over several tasks by the rebalancing of the shuffle.
    """
    parts = partition_by or []
    missing = [c for c in parts if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns to partition by: {missing}")
    if df.isEmpty():
        return False
    out = df.withColumns({c: partition_value(c) for c in parts}) if parts else df
    if parts:
        out = out.hint("rebalance", *[F.col(c) for c in parts])
    if keep_columns and parts:
        return _write_kept(out, path, parts, compression)
    w = out.write.mode(mode).option("compression", compression)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    (w.partitionBy(*parts) if parts else w).parquet(path)
    return True


def _write_kept(df: DataFrame, path: str, parts: list[str], compression: str) -> bool:
    """Write below shadow names, then move the files to folders of the real names."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}/_staging_kept"
    shadow = {f"_p_{c}": F.col(c) for c in parts}
    df.withColumns(shadow).write.mode("overwrite").option("compression", compression).partitionBy(*shadow).parquet(staging)
    fsys, root = fs._fs(spark, staging)
    it, names = fsys.listFiles(root, True), []
    while it.hasNext():
        p = it.next().getPath().toString()
        if p.endswith(".parquet"):
            names.append(p)
    base = fsys.makeQualified(root).toString()
    for p in names:
        fs.rename(spark, p, f"{path.rstrip('/')}/{p[len(base) + 1 :].replace('_p_', '')}")
    fs.delete(spark, staging)
    return True


def write_outputs(outputs: dict[str, DataFrame], root: str, partition_by: dict[str, list[str]] | None = None) -> dict[str, bool]:
    """Each named frame to its own dataset below ``root``; frames of one parsed source should share a cached or written parent."""
    return {n: write_dataset(d, f"{root.rstrip('/')}/{n}", (partition_by or {}).get(n)) for n, d in outputs.items()}


def write_segments(df: DataFrame, path: str, max_records: int = 1_000_000) -> None:
    """Rows as NDJSON lines in files of bounded size."""
    df.write.mode("append").option("maxRecordsPerFile", max_records).json(path)


def _segment_writer(folder: str, limit: int):
    """Writes the lines a task is given to files of at most ``limit`` bytes each (a longer line has a file of its own), one hour to a file."""

    def run(batches):
        import uuid

        import pyarrow as pa

        from tideframe.functions import workerfs

        filesystem, base = workerfs.opened(folder)
        filesystem.create_dir(base, recursive=True)
        out, size, lines, hour, path, done = None, 0, 0, None, "", []

        def close():
            if out is not None:
                out.close()
                done.append((hour, path, size, lines))

        for b in batches:
            for h, text in zip(b.column("hour").to_pylist(), b.column("value").to_pylist()):
                line = text.encode() + b"\n"
                if out is None or h != hour or size + len(line) > limit:
                    close()
                    path, size, lines, hour = f"{uuid.uuid4().hex}.ndjson", 0, 0, h
                    out = filesystem.open_output_stream(f"{base}/{path}")
                out.write(line)
                size, lines = size + len(line), lines + 1
        close()
        if done:
            h, p, n, k = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(p), pa.array(range(len(done)), pa.int32()), pa.array(n, pa.int64()), pa.array(k, pa.int64())], ["hour", "file", "no", "bytes", "lines"])

    return run


def segment_log(lines: DataFrame, root: str, hour: Column, max_mb: float = 100, text: str = "value") -> list[str]:
    """Lines appended to a log of closed segments, ``ready/segment_YYYYMMDDTHH_NNNNN.ndjson``; gives their paths.

    A segment holds the lines of one hour (``hour``, as YYYYMMDDTHH) and at most ``max_mb``; numbers of an hour go on after those found in
    ``active``, ``ready`` and ``processing``. Files are written and closed under ``active`` and moved when all are, so that a reader of ``ready``
    never sees an open one and a repeated task leaves nothing there. Null and blank lines are left out.
    """
    import re

    from tideframe.session import materialise, ship
    from tideframe.sources.segments import SEGMENT

    spark, root = lines.sparkSession, root.rstrip("/")
    ship(spark)
    d = lines.select(hour.alias("hour"), F.col(text).alias("value")).filter("value is not null and trim(value) <> ''")
    made = materialise(d.mapInArrow(_segment_writer(f"{root}/active", int(max_mb * 1e6)), "hour string, file string, no int, bytes long, lines long").withColumn("task", F.spark_partition_id()), "segments")
    last: dict[str, int] = {}
    for stage in ("active", "ready", "processing"):
        for f in fs.files(spark, f"{root}/{stage}", ".ndjson"):
            m = re.fullmatch(SEGMENT, f.path.rsplit("/", 1)[-1])
            if m:
                last[m[1] + "T" + m[2]] = max(last.get(m[1] + "T" + m[2], 0), int(m[3]))
    out = []
    for r in made.orderBy("hour", "task", "no").collect():  # one row a segment
        last[r.hour] = last.get(r.hour, 0) + 1
        out.append(f"{root}/ready/segment_{r.hour}_{last[r.hour]:05d}.ndjson")
        fs.rename(spark, f"{root}/active/{r.file}", out[-1])
    return out
