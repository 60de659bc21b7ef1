"""Copying of files between storages: list, map, skip what is there, copy on the executors, delete on demand, on a schedule."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tideframe.functions import fs, workerfs
from tideframe.operators import layout
from tideframe.session import materialise, ship
from tideframe.sources.segments import file_listing

#: Files a task copies, about.
FILES_PER_TASK = 200


def _copy(source: str, target: str, delete_source: bool):
    """Copies the files a task is given; each is written under another name and renamed, so that no reader sees half of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as afs

        to_fs, base = workerfs.opened(target)
        for b in batches:
            errors = []
            for path, rel in zip(b.column("path").to_pylist(), b.column("rel").to_pylist()):
                try:
                    from_fs, at = workerfs.opened(path)
                    to = f"{base}/{rel}"
                    folder, name = to.rsplit("/", 1)
                    to_fs.create_dir(folder, recursive=True)
                    part = f"{folder}/_part_{name}"
                    with from_fs.open_input_stream(at) as i, to_fs.open_output_stream(part) as o:
                        while data := i.read(8 << 20):
                            o.write(data)
                    if to_fs.get_file_info(to).type != afs.FileType.NotFound:
                        to_fs.delete_file(to)
                    to_fs.move(part, to)
                    if delete_source:
                        from_fs.delete_file(at)
                    errors.append(None)
                except Exception as e:  # counted, and told to the caller
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("rel"), b.column("size"), pa.array(errors, pa.string())], ["path", "rel", "size", "error"])

    return run


def sync(spark: SparkSession, source: str, target: str, suffix: str = "", skip_existing: bool = True, delete_source: bool = False, workers: int | None = None, on_success=None, on_failure=None) -> dict:
    """Copy the files below ``source`` to the same places below ``target``; each is counted as copied, skipped or failed.

    Both sides are listed by Spark jobs, what is missing is found by a join and copied by tasks (``workers``: how many; by default as
    many as the files ask for), each file once even where a task is repeated. Only counts come to the driver, and, one by one, the names of the copied or failed
    files where a callback asks for them. Schemes: those of ``workerfs``.
    """
    ship(spark)
    base = fs._fs(spark, source)[0].makeQualified(fs._fs(spark, source)[1]).toString().rstrip("/")
    goal = fs._fs(spark, target)[0].makeQualified(fs._fs(spark, target)[1]).toString().rstrip("/")
    rel = lambda of: F.expr(f"substring(path, {len(of) + 2})")
    mine = file_listing(spark, base, suffix).select("path", "size", rel(base).alias("rel"))
    n = mine.count()
    stats = {"copied": 0, "skipped": 0, "failed": 0, "bytes": 0}
    if skip_existing:
        mine = mine.join(file_listing(spark, goal, suffix).select(rel(goal).alias("rel")), "rel", "left_anti").select("path", "size", "rel")
    todo = mine.count()
    stats["skipped"] = n - todo
    if not todo:
        return stats
    tasks = workers or max(1, min(todo, max(spark.sparkContext.defaultParallelism, -(-todo // FILES_PER_TASK))))
    done = mine.repartition(tasks, F.xxhash64("rel")).mapInArrow(_copy(base, goal, delete_source), "path string, rel string, size long, error string")
    done = materialise(done, "copied")  # the copies are made once, whatever is asked of the report
    r = done.agg(F.count(F.when(F.col("error").isNull(), 1)), F.count("error"), F.sum(F.when(F.col("error").isNull(), F.col("size")))).first()
    stats["copied"], stats["failed"], stats["bytes"] = r[0], r[1], r[2] or 0
    if on_success or on_failure:
        for x in done.toLocalIterator():
            if x.error is None and on_success:
                on_success(x.path, f"{goal}/{x.rel}")
            elif x.error is not None and on_failure:
                on_failure(x.path, OSError(x.error))
    return stats


def compact_then_sync(spark: SparkSession, source: str, target: str, **options) -> dict:
    """One file for each folder, then copy."""
    c = layout.compact(spark, source, target_files=1)
    return {"compaction": c, **sync(spark, source, target, **options)}


def sync_jobs(spark: SparkSession, jobs: list[dict]) -> list[dict]:
    """Several copies, each a dict of the arguments of ``sync`` (with ``compact`` true: of ``compact_then_sync``)."""
    return [(compact_then_sync if j.get("compact") else sync)(spark, **{k: v for k, v in j.items() if k != "compact"}) for j in jobs]


def scheduled(spark: SparkSession, jobs: list[dict], every_s: float = 300, rounds: int | None = None, sleep=time.sleep) -> Iterator[list[dict]]:
    """The jobs again and again, each round ``every_s`` after the start of the one before; gives each round's reports. Ends after ``rounds``, or never."""
    n = 0
    while rounds is None or n < rounds:
        began = time.monotonic()
        yield sync_jobs(spark, jobs)
        n += 1
        if rounds is None or n < rounds:
            sleep(max(0.0, every_s - (time.monotonic() - began)))
