"""File operations on whatever file system a path names, through Hadoop's FileSystem."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FileInfo:
    path: str
    size: int
    modified_ms: int


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def drop_empty(spark: SparkSession, path: str) -> None:
    """Delete a folder that holds nothing; anything else stays."""
    fs, p = _fs(spark, path)
    if fs.exists(p) and fs.getFileStatus(p).isDirectory() and not len(fs.listStatus(p)):
        fs.delete(p, False)


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Rename; the target's parent is made, an existing target is an error."""
    fs, p = _fs(spark, src)
    _, q = _fs(spark, dst)
    fs.mkdirs(q.getParent())
    if fs.exists(q) or not fs.rename(p, q):
        raise OSError(f"cannot rename {src} to {dst}")


def copy(spark: SparkSession, src: str, dst: str) -> None:
    """Copy a file or a directory, also between file systems."""
    fs, p = _fs(spark, src)
    gs, q = _fs(spark, dst)
    gs.mkdirs(q.getParent())
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, gs, q, False, True, spark._jsc.hadoopConfiguration()):
        raise OSError(f"cannot copy {src} to {dst}")


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a file; where only the new version beside it is there, an interrupted ``write_text``, that one."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        fs, p = _fs(spark, path + ".tmp")
    s = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(s, "UTF-8")
    finally:
        s.close()


def has_text(spark: SparkSession, path: str) -> bool:
    return exists(spark, path) or exists(spark, path + ".tmp")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the target, then rename over it, so that a reader never sees half a file; in one step where the file system can."""
    fs, p = _fs(spark, path)
    _, tmp = _fs(spark, path + ".tmp")
    fs.mkdirs(p.getParent())
    s = fs.create(tmp, True)
    try:
        s.write(bytearray(text.encode()))
    finally:
        s.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    try:
        hadoop.FileContext.getFileContext(fs.makeQualified(p).toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(tmp), fs.makeQualified(p), over)
    except Exception:  # no such interface for this file system
        fs.delete(p, False)
        fs.rename(tmp, p)


def files(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[FileInfo]:
    """All data files below a directory, hidden and underscore names left out, in path order."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        full = f.getPath().toString()
        rel = full.split("/")
        if f.getPath().getName().endswith(suffix) and not any(x[:1] in "._" and x not in (".", "..") for x in rel[-1:]) and "/_staging" not in full:
            out.append(FileInfo(full, f.getLen(), f.getModificationTime()))
    return sorted(out, key=lambda x: x.path)


def subdirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly below a path."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and (s.getPath().getName()[:1] not in "._" or "=" in s.getPath().getName()))
