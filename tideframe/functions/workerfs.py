"""Files of the shared folder as Python workers read them, whatever scheme the session names them by."""

from __future__ import annotations

#: Schemes of Hadoop's connectors, and the scheme under which the Arrow library knows the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss", "hdfs": "hdfs", "viewfs": "viewfs", "file": "file"}


def uri(path: str) -> str:
    """The address in the form the Arrow library reads: other scheme, or a mounted folder; a plain path stays."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return path
    if scheme == "dbfs":  # this store is mounted on every machine
        return "/dbfs/" + rest.lstrip("/")
    if scheme == "file":
        return "/" + rest.lstrip("/")
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def opened(path: str):
    """(file system, path in it). Keys of object stores come from the workers' environment or the machine's role."""
    from pyarrow import fs

    at = uri(path)
    return (fs.LocalFileSystem(), at) if at.startswith("/") else fs.FileSystem.from_uri(at)


def data_files(filesystem, folder: str) -> list[str]:
    """Parquet files of a folder in name order; none where there is no such folder."""
    from pyarrow import fs

    found = filesystem.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(i.path for i in found if i.path.endswith(".parquet"))
