"""Paths of files on the driver's and executors' common storage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyarrow import fs as pafs

from ..errors import BadArgument, OpenError

SUFFIXES = (".arrow", ".feather", ".ipc")


def plain(path, operation: str) -> str:
    """The path as text, without the one leading colon that path symbols carry."""
    if isinstance(path, os.PathLike):
        path = os.fspath(path)
    if not isinstance(path, str) or not path.lstrip(":"):
        raise BadArgument(operation, f"a path is expected, not {path!r}")
    return path[1:] if path.startswith(":") else path


def qualified(spark, path: str) -> str:
    """The path as Spark understands it: one without a scheme lies in the default file system, so that what Spark and what pyarrow open is the same file."""
    if "://" in path or path.startswith("file:"):
        return path
    sc = spark.sparkContext
    if sc._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(sc._jsc.hadoopConfiguration()).getScheme() == "file":
        return path
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(where).toString()


def resolve(path: str, operation: str) -> tuple[pafs.FileSystem, str]:
    try:
        if "://" in path or path.startswith("file:"):
            return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
        return pafs.LocalFileSystem(), os.path.abspath(path)
    except (OSError, pa.ArrowException) as e:
        raise OpenError(operation, str(e)) from e


def data_files(path: str, operation: str) -> list[str]:
    """The file itself, or a folder's files in name order (hidden ones and those in the making left out)."""
    fs, p = resolve(path, operation)
    try:
        info = fs.get_file_info(p)
        if info.type == pafs.FileType.NotFound:
            raise OpenError(operation, f"{path} does not exist")
        if info.type != pafs.FileType.Directory:
            return [path]
        found = [f for f in fs.get_file_info(pafs.FileSelector(p)) if f.type == pafs.FileType.File and f.base_name[0] not in "._"]
    except OSError as e:
        raise OpenError(operation, str(e)) from e
    if not found:
        raise OpenError(operation, f"{path} has no files")
    head = path.rstrip("/")
    return [f"{head}/{f.base_name}" for f in sorted(found, key=lambda f: f.base_name)]


def stamps(path: str, operation: str) -> dict[str, str]:
    """Size and time of the file, by its path, or of each of a folder's files, by its name; a folder may still be empty."""
    fs, p = resolve(path, operation)
    told = lambda f: f"{f.size}@{f.mtime_ns or 0}"
    try:
        info = fs.get_file_info(p)
        if info.type == pafs.FileType.NotFound:
            raise OpenError(operation, f"{path} does not exist")
        if info.type != pafs.FileType.Directory:
            return {path: told(info)}
        return {f.base_name: told(f) for f in fs.get_file_info(pafs.FileSelector(p)) if f.type == pafs.FileType.File and f.base_name[0] not in "._"}
    except OSError as e:
        raise OpenError(operation, str(e)) from e


def open_file(path: str, operation: str):
    """A random access file; local ones are mapped, so a task touches only the pages it decodes."""
    fs, p = resolve(path, operation)
    try:
        return pa.memory_map(p) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(p)
    except (OSError, pa.ArrowException) as e:
        raise OpenError(operation, str(e)) from e


def scratch_root(spark) -> str:
    """The shared folder of spark.checkpoint.dir; only where that is unset, in local mode, one of our own."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return qualified(spark, root.rstrip("/"))
    made = sc._jsc.sc().getCheckpointDir()
    if made.isDefined():
        return made.get().rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="brindle-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    sc.setCheckpointDir(root)
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch(spark, tag: str, suffix: str = "") -> str:
    return f"{scratch_root(spark)}/brindle/{tag}-{uuid.uuid4().hex}{suffix}"


def drop(spark, path: str) -> None:
    """Removes a folder, wherever Spark can reach it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def sweep(spark) -> None:
    """Removes all scratch tables; call it when no DataFrame that reads them is in use any more."""
    drop(spark, f"{scratch_root(spark)}/brindle")
