"""The few file-system calls an intake needs, through Hadoop's FileSystem."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import lru_cache
from threading import Lock

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


_CREATING = Lock()


@lru_cache(maxsize=8)
def _entry_points(jvm, jsc):
    """The Path class and the Hadoop configuration, looked up once per session."""
    return jvm.org.apache.hadoop.fs.Path, jsc.hadoopConfiguration()


def _path(spark: SparkSession, path: str):
    return _entry_points(spark._jvm, spark._jsc)[0](path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(_entry_points(spark._jvm, spark._jsc)[1])


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. One caller of many gets True."""
    with _CREATING:  # local file systems look first and create then
        try:
            return _fs(spark, path).createNewFile(_path(spark, path))
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with a text; False if it is there already. One caller of many gets True."""
    with _CREATING:
        try:
            out = _fs(spark, path).create(_path(spark, path), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
    try:
        out.write(text.encode())
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text; ValueError if it is none."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder."""
    return [s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path))]


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def modified(spark: SparkSession, path: str) -> datetime:
    """When a file was last written."""
    ms = _fs(spark, path).getFileStatus(_path(spark, path)).getModificationTime()
    return datetime.fromtimestamp(ms / 1000, timezone.utc)


def qualified(spark: SparkSession, path: str) -> str:
    return _fs(spark, path).makeQualified(_path(spark, path)).toString()


def uri_of(spark: SparkSession, path: str) -> str:
    """A path as a URI, with what a URI may not hold encoded."""
    return _path(spark, path).toUri().toString()


def walk(spark: SparkSession, root: str, below: str = "", skip: tuple[str, ...] = ()):
    """Yield (relative path, size, modified ms) of the files below ``root/below``.

    Folders named in ``skip`` (relative, with a trailing slash) are not entered, so an
    archive that grows for years costs nothing.
    """
    fs = _fs(spark, root)
    folders = [below]
    while folders:
        folder = folders.pop()
        here = _path(spark, f"{root}/{folder}" if folder else root)
        if not fs.exists(here):
            continue
        entries = fs.listStatusIterator(here)
        while entries.hasNext():
            entry = entries.next()
            relative = folder + entry.getPath().getName()
            if entry.isDirectory():
                if f"{relative}/" not in skip:
                    folders.append(f"{relative}/")
            else:
                yield relative, entry.getLen(), entry.getModificationTime()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file into an existing folder, replacing a file of the same name.

    Raises if it did not move.
    """
    fs = _fs(spark, source)
    src, dst = _path(spark, source), _path(spark, target)
    refused = None
    try:
        if fs.rename(src, dst):
            return
    except Py4JJavaError as error:
        refused = error
    # most file systems refuse to rename onto a file that exists
    if not fs.exists(src):
        raise FileNotFoundError(f"cannot move {source}: it is gone")
    if not (fs.exists(dst) and fs.delete(dst, False) and fs.rename(src, dst)):
        raise OSError(f"cannot move {source} to {target}") from refused


def glob_safe(path: str) -> str:
    """A path as the readers expect it, with glob characters taken literally."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)
