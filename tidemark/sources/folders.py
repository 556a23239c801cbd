"""Folders of any store that the session knows: what is there, moving and removing it. Names only pass through the driver."""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _at(spark, path)
    return system.exists(target)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern with ``*``."""
    target, system = _at(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(target) or []]


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Folders in a folder, by name; those whose names begin with a sign are unfinished and don't count."""
    target, system = _at(spark, path)
    if not system.exists(target):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory())
    return [f"{path}/{name}" for name in names if not name.startswith(("_", "."))]


def encoded(spark: SparkSession, path: str) -> str:
    """A path as rows carry it: some signs are encoded, which only paths that have other than the plain ones are asked for."""
    return path if re.fullmatch(r"[A-Za-z0-9_.~/:=+,@-]*", path) else spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def files(spark: SparkSession, path: str) -> list[tuple[str, str, int]] | None:
    """Path, encoded path and size of each file at or below a path, whatever their names; none where there is nothing.

    Local folders are listed at once, as the store's own listing asks for each file's rights by a process. Checksums are no files in both.
    """
    target, system = _at(spark, path)
    if not system.exists(target):
        return None
    if system.getUri().getScheme() == "file":
        local, name = fs.LocalFileSystem(), system.makeQualified(target).toUri().getPath()
        found = local.get_file_info(name)
        below = [found] if found.is_file else local.get_file_info(fs.FileSelector(name, recursive=True))
        kept = [("file:" + i.path, i.size) for i in below if i.is_file and not re.fullmatch(r"\..*\.crc", i.base_name, re.DOTALL)]
        return [(p, encoded(spark, p), size) for p, size in kept]
    out, each = [], system.listFiles(target, True)
    while each.hasNext():
        status = each.next()
        found = status.getPath()
        out.append((found.toString(), found.toUri().toString(), status.getLen()))
    return out


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder; the folder that it comes to is made."""
    old, system = _at(spark, source)
    new, _ = _at(spark, target)
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"{source} can't be renamed to {target}")


def remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        target, system = _at(spark, path)
        system.delete(target, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty folder as a sign."""
    target, system = _at(spark, path)
    system.mkdirs(target)
