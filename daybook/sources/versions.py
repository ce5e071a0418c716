"""Versions of a published table: a folder each, made visible by one rename.

A published table is a folder ``target`` of whole tables ``version-000001``,
``version-000002``, ...; the highest one is current. Publishing writes the rows into a
hidden folder beside them, checks them there, takes the next number by creating a claim
file that nobody else can create, and renames the folder: before this rename readers
find the old version, after it the new one, and a process that ends anywhere leaves at
most a hidden folder or an unused number. Earlier versions stay readable until
:func:`retain` deletes them. A folder that holds a table itself (without versions) is read
as it is, until a version is published into it.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"version-(\d{6,})$")


def fs_path(spark: SparkSession, path: str):
    """The file system of a path (any that Spark knows), and the path there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = fs_path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the whole versions, oldest first."""
    return sorted(int(m[1]) for m in map(_NAME.match, _names(spark, target)) if m)


def current_version(spark: SparkSession, target: str) -> int | None:
    return max(versions(spark, target), default=None)


def version_path(target: str, version: int) -> str:
    return os.path.join(target, f"version-{version:06d}")


def table_path(spark: SparkSession, target: str, version: int | None = None) -> str:
    """Where the table is: its current (or the given) version, or the folder
    itself if it has none. An absent version raises ``LookupError``."""
    held = versions(spark, target)
    if version is not None and version not in held:
        raise LookupError(f"{target} has no version {version}")
    if not held:
        return target
    return version_path(target, version if version is not None else held[-1])


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether a whole table can be read: a version, or a plain table."""
    if versions(spark, target):
        return True
    return any(not n.startswith(("_", ".")) or n == "_SUCCESS" for n in _names(spark, target))


def _claim(spark: SparkSession, target: str) -> int:
    """The next number, taken by an exclusive create."""
    while True:
        taken = [int(n) for n in _names(spark, os.path.join(target, "_claims")) if n.isdigit()]
        number = max([*taken, *versions(spark, target)], default=0) + 1
        if _create_exclusively(spark, os.path.join(target, "_claims", f"{number:06d}")):
            return number


def _create_exclusively(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists. The local file system of Spark
    looks first and creates then, so there the operating system's call is used."""
    fs, p = fs_path(spark, path)
    fs.mkdirs(p.getParent())
    try:
        if fs.getScheme() == "file":
            os.close(os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        else:
            fs.create(p, False).close()
        return True
    except FileExistsError:
        return False
    except Py4JJavaError:
        if not fs.exists(p):  # not taken by another process: a real fault
            raise
        return False


def publish_version(df: DataFrame, target: str, write: Callable[[DataFrame, str], int],
                    check: Callable[[str, int], None] | None = None) -> tuple[int, int]:
    """Write → check → rename; returns (rows, version). ``write`` writes the rows
    to a path and returns their number; ``check`` raises to stop: the hidden
    folder then stays for inspection, and the current version stays current."""
    spark = df.sparkSession
    staged = os.path.join(target, f"_staging-{uuid.uuid4().hex[:12]}")
    rows = write(df, staged)
    if check is not None:
        check(staged, rows)
    number = _claim(spark, target)
    fs, src = fs_path(spark, staged)
    _, dst = fs_path(spark, version_path(target, number))
    if not fs.rename(src, dst):
        raise OSError(f"can't move {staged} to version {number}; the old version is current")
    return rows, number


def retain(spark: SparkSession, target: str, keep: int) -> list[int]:
    """Delete all but the newest ``keep`` versions; returns the numbers deleted.
    Hidden folders and claims stay: a publish may be under way."""
    if keep < 1:
        raise ValueError("the current version can't be deleted")
    old = versions(spark, target)[:-keep]
    for v in old:
        fs, p = fs_path(spark, version_path(target, v))
        # out of the readers' sight first, so that no half deleted version is found
        _, gone = fs_path(spark, os.path.join(target, f"_deleted-{v:06d}-{uuid.uuid4().hex[:8]}"))
        if fs.rename(p, gone):
            fs.delete(gone, True)
    return old
