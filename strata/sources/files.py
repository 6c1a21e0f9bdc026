"""Files and directories of a table, through the file system that serves them."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of a table in which replaced partitions wait for their successors; readers skip the name.
REPLACED = "_replaced"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete one directory tree through the file system that serves it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_older(spark: SparkSession, path: str, cutoff: dt.datetime) -> None:
    """Delete entries of a folder that were last changed before ``cutoff``; a missing folder is empty."""
    if path_exists(spark, path):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in system.listStatus(folder):
            if status.getModificationTime() < cutoff.timestamp() * 1000:
                system.delete(status.getPath(), True)


def leaf_directories(spark: SparkSession, path: str) -> list[str]:
    """Partition directories below ``path`` that hold data files, relative to it."""
    return sorted(data_file_counts(spark, path))


def data_file_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """The number of data files of each partition directory, from the listing alone; none below a missing path."""
    if not path_exists(spark, path):
        return {}
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found, todo = {}, [""]
    while todo:
        name = todo.pop()
        inside = list(system.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}" if name else path)))
        below = [s.getPath().getName() for s in inside if s.isDirectory() and "=" in s.getPath().getName()]
        todo += [f"{name}/{b}" if name else b for b in below]
        files = sum(s.isFile() and s.getPath().getName().endswith(".parquet") for s in inside)
        if name and files:
            found[name] = files
    return found


def move_partitions(spark: SparkSession, staged_path: str, path: str) -> list[str]:
    """Put the partition directories of a staged copy in place of those of a table; returns their names.

    A replaced directory steps aside under a name that readers skip and is deleted after its successor is
    there. If a move fails, the directory that stepped aside comes back; if the driver dies in between,
    ``restore_partitions`` puts it back before anything reads or replaces the table again. Either way every
    partition has its old or its new rows, and a repeated run completes the rest.
    """
    restore_partitions(spark, path)
    base, staged = path.rstrip("/"), staged_path.rstrip("/")
    make = spark._jvm.org.apache.hadoop.fs.Path
    system = make(base).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(make(base))
    names = leaf_directories(spark, staged)
    for name in names:
        target, aside = make(f"{base}/{name}"), make(f"{base}/{REPLACED}/{name}")
        system.mkdirs(target.getParent())
        stepped_aside = system.exists(target)
        if stepped_aside:
            system.mkdirs(aside.getParent())
            _rename(system, target, aside)
        try:
            _rename(system, make(f"{staged}/{name}"), target)
        except Exception:
            if stepped_aside and not system.exists(target):
                _rename(system, aside, target)
            raise
        if stepped_aside:
            system.delete(aside, True)
    _remove_emptied(spark, base)
    return names


def restore_partitions(spark: SparkSession, path: str) -> list[str]:
    """Undo half a replacement: directories that stepped aside and have no successor come back.

    Those whose successor is in place are deleted. Every job that reads a table in order to replace its
    partitions calls this first; returns the names that came back.
    """
    base = path.rstrip("/")
    if not path_exists(spark, f"{base}/{REPLACED}"):
        return []
    make = spark._jvm.org.apache.hadoop.fs.Path
    system = make(base).getFileSystem(spark._jsc.hadoopConfiguration())
    back = []
    for name in leaf_directories(spark, f"{base}/{REPLACED}"):
        target, aside = make(f"{base}/{name}"), make(f"{base}/{REPLACED}/{name}")
        if system.exists(target):
            system.delete(aside, True)
        else:
            system.mkdirs(target.getParent())
            _rename(system, aside, target)
            back.append(name)
    _remove_emptied(spark, base)
    return back


def _remove_emptied(spark: SparkSession, base: str) -> None:
    """Remove the folder of replaced partitions once no directory in it holds files."""
    if path_exists(spark, f"{base}/{REPLACED}") and not leaf_directories(spark, f"{base}/{REPLACED}"):
        remove_path(spark, f"{base}/{REPLACED}")


def _rename(system, source, target) -> None:
    if not system.rename(source, target):
        raise OSError(f"{source} cannot be moved to {target}")


def partition_directories(df: DataFrame, column: str) -> set[str]:
    """Names of the directories, one per partition of ``column``, that hold the rows of a file table."""
    name = F.regexp_extract("_metadata.file_path", f"({column}=[^/]*)/[^/]*$", 1)
    # The path is written as an address, in which special signs of the name are escaped once more.
    return {unquote(row.name) for row in df.select(name.alias("name")).distinct().collect()}


def file_inventory(spark: SparkSession, path: str, directories: list[str] | None = None) -> DataFrame:
    """Data files below ``path``, or only in some of its directories, with size and time.

    Partition columns are included. The binary-file source lists files without opening them as long as
    ``content`` is not selected.
    """
    base = path.rstrip("/")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", base)
    return reader.load(base if directories is None else [f"{base}/{d}" for d in directories]).drop("content")
