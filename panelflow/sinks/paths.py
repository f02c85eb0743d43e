"""Folder operations on any filesystem Spark reaches, through its own Hadoop client."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as the files below it are listed."""
    fs, p = _fs(spark, path)
    return re.sub("^file:/+", "file:/", fs.makeQualified(p).toString())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, p = _fs(spark, src)
    _, q = _fs(spark, dst)
    if not fs.rename(p, q):
        raise OSError(f"cannot rename {src} to {dst}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (none if it is absent)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly under ``path`` (none if it is absent); hidden ones are left out."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
    return sorted(n for n in names if n[0] not in "._")


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns a table is partitioned by, from its folder names (``col=value``)."""
    out = []
    while True:
        named = [m for m in (re.fullmatch(r"([^=]+)=.*", f) for f in folders(spark, path)) if m]
        if not named:
            return out
        out.append(unquote(named[0].group(1)))
        path = f"{path}/{named[0].group(0)}"


def swap(spark: SparkSession, new: str, target: str) -> None:
    """Put the finished folder ``new`` in place of ``target`` by two renames.

    The old folder is set aside, and put back if the new one cannot take
    its place, so a failure at any step leaves a readable table.
    """
    if not exists(spark, target):
        rename(spark, new, target)
        return
    old = f"{target.rstrip('/')}.old-{new.rstrip('/').rsplit('-', 1)[-1]}"
    rename(spark, target, old)
    try:
        rename(spark, new, target)
    except Exception:
        rename(spark, old, target)
        raise
    delete(spark, old)
