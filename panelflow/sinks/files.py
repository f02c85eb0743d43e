"""Moving processed deliveries out of the landing folder."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from panelflow.sources.archive import _uri


def _archived_name(name: str, suffix: str) -> str:
    """``name.ext`` → ``name<suffix>.ext`` (the suffix before the extension)."""
    if not suffix:
        return name
    stem, dot, ext = name.rpartition(".")
    return f"{stem}{suffix}.{ext}" if dot else f"{name}{suffix}"


def _below(path: str, root: str | None) -> str:
    """The part of ``path`` below ``root``; its last part if it lies elsewhere."""
    clean = lambda p: re.sub("^file:/+", "/", p).rstrip("/")
    p, r = clean(path), clean(root) if root else None
    return p[len(r) + 1:] if r and p.startswith(r + "/") else p.rsplit("/", 1)[-1]


def _mover(archive_dir: str, suffix: str = "", root_dir: str | None = None):
    """Executor-side mover: each file is moved (renamed where the filesystem
    allows) to its place below ``archive_dir``. A target that exists is
    refused before anything is moved over it; a retried task finds its file
    already moved and reports it."""
    from pyarrow import fs as pafs

    def run(batches):
        dst_fs, root = pafs.FileSystem.from_uri(_uri(archive_dir))
        dst_fs.create_dir(root, recursive=True)
        for pdf in batches:
            out = []
            for path in pdf["path"]:
                src_fs, src = pafs.FileSystem.from_uri(_uri(path))
                target = f"{root}/{_archived_name(_below(path, root_dir), suffix)}"
                if src_fs.get_file_info(src).type != pafs.FileType.NotFound:
                    if dst_fs.get_file_info(target).type != pafs.FileType.NotFound:
                        raise FileExistsError(f"{path}: {target} is already in the archive")
                    dst_fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    if type(src_fs) is type(dst_fs):
                        src_fs.move(src, target)
                    else:
                        pafs.copy_files(src, target, source_filesystem=src_fs, destination_filesystem=dst_fs)
                        src_fs.delete_file(src)
                out.append((path, target))
            yield pd.DataFrame(out, columns=["path", "archived_to"])
    return run


def archive_files(spark: SparkSession, paths: Sequence[str] | DataFrame, archive_dir: str,
                  suffix: str = "", root: str | None = None) -> DataFrame:
    """Move files (paths, or a DataFrame with a ``path`` column) into
    ``archive_dir``; returns one row per file.

    Below ``root``, the landing folder, the archive keeps the same folders,
    so day folders whose files share names stay apart. ``suffix`` (a run
    stamp) goes before each extension. A file already in the archive under
    that name is an error, never overwritten. Runs on executors, so it works
    for any filesystem they reach."""
    if not isinstance(paths, DataFrame):
        paths = spark.createDataFrame([(p,) for p in paths], "path string")
    src = paths.select("path").repartition(spark.sparkContext.defaultParallelism)
    return src.mapInPandas(_mover(archive_dir, suffix, root), "path string, archived_to string")
