"""Named members out of many zip archives, one task per archive."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from panelflow.schemas import Feed, feed as _feed
from panelflow.sources.files import list_files

OUT_SCHEMA = "archive string, member string, found boolean, out_path string, bytes bigint"


def _uri(path: str) -> str:
    """What pyarrow understands: local paths as they are; Hadoop's s3a:// / s3n:// become s3:// (hdfs:// needs
    libhdfs), with the characters escaped that a URI may not hold."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return path
    scheme, rest = path.split("://", 1)
    return ("s3" if scheme in ("s3a", "s3n") else scheme) + "://" + quote(rest, safe="/:@!$&'()*,;=~+")


def _extract(wanted: list[tuple[str, str | None, str | None]], out_dir: str):
    """Per-partition extractor: opens each archive by path (seekable, so
    only the zip directory and the wanted members are read) and streams
    every wanted member to the shared folder.

    ``wanted``: (member, day regex, name template) triples; each archive is
    opened once for all of them. Output names depend on the archive and
    member only, so a retried task rewrites the same files (safe under
    executor loss), each first written under a temporary name.
    """
    import re
    import uuid
    import zipfile

    from pyarrow import fs as pafs

    def run(batches):
        out_fs, root = pafs.FileSystem.from_uri(_uri(out_dir))
        out_fs.create_dir(root, recursive=True)
        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                stem = path.rsplit("/", 1)[-1]
                in_fs, in_path = pafs.FileSystem.from_uri(_uri(path))
                with in_fs.open_input_file(in_path) as raw:
                    try:
                        zf = zipfile.ZipFile(raw)
                        infos = zf.infolist()
                    except zipfile.BadZipFile:
                        zf, infos = None, []
                    for member, day_rx, name_tpl in wanted:
                        info = next((i for i in infos if i.filename.rsplit("/", 1)[-1] == member
                                     or i.filename == member), None)
                        if info is None:
                            rows.append((path, member, False, None, None))
                            continue
                        name = stem.rsplit(".", 1)[0] + "__" + member
                        m = re.search(day_rx, stem) if day_rx else None
                        if m:
                            name = name_tpl.format(y=m.group(1), m=m.group(2), d=m.group(3))
                        target = f"{root}/{name}"
                        tmp = f"{root}/.{name}.{uuid.uuid4().hex}.tmp"
                        with zf.open(info) as src, out_fs.open_output_stream(tmp) as dst:
                            n = 0
                            while chunk := src.read(1 << 20):
                                dst.write(chunk)
                                n += len(chunk)
                        out_fs.move(tmp, target)   # readers never see a half-written file
                        rows.append((path, member, True, target, n))
            yield pd.DataFrame(rows, columns=["archive", "member", "found", "out_path", "bytes"])
    return run


def _day_pattern(f: Feed) -> tuple[str, str]:
    """Regex (year, month, day groups) for the archive name, and the
    extracted file's name template with ``{y}``, ``{m}``, ``{d}``."""
    sep = f.file_day_format[4]
    tpl = f"{f.file_prefix}{{y}}{sep}{{m}}{sep}{{d}}{f.file_suffix}"
    if "{start}" in f.archive_template:
        return r"(\d{4})(\d{2})(\d{2})T000000Z", tpl
    return r"(\d{4})[-_](\d{2})[-_](\d{2})", tpl


def archive_members(spark: SparkSession, paths: str | Sequence[str],
                    member: str | Sequence[str], out_dir: str,
                    feed: Feed | str | Sequence[Feed | str] | None = None,
                    glob: str = "*.zip") -> DataFrame:
    """Extract ``member`` (one name or several) from every archive under
    ``paths`` into ``out_dir``, reading each archive once.

    Returns one row per archive and member (``found`` false when the member
    is absent; every member of every archive is looked at, not only the
    first). With ``feed`` (one per member) the extracted file is named
    ``<prefix><day><suffix>``, the day read from the archive name, so the
    usage reader takes its reference date from it. Each task opens its
    archive by path with random access, so archive size is not bounded by
    what one row or one Arrow batch can hold. Lazy: run one action on the
    result.
    """
    members = [member] if isinstance(member, str) else list(member)
    feeds = feed if isinstance(feed, (list, tuple)) else [feed] * len(members)
    wanted = []
    for m, f in zip(members, feeds):
        day_rx, name_tpl = _day_pattern(_feed(f)) if f is not None else (None, None)
        wanted.append((m, day_rx, name_tpl))
    # archive paths only (content is never loaded into the JVM); one task
    # per archive, since a zip cannot be split
    archives = [r.path for r in list_files(spark, paths, glob).select("path").collect()]
    if not archives:
        return spark.createDataFrame([], OUT_SCHEMA)
    src = spark.createDataFrame([(a,) for a in archives], "path string").repartition(len(archives))
    return src.mapInPandas(_extract(wanted, out_dir), OUT_SCHEMA)
