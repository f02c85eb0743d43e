"""Deliveries written from the driver's tables, for the bound queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.schemas import EVENTS
from panelflow.session import staging_path


def write_delivery(df: DataFrame, path: str, feed=EVENTS, day=None, spread: bool = False,
                   mode: str = "overwrite", **more) -> str:
    """Write ``df`` as one headerless delimited file set per day.

    ``day`` (a Column) names the folder each row lands in. Without
    ``spread`` each task writes the days it holds (no shuffle). With
    ``spread`` (thousands of days) day ranges go to separate tasks, so each
    writes a few folders; the row hash splits a hot day over several tasks
    and is the same on a retry.
    """
    day = F.date_format(F.col("ts"), "yyyy-MM-dd") if day is None else day
    opts = {"sep": feed.sep, "header": str(feed.header).lower(), "encoding": feed.encoding,
            "lineSep": "\n"}
    if feed.header:
        opts["escape"] = '"'          # header feeds follow common CSV quoting
    opts.update(feed.options)
    opts.update(more)
    out = df.withColumn("day", day)
    if spread:
        n = df.sparkSession.sparkContext.defaultParallelism
        out = out.repartitionByRange(n, "day", F.xxhash64(*df.columns))
    out.write.mode(mode).partitionBy("day").options(**opts).csv(path)
    return path


_DELIVERIES: dict[tuple, str] = {}


def _file_info(path: str):
    from pyarrow import fs as pafs
    uri = path if "://" in path else "file://" + path.replace("file:", "", 1)
    fsys, p = pafs.FileSystem.from_uri(uri)
    return fsys.get_file_info(p)


def delivery(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], key: tuple, build) -> str:
    """A delivery derived from driver tables, written once per application.

    ``build(path)`` writes it. Reused while the source tables are unchanged
    (size and modification time) and the written folder still exists, so
    the bound queries measure the operators reading a delivery, as they
    would in production, rather than writing their own input each time.
    """
    from pyarrow import fs as pafs
    stamp = tuple((i.size, i.mtime_ns) for i in
                  (_file_info(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in tables))
    k = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), key, stamp)
    path = _DELIVERIES.get(k)
    if path is None or _file_info(path).type == pafs.FileType.NotFound:
        path = build(staging_path(spark, f"{key[0]}-delivery"))
        _DELIVERIES[k] = path
    return path


def mark_empty(path: str):
    """Executor-side writer of empty deliveries: zero bytes on even days,
    a lone UTF-8 byte-order mark on odd days."""
    import pandas as pd

    def run(batches):
        import uuid
        from pyarrow import fs as pafs
        root = path[len("file:"):] if path.startswith("file:") else path
        fsys, base = pafs.FileSystem.from_uri(root if "://" in root else "file://" + root)
        for pdf in batches:
            for day in pdf["day"]:
                folder = f"{base}/day={day}"
                fsys.create_dir(folder, recursive=True)
                tmp = f"{folder}/.part-empty.{uuid.uuid4().hex}.tmp"
                with fsys.open_output_stream(tmp) as out:
                    out.write(b"" if int(day[-2:]) % 2 == 0 else b"\xef\xbb\xbf")
                fsys.move(tmp, f"{folder}/part-empty.csv")   # a retried task rewrites it whole
            yield pd.DataFrame({"day": pdf["day"]})
    return run


def zip_parts(path: str, out: str):
    """Executor-side packer: each delivered part file becomes one archive
    ``events-<day>-<n>.zip`` holding the member ``events.txt``."""
    import pandas as pd

    def run(batches):
        import io
        import re
        import uuid
        import zipfile
        from pyarrow import fs as pafs
        root = out[len("file:"):] if out.startswith("file:") else out
        fsys, base = pafs.FileSystem.from_uri(root if "://" in root else "file://" + root)
        fsys.create_dir(base, recursive=True)
        names = []
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                day = re.search(r"day=(\d{4}-\d{2}-\d{2})", p).group(1)
                part = re.search(r"part-(\d+)-([0-9a-f]{8})", p)
                name = f"events-{day}-{part.group(1)}-{part.group(2)}.zip"
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("readme.txt", b"other member")
                    z.writestr("events.txt", content)
                tmp = f"{base}/.{name}.{uuid.uuid4().hex}.tmp"
                with fsys.open_output_stream(tmp) as o:
                    o.write(buf.getvalue())
                fsys.move(tmp, f"{base}/{name}")
                names.append(name)
        yield pd.DataFrame({"name": names})
    return run


def write_lines(lines: DataFrame, path: str) -> str:
    """Text lines (day, value) as one folder of files per day."""
    lines.select("day", "value").write.mode("append").partitionBy("day").text(path)
    return path


def set_age(spark: SparkSession, path: str, days: int) -> None:
    """Make every file below ``path`` look ``days`` days older than now."""
    import time
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listFiles(hadoop, True)
    while files.hasNext():
        fs.setTimes(files.next().getPath(), int((time.time() - 86400 * days) * 1000), -1)
