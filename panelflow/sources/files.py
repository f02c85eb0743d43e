"""S5 newest file, S7 expected deliveries, and the file listing they use."""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.functions.columns import date_key
from panelflow.schemas import ISO_DAY, STAMP_DAY, Feed, feed as _feed

LISTING_SCHEMA = "path string, file_name string, length bigint, modified timestamp"


def path_key(p: Column) -> Column:
    """``file:/x`` and ``file:///x`` name the same file."""
    return F.regexp_replace(p, r"^file:/+", "file:/")


class Listing(NamedTuple):
    """A listing and the ``binaryFile`` relation it came from; reusing the
    relation (its file index) avoids listing the folders again."""
    relation: DataFrame
    files: DataFrame


def literal(path: str) -> str:
    """``path`` with the characters escaped that Hadoop reads as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def scan_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, *,
               exclude: str | None = None, pattern: bool = False) -> Listing:
    """Every file under ``paths`` with its size and modification time.

    ``binaryFile`` gives path, length and time without reading content
    (the content column is pruned), but returns no row for a zero-byte
    file; the relation's file list does include those, so they are added
    with length 0 and an unknown time. The file list is URL-encoded and the
    rows are not; both are compared decoded. ``exclude`` leaves out what
    lies below that folder; ``pattern`` takes ``paths`` as Hadoop patterns.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    try:
        rel = r.load(paths if pattern else [literal(p) for p in paths])
        names = [unquote(p) for p in rel.inputFiles()]
    except AnalysisException as e:   # folder absent: nothing delivered
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rel = spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, "
                                        "content binary")
        return Listing(rel, spark.createDataFrame([], LISTING_SCHEMA))
    if exclude:
        below = norm(exclude).rstrip("/") + "/"
        rel = rel.filter(~path_key(F.col("path")).startswith(below))
        names = [n for n in names if not norm(n).startswith(below)]
    sized = rel.select(path_key(F.col("path")).alias("__k"),
                       F.col("length").cast("bigint").alias("length"),
                       F.col("modificationTime").alias("modified"))
    every = spark.createDataFrame([(p,) for p in names], "path string")
    files = (every.join(sized, path_key(F.col("path")) == F.col("__k"), "left")
             .select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"),
                     F.coalesce(F.col("length"), F.lit(0)).cast("bigint").alias("length"),
                     "modified"))
    return Listing(rel, files)


def norm(path: str) -> str:
    """:func:`path_key` on the driver; a bare path is a local file."""
    return re.sub("^file:/+", "file:/", path) if "://" in path or path.startswith("file:") else "file:" + path


def list_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, **kw) -> DataFrame:
    """Files under ``paths``: ``path, file_name, length, modified`` (see
    :func:`scan_files`)."""
    return scan_files(spark, paths, glob, **kw).files


def latest_file(spark: SparkSession, landing: str, contains: str, glob: str | None = None) -> str | None:
    """Of the deliveries directly in ``landing`` whose name contains
    ``contains``, the newest by modification time.

    A delivery is a file, or a folder of part files, which counts as a
    whole and is as new as its newest part. An empty delivery has no time;
    if its name sorts after the pick, it may be the real newest one, so
    this raises rather than silently passing over it."""
    root = norm(landing).rstrip("/") + "/"
    own = F.regexp_extract(F.substring(path_key(F.col("path")), len(root) + 1, 1 << 30), "^([^/]+)", 1)
    seen = (list_files(spark, landing, glob).select(own.alias("name"), "length", "modified")
            .filter(F.col("name").contains(contains) & ~F.col("name").startswith("_") & ~F.col("name").startswith("."))
            .groupBy("name").agg(F.max("modified").alias("modified"), F.sum("length").alias("length")))
    # equal times (coarse clocks) fall back to the name: later stamps sort later
    newest = F.when(F.col("modified").isNotNull(), F.struct("modified", "name"))
    r = seen.agg(F.max_by("name", newest).alias("n"), F.max(F.when(F.col("length") == 0, F.col("name"))).alias("z")).first()
    if r["z"] is not None and (r["n"] is None or r["z"] > r["n"]):
        raise ValueError(f"newest matching delivery may be the empty {r['z']}")
    return None if r["n"] is None else root + r["n"]


_PLACE = re.compile(r"\{(start|end|day)\}")


def _render(template: str, d: Column, day_format: str) -> Column:
    """A name template with ``{start}``/``{end}``/``{day}`` as a Column."""
    parts, pos = [], 0
    for m in _PLACE.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        key = m.group(1)
        if key == "start":
            parts.append(date_key(d, STAMP_DAY))
        elif key == "end":
            parts.append(date_key(d, STAMP_DAY, days=1))
        else:
            parts.append(date_key(d, day_format))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def run_day() -> _dt.date:
    """Today in UTC, the zone every session here uses, so that default days
    and import dates of one run agree."""
    return _dt.datetime.now(_dt.timezone.utc).date()


def expected_files(spark: SparkSession, days, feed: Feed | str, *,
                   today: _dt.date | None = None, col: str = "d") -> DataFrame:
    """One row per expected delivery: day, archive name, file name and
    the ``yyyyMMdd'T'000000'Z'`` start and end stamps of the day.

    ``days`` is a DataFrame with a date column ``col``, a list of days, a
    ``(first, last)`` pair (expanded by ``sequence``), or None for the
    feed's default day (yesterday for usage, today for compliance).
    """
    f = _feed(feed)
    if days is None:
        base = today or run_day()
        days = [base + _dt.timedelta(days=f.day_offset)]
    if isinstance(days, tuple) and len(days) == 2:
        a, b = (F.lit(str(x)).cast("date") for x in days)
        df = spark.range(1).select(F.explode(F.sequence(a, b)).alias(col))
    elif isinstance(days, (list, tuple)):
        df = spark.createDataFrame([(x,) for x in sorted({str(x) for x in days})], f"{col} string")
    else:
        df = days
    d = F.col(col).cast("date")
    file_tpl = f"{f.file_prefix}{{day}}{f.file_suffix}"
    df = df.select(d.alias("ref_date"))
    return ((df.distinct() if isinstance(days, DataFrame) else df)
            .select("ref_date",
                    _render(f.archive_template, F.col("ref_date"), f.file_day_format).alias("archive_name"),
                    _render(file_tpl, F.col("ref_date"), f.file_day_format).alias("file_name"),
                    date_key("ref_date", STAMP_DAY).alias("start_key"),
                    date_key("ref_date", STAMP_DAY, days=1).alias("end_key")))


def file_day(file_name: Column, feed: Feed | str) -> Column:
    """The day in a delivered file's name, per the feed's layout."""
    from panelflow.functions.dates import day_from_path
    f = _feed(feed)
    return day_from_path(file_name, f.file_day_format or ISO_DAY)
