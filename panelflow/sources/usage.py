"""Positional usage feeds; raw lines for the count check."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.functions.columns import add_ref_date
from panelflow.functions.dates import day_from_path
from panelflow.schemas import Feed, feed as _feed
from panelflow.sources.archive import _uri
from panelflow.sources.files import literal

FILE_COL = "_file"
DAY_COL = "__path_day"   # the day in the file's path, where it is worked out once for two uses

# A line the CSV reader passes over: nothing but characters up to the blank.
_TEXT = r"[^\x00-\x20]"


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def reader_options(f: Feed) -> dict:
    """CSV options of a feed whose lines end in a line feed."""
    return {"sep": f.sep, "header": str(f.header).lower(), "encoding": f.encoding, **f.options}


def _line_options(charset: str) -> dict:
    """Options that read whole UTF-16 lines as one column.

    The text source has no charset. ``encoding`` + ``lineSep`` keep the CSV
    read splittable (no ``multiLine``), so a large file is still cut into
    many tasks; no quote or separator is looked at.
    """
    return {"sep": "\u0001", "quote": "", "escape": "", "header": "false", "encoding": charset, "lineSep": "\n",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "nullValue": "\u0000\u0000", "emptyValue": ""}


FEW_FILES = 128          # so many files the driver looks into itself, without starting a job
BIG_ENDIAN = b"\xfe\xff"


def _heads(batches):
    """The files that begin with the big-endian byte-order mark."""
    import pyarrow as pa
    from pyarrow import fs as pafs
    for b in batches:
        out = []
        for path in b.column("path").to_pylist():
            fsys, p = pafs.FileSystem.from_uri(_uri(path))
            with fsys.open_input_stream(p) as data:
                if data.read(2) == BIG_ENDIAN:
                    out.append(path)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["path"])


def _marked_big(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    data = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return data.read() == BIG_ENDIAN[0] and data.read() == BIG_ENDIAN[1]
    finally:
        data.close()


def byte_orders(spark: SparkSession, paths: str | Sequence[str]) -> tuple[list[str], list[str]]:
    """(little-endian files, big-endian files) under ``paths``, by their byte-order mark; little-endian without one.

    The folders are listed once and two bytes of each file are read: by the
    driver for a few files, on the executors for more. Without a big-endian
    file ``paths`` come back as they were given.
    """
    paths = _paths(paths)
    files = [unquote(p) for p in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([literal(p) for p in paths]).inputFiles()]
    if len(files) <= FEW_FILES:
        big = {p for p in files if _marked_big(spark, p)}
    else:
        tasks = min(len(files) // FEW_FILES + 1, 4 * spark.sparkContext.defaultParallelism)
        listed = spark.createDataFrame([(p,) for p in files], "path string").repartition(tasks)
        big = {r.path for r in listed.mapInArrow(_heads, "path string").toLocalIterator()}
    return (sorted(set(files) - big), sorted(big)) if big else (paths, [])


def utf16_lines(df: DataFrame) -> DataFrame:
    """One row per line of a one-column UTF-16 read: the leading byte-order
    mark goes, and a carriage return ends a line, alone or before a feed."""
    first = F.col("_metadata.file_block_start") == 0
    value = F.when(first & F.col("value").startswith("﻿"), F.substring("value", 2, 1 << 30)).otherwise(F.col("value"))
    return (df.select(value.alias("value"), F.col("_metadata.file_path").alias(FILE_COL))
            .select(F.explode(F.split("value", "\r")).alias("value"), FILE_COL))


def raw_lines(spark: SparkSession, paths: str | Sequence[str], feed: Feed | str) -> DataFrame:
    """Every physical line of the delivered files, with its file path.

    UTF-8 uses the text source. UTF-16 files are decoded in the byte order
    of their mark, little-endian without one, as Python's codec does;
    big-endian files, which are rare, are read beside the others.
    """
    f = _feed(feed)
    paths = _paths(paths)
    if not f.is_utf16:
        df = spark.read.option("recursiveFileLookup", "true").text([literal(p) for p in paths])
        return df.select("value", F.col("_metadata.file_path").alias(FILE_COL))

    def read(charset: str, these: list[str]) -> DataFrame:
        return utf16_lines(spark.read.schema("value string").options(**_line_options(charset))
                           .option("recursiveFileLookup", "true").csv([literal(p) for p in these]))
    little, big = byte_orders(spark, paths)
    if not big:
        return read("UTF-16LE", little)
    out = read("UTF-16BE", big)
    return out.unionByName(read("UTF-16LE", little)) if little else out


def typed_lines(lines: DataFrame, f: Feed, *more: str) -> DataFrame:
    """Lines parsed with the feed's fixed schema, as the CSV reader would; columns ``more`` of ``lines`` stay."""
    row: Column = F.from_csv("value", f.schema.toDDL(), {"sep": f.sep, **f.options})
    text = (F.ascii("value") > 32) | F.col("value").rlike(_TEXT)      # the first character tells for nearly all lines
    return lines.filter(text).select(row.alias("r"), FILE_COL, *more).select("r.*", FILE_COL, *more)


def with_ref_date(df: DataFrame, f: Feed, day: Column | None = None) -> DataFrame:
    """``df`` with its reference date: ``day``, or the one in the file's path."""
    return add_ref_date(df, day_from_path(F.col(FILE_COL), f.file_day_format) if day is None else day, f.ref_col) if f.ref_col else df


def read_usage(spark: SparkSession, paths: str | Sequence[str], feed: Feed | str,
               *, ref_from_path: bool = True) -> DataFrame:
    """S1 + S2: headerless, positional read with the feed's fixed schema.

    PERMISSIVE (Spark's default): a field that does not parse is NULL, a
    short row is NULL-padded, extra fields are dropped. UTF-16 is read as
    lines (:func:`raw_lines`), which are then parsed, so byte order, CRLF and
    lone carriage returns give the same rows. With ``ref_from_path`` the
    feed's reference-date column is taken from the file path, so one read
    covers every delivered day at once.
    """
    f = _feed(feed)
    if f.is_utf16:
        df = typed_lines(raw_lines(spark, paths, f), f)
    else:
        df = (spark.read.schema(f.schema).options(**reader_options(f)).option("recursiveFileLookup", "true")
              .csv([literal(p) for p in _paths(paths)]).select("*", F.col("_metadata.file_path").alias(FILE_COL)))
    return with_ref_date(df, f) if ref_from_path else df
