"""Delimited files with a header and inferred column types."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelflow.functions.columns import PANDAS_NA_VALUES, null_out
from panelflow.sources.files import literal
from panelflow.sources.records import quoted_records


def _paths(paths):
    return [paths] if isinstance(paths, str) else list(paths)


# --- fixed values: pandas' read_csv reads these as booleans, in any letter
# case but without surrounding spaces --------------------------------------
BOOL_TEXT = ("true", "false")
# ----------------------------------------------------------------------------


# Text that pandas reads as an integer / a float. Casts run only on text
# that matches (a failing cast is slow in Spark), and the float form leaves
# out Java's '1d' / '1f', which Spark would accept and pandas does not.
_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
_FLOAT_TEXT = (r"^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?"
               r"|(?i:inf|infinity|nan))\s*$")


def narrowest_types(df: DataFrame, columns: Iterable[str] | None = None) -> dict[str, str | None]:
    """The narrowest type every value of a text column fits (None: no value at all).

    ``bigint``, then ``double``, then ``boolean`` (``true``/``false`` in any
    case, untrimmed), else ``string``. Whole numbers too long for ``bigint``
    stay text: as ``double`` they would lose digits. One aggregate over the
    data decides every column at once; partial aggregates keep it a single
    map-side pass plus a one-row merge.
    """
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cols = [c for c in strings if columns is None or c in set(columns)]
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c)
        nn = v.isNotNull()
        whole = v.rlike(_INT_TEXT)
        is_float = v.rlike(_FLOAT_TEXT) & v.try_cast("double").isNotNull()
        aggs += [F.count(v).alias(f"n{i}"),
                 F.count_if(nn & ~whole).alias(f"w{i}"),
                 F.count_if(whole & v.try_cast("bigint").isNull()).alias(f"l{i}"),
                 F.count_if(nn & ~is_float).alias(f"d{i}"),
                 F.count_if(nn & ~F.lower(v).isin(*BOOL_TEXT)).alias(f"b{i}")]
    r = df.agg(*aggs).first()
    types = {}
    for i, c in enumerate(cols):
        if r[f"n{i}"] == 0:
            types[c] = None
        elif r[f"w{i}"] == 0:
            types[c] = "string" if r[f"l{i}"] else "bigint"
        elif r[f"d{i}"] == 0:
            types[c] = "double"
        else:
            types[c] = "string" if r[f"b{i}"] else "boolean"
    return types


def infer_types(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Cast text columns to the narrowest type every value fits
    (:func:`narrowest_types`); one without a value becomes ``double``, as
    pandas' all-NaN column."""
    types = narrowest_types(df, columns)
    return df.select(*[F.col(c).try_cast(types[c] or "double").alias(c) if c in types else F.col(c)
                       for c in df.columns])


def wider(a: str | None, b: str | None) -> str | None:
    """The narrower of the types that hold both; text holds all."""
    if a == b or b is None:
        return a
    if a is None:
        return b
    return "double" if {a, b} == {"bigint", "double"} else "string"


def _column_names(header: str | None, sep: str) -> list[str]:
    """Names of a header line; those that repeat get ``.1``, ``.2``, … as in pandas."""
    names: list[str] = []
    for n in next(csv.reader([(header or "").removeprefix("\ufeff")], delimiter=sep)):
        k, name = 0, n
        while name in names:
            k += 1
            name = f"{n}.{k}"
        names.append(name)
    return names


class HeaderGroup(NamedTuple):
    names: list[str]
    files: list[str]        # read whole, a task each
    large: list[str]        # read by many tasks each
    crlf: bool              # lines end in a carriage return and a line feed


def split_bytes(spark: SparkSession) -> int:
    """The size beyond which a file is more than one task's input."""
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))


def header_groups(spark: SparkSession, paths: str | Sequence[str], sep: str, encoding: str = "UTF-8") -> list[HeaderGroup]:
    """Column names and files for each different header line among ``paths``.

    The first line of each file is found by one scan of the files' first
    blocks. Where all files have one header and none is large, ``paths``
    stand as they were given, and no file passes through the driver. UTF-8
    files of more than a task's input are listed apart.
    """
    paths = _paths(paths)
    lines = (spark.read.option("recursiveFileLookup", "true").options(sep="\u0001", quote="", escape="", encoding=encoding, lineSep="\n")
             .schema("value string").csv([literal(p) for p in paths]))
    heads = (lines.select("value", F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_block_start").alias("b"), F.col("_metadata.file_size").alias("size"))
             .filter("b = 0").withColumn("i", F.monotonically_increasing_id())     # ascends within a file's block
             .groupBy("p").agg(F.min_by("value", "i").alias("h"), F.max("size").alias("size")))
    many = split_bytes(spark) if encoding.upper() in ("UTF-8", "UTF8") else 1 << 62
    heads = heads.select("p", "size", F.substring_index("h", "\r", 1).alias("h"), F.coalesce(F.rlike("h", F.lit("^[^\r]*\r$")), F.lit(False)).alias("crlf"))
    kinds = heads.groupBy("h").agg(F.max("size").alias("size")).limit(2).collect()
    if not kinds:
        return []
    if len(kinds) == 1 and kinds[0]["size"] <= many:
        return [HeaderGroup(_column_names(kinds[0].h, sep), paths, [], False)]
    found: dict[tuple, HeaderGroup] = {}
    for r in heads.orderBy("p").toLocalIterator():
        key = (r.h, r.crlf and r["size"] > many)
        group = found.setdefault(key, HeaderGroup(_column_names(r.h, sep), [], [], key[1]))
        (group.large if r["size"] > many else group.files).append(unquote(r.p))
    return list(found.values())


def _parsed_records(spark: SparkSession, group: HeaderGroup, sep: str) -> DataFrame:
    """The rows of a group's large files as text, with their file path as ``_path``; each file's header line is left out."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in group.names])
    rows = quoted_records(spark, group.large, sep, crlf=group.crlf).select(
        "path", F.from_csv("record", schema.toDDL(), {"sep": sep, "escape": '"', "multiLine": "true"}).alias("r"))
    return rows.select("r.*", F.col("path").alias("_path"))


def read_header_text(spark: SparkSession, paths: str | Sequence[str], sep: str, *, encoding: str = "UTF-8",
                     na_values: Iterable[str] | None = PANDAS_NA_VALUES, file_col: str | None = None) -> DataFrame:
    """Header-named read, every column as text.

    Files are read by the header they have and put together by name, so
    column order may differ from file to file and a column may be absent
    (NULL). Quoted values may hold line breaks: a file is one task, unless
    it is larger than a task's input and UTF-8, when its records are cut by
    many (:func:`quoted_records`). Missing-value strings become NULL (P7).
    """
    parts = []
    for group in header_groups(spark, paths, sep, encoding):
        schema = T.StructType([T.StructField(n, T.StringType()) for n in group.names])
        if group.files:
            df = (spark.read.schema(schema).options(sep=sep, header="true", escape='"', encoding=encoding, multiLine="true")
                  .option("recursiveFileLookup", "true").csv([literal(p) for p in group.files]))
            parts.append(df.select("*", F.col("_metadata.file_path").alias(file_col)) if file_col else df)
        if group.large:
            df = _parsed_records(spark, group, sep)
            parts.append(df.withColumnRenamed("_path", file_col) if file_col else df.drop("_path"))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(file_col, T.StringType())] if file_col else []))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cols = [c for c in df.columns if c != file_col]
    df = df.select(*cols, *([file_col] if file_col else []))
    return null_out(df, na_values, cols) if na_values else df


def header_records(spark: SparkSession, paths: str | Sequence[str], sep: str, encoding: str = "UTF-8") -> DataFrame:
    """Every record of the files, header lines included, with its file path;
    a quoted line break does not end a record. Only the first field is read."""
    return (spark.read.schema("value string").options(sep=sep, escape='"', encoding=encoding, multiLine="true")
            .option("recursiveFileLookup", "true").csv([literal(p) for p in _paths(paths)])
            .select("value", F.col("_metadata.file_path").alias("_file")))


def read_header_file(spark: SparkSession, paths: str | Sequence[str], sep: str, *,
                     schema: T.StructType | str | None = None,
                     na_values: Iterable[str] | None = PANDAS_NA_VALUES,
                     infer: bool = True, encoding: str = "UTF-8",
                     file_col: str | None = None) -> DataFrame:
    """Header-named delimited read (:func:`read_header_text`), typed.

    With a declared ``schema`` its columns are taken by name and cast (what
    does not parse is NULL), and the inference pass is skipped (preferred
    at scale); otherwise types are inferred (:func:`infer_types`). Quotes
    follow common CSV (``""`` inside quotes), not Spark's ``\\``.
    ``file_col`` adds each row's file path under that name.
    """
    df = read_header_text(spark, paths, sep, encoding=encoding, na_values=na_values, file_col=file_col)
    if schema is not None:
        fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
        cols = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        return df.select(*cols, *([file_col] if file_col else []))
    return infer_types(df, [c for c in df.columns if c != file_col]) if infer else df


def read_snapshot(spark: SparkSession, paths, **kw) -> DataFrame:
    """S3: tab-separated panelist snapshot with a header."""
    return read_header_file(spark, paths, "\t", **kw)


def read_compliance(spark: SparkSession, paths, **kw) -> DataFrame:
    """Comma-separated compliance report with a header."""
    return read_header_file(spark, paths, ",", **kw)
