"""Projections: P1 … P7."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelflow.functions.dates import parse_day

# --- fixed values: strings pandas' read_csv treats as missing by default ----
PANDAS_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# ----------------------------------------------------------------------------


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d.cast("date")
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.lit(d).cast("date")


def place_columns(df: DataFrame, names: Sequence[str], position: int = 0) -> DataFrame:
    """Put ``names`` at ``position``; every other column keeps its order."""
    rest = [c for c in df.columns if c not in set(names)]
    position = max(0, min(position, len(rest)))
    return df.select(*rest[:position], *names, *rest[position:])


def add_ref_date(df: DataFrame, ref_date, name: str = "ref_date",
                 position: int | None = None) -> DataFrame:
    """The reference date as a ``date`` column (literal or a Column)."""
    out = df.withColumn(name, _date_lit(ref_date))
    return out if position is None else place_columns(out, [name], position)


def add_import_date(df: DataFrame, name: str = "import_date", today=None,
                    position: int | None = None) -> DataFrame:
    """The load date; ``current_date()`` unless a fixed day is given."""
    val = F.current_date() if today is None else _date_lit(today)
    out = df.withColumn(name, val)
    return out if position is None else place_columns(out, [name], position)


def add_import_datetime(df: DataFrame, name: str = "Data_Import_Datetime",
                        now=None, position: int = 1) -> DataFrame:
    """Load time as ``yyyy-MM-dd HH:mm:ss`` text, second column by default."""
    if now is None:
        val = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    elif isinstance(now, _dt.datetime):
        val = F.lit(now.strftime("%Y-%m-%d %H:%M:%S"))
    else:
        val = F.lit(str(now))
    return place_columns(df.withColumn(name, val), [name], position)


# --- fixed values: how pandas' to_datetime(format='%Y%m%d') reads a day ------
# Python's strptime fields: %Y four digits, %m 1-12 with an optional leading
# zero, %d 1-31 with an optional leading zero or space; whole text must match.
PY_COMPACT_DAY = r"^(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])$"
# the days a nanosecond pandas Timestamp can hold at midnight
PANDAS_FIRST_DAY, PANDAS_LAST_DAY = "1677-09-22", "2262-04-11"
# ----------------------------------------------------------------------------


def parse_compact_date(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """P5: ``yyyyMMdd`` text → date as pandas' ``to_datetime(format='%Y%m%d',
    errors='coerce')`` reads it: single-digit month or day accepted
    (``2023517``), anything else (``bad``, ``20231301``, ``20230230``,
    ``20230517.0``) or outside pandas' date range → NULL."""
    t = F.col(col).cast("string")
    part = [F.regexp_extract(t, PY_COMPACT_DAY, i) for i in (1, 2, 3)]
    iso = F.concat_ws("-", part[0], F.lpad(part[1], 2, "0"), F.lpad(F.trim(part[2]), 2, "0"))
    # eight digits can only split 4-2-2, so the plain pattern reads them
    # the same way; the field-by-field path is for the shorter forms
    day = (F.when(t.rlike(r"^[0-9]{8}$"), parse_day(t, "yyyyMMdd"))
           .when(t.rlike(PY_COMPACT_DAY), parse_day(iso, "yyyy-MM-dd")))
    inside = day.between(F.lit(PANDAS_FIRST_DAY).cast("date"), F.lit(PANDAS_LAST_DAY).cast("date"))
    return df.withColumn(out or col, F.when(inside, day))


def date_key(c: Column | str, to: str, frm: str | None = None,
             days: int = 0) -> Column:
    """A day rendered in another layout, optionally shifted by ``days``.

    ``frm`` is the layout of text input (``yyyy_MM_dd`` …); date and
    timestamp input need none. ``to`` is a datetime pattern such as
    ``yyyy-MM-dd`` or ``yyyyMMdd'T'000000'Z'``.
    """
    c = F.col(c) if isinstance(c, str) else c
    day = parse_day(c, frm) if frm else c.cast("date")
    if days:
        day = F.date_add(day, days)
    return F.date_format(day, to)


def null_out(df: DataFrame, na_values: Iterable[str] = PANDAS_NA_VALUES,
             columns: Iterable[str] | None = None) -> DataFrame:
    """Missing-value strings → NULL in string columns, before typing."""
    na = list(na_values)
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = strings if columns is None else strings & set(columns)
    return df.select(*[
        F.when(F.col(c).isin(na), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in targets else F.col(c)
        for c in df.columns])
