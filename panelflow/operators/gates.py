"""Load gates and run outcome: Q1 empty, Q2 missing, Q3 plan, Q4 outcome."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.functions.dates import day_from_path
from panelflow.operators.keys import valid_dates
from panelflow.schemas import Feed, feed as _feed
from panelflow.sources.files import path_key, scan_files

# A byte-order mark has at most four bytes, so no longer file is mark-only.
_MARK_MAX_BYTES = 4


def mark_only(content: Column, encoding: str) -> Column:
    """Does ``content`` hold no character beside one leading byte-order mark?

    UTF-16 is decoded as its mark says, little-endian without one."""
    if encoding.upper().replace("_", "-").startswith("UTF-16"):
        big = F.hex(F.substring(content, 1, 2)) == "FEFF"
        text = F.when(big, F.decode(content, "UTF-16BE")).otherwise(F.decode(content, "UTF-16LE"))
    else:
        text = F.decode(content, encoding)
    return F.length(F.regexp_replace(text, "^\ufeff", "")) == 0


def with_day(listing: DataFrame, feed: Feed | str, col: str = "ref_date") -> DataFrame:
    """Listing rows with the delivery day read from each path."""
    f = _feed(feed)
    return listing.withColumn(col, day_from_path(F.col("path"), f.file_day_format))


def empty_feeds(spark: SparkSession, paths: str | Sequence[str], feed: Feed | str,
                glob: str | None = None, listing: DataFrame | None = None,
                relation: DataFrame | None = None) -> DataFrame:
    """Q1: delivered files that hold no characters.

    Empty means zero bytes, or nothing left once decoded in the feed's
    charset and stripped of one byte-order mark. Only files that short are
    decoded: the length filter is pushed into the ``binaryFile`` scan, so
    no other file's content is read.
    Pass the ``relation`` of a :func:`scan_files` listing to reuse it.
    """
    f = _feed(feed)
    if relation is None:
        scan = scan_files(spark, paths, glob)
        relation = scan.relation
        lst = listing if listing is not None else scan.files
    else:
        lst = listing
    tiny = (relation.filter(F.col("length") <= _MARK_MAX_BYTES)
            .filter(mark_only(F.col("content"), f.encoding))
            .select(path_key(F.col("path")).alias("__k")))
    marked = lst.join(tiny, path_key(F.col("path")) == F.col("__k"), "left_semi")
    zero = lst.filter(F.col("length") == 0)
    return with_day(zero.unionByName(marked), f)


def missing_feeds(expected: DataFrame, listed: DataFrame, on: str = "ref_date") -> DataFrame:
    """Q2: expected deliveries with no file listed (by day, or by name)."""
    return expected.join(listed.select(on).distinct(), on, "left_anti")


def load_plan(expected: DataFrame, empty: DataFrame, policy: str = "skip_empty",
              col: str = "ref_date") -> DataFrame:
    """Q3: the days to load.

    ``skip_empty`` loads every expected day whose file is not empty (X1);
    ``all_or_nothing`` loads none when any expected file is empty. The
    any-empty test is one scalar aggregate, not a window over all rows.
    """
    if policy not in ("skip_empty", "all_or_nothing"):
        raise ValueError(f"unknown policy {policy!r}")
    days = valid_dates(expected, empty, col)
    if policy == "all_or_nothing":
        none_empty = empty.select(F.count(F.lit(1)) == 0).scalar()
        days = days.filter(none_empty)
    return days


OUTCOME_SCHEMA = ("status string, loaded_dates string, skipped_dates string, missing_dates string, "
                  "n_rows bigint, all_matched boolean, checks string, error string")


def _days(rows: DataFrame | Iterable | None, col: str) -> list[str]:
    """Sorted days as text, of a per-day frame or a list of days."""
    if isinstance(rows, DataFrame):
        rows = [r[0] for r in rows.select(col).collect()]
    return sorted({str(d) for d in rows or () if d is not None})


def run_outcome(spark: SparkSession, plan: DataFrame | Iterable, recon: DataFrame | Iterable,
                missing: DataFrame | Iterable | None = None, empty: DataFrame | Iterable | None = None,
                error: str | None = None, col: str = "ref_date", n_rows: int | None = None) -> DataFrame:
    """Q4: one row per run in place of the reference's mails.

    ``ERROR`` on an exception or a missing delivery, ``WARNING`` when an
    expected file was empty (loaded or not, per policy) or a day's counts
    differ, else ``OK``; with loaded days, skipped days, rows loaded,
    whether every day's parsed count equals its raw line count (unknown if
    unchecked), and the per-day counts as JSON (``checks``) for a reader to
    compare. Inputs have one row per requested day, as small frames or
    lists; the row is put together from them without a job of its own.
    """
    if isinstance(recon, DataFrame):
        recon = recon.select(col, "count_df", "count_raw", "matched").collect()
    recon = sorted(tuple(r) for r in recon)
    matched = [m for *_, m in recon]
    all_matched = False if False in matched else None if None in matched else True
    loaded, skipped, lacking = _days(plan, col), _days(empty, col), _days(missing, col)
    status = "ERROR" if error is not None or lacking else "WARNING" if skipped or all_matched is False else "OK"
    checks = [{k: v for k, v in ((col, str(d)), ("count_df", a), ("count_raw", b)) if v is not None} for d, a, b, _ in recon]
    rows = sum(a for _, a, _, _ in recon) if n_rows is None else n_rows
    return spark.createDataFrame([(status, ",".join(loaded), ",".join(skipped), ",".join(lacking), rows, all_matched,
                                   json.dumps(checks, separators=(",", ":")), error)], OUTCOME_SCHEMA)
