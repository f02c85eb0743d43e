"""D1 (and D3): a day-list load of one feed, as a handful of Spark jobs.

expected deliveries (S7) → one listing of the requested files → missing
(Q2), empty (Q1) and plan (Q3) from its per-day rows → read all planned
files at once (S1/S2, or S4) → stamp (P1, P2, P4) → write (K4 per-date
replace, K1 append, or JDBC) → reconcile (A1/A2/J4) → outcome (Q4). No loop
over dates: the date is taken from each file path.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.functions.columns import add_import_date, place_columns
from panelflow.functions.dates import day_from_path
from panelflow.operators.gates import mark_only, run_outcome
from panelflow.operators.reconcile import DayCounts
from panelflow.plans.outcome import RunLog, logged
from panelflow.schemas import Feed, feed as _feed
from panelflow.session import staging_path
from panelflow.sinks.files import archive_files
from panelflow.sinks.paths import exists
from panelflow.sinks.tables import append_table, load_dates, replace_table
from panelflow.sources.archive import OUT_SCHEMA, archive_members
from panelflow.sources.files import expected_files, list_files, literal, norm, path_key, run_day
from panelflow.sources.header import header_records, narrowest_types, read_header_file, read_header_text, wider
from panelflow.sources.usage import DAY_COL, FILE_COL, raw_lines, read_usage, typed_lines, with_ref_date

RECON_SCHEMA = "ref_date date, count_df bigint, count_raw bigint, matched boolean"


@dataclass
class LoadResult:
    outcome: DataFrame      # one row: status, loaded/skipped/missing days, rows, matched
    reconcile: DataFrame    # per day: count_df, count_raw, matched
    loaded_files: list[str]                # files, or day folders, that were read
    delivered: DataFrame | None = None     # ref_date, path, empty: every file of the request, loaded or empty


def _failed(spark: SparkSession, error: str, missing=()) -> LoadResult:
    return LoadResult(run_outcome(spark, [], [], missing=missing, error=error), spark.createDataFrame([], RECON_SCHEMA), [])


def _load(spark: SparkSession, patterns: list[str], glob: str | None) -> DataFrame | None:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        return (r.option("pathGlobFilter", glob) if glob else r).load(patterns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class Delivered(NamedTuple):
    """A day's delivery: how many files it has, and how many of them are empty (Q1)."""
    files: int
    empty: int


class Deliveries(NamedTuple):
    days: dict[_dt.date, Delivered]
    files: DataFrame        # ref_date, path, empty: a row for each file of the request, computed when used


def _listed(spark: SparkSession, rel: DataFrame) -> DataFrame:
    """Every file of a ``binaryFile`` relation, zero-byte ones too, as ``path``; the list stays in Spark's JVM."""
    names = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(rel._jdf.inputFiles())
    paths = DataFrame(spark._jsparkSession.createDataset(names, spark._jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark)
    return paths.select(F.url_decode(F.replace("value", F.lit("+"), F.lit("%2B"))).alias("path"))


def deliveries(spark: SparkSession, landing: str, f: Feed, expected: dict[_dt.date, str], match: str = "name",
               glob: str | None = None, layout: str | None = None, exclude: str | None = None) -> Deliveries:
    """By expected day, how many files were delivered and how many are empty (Q1).

    ``match="name"``: a file belongs when it lies in ``landing`` itself under
    an expected name (several feeds may share one landing folder).
    ``match="day"``: any file below ``landing`` (narrowed by ``glob``) whose
    path carries an expected day; with ``layout``, such as ``day={day}``,
    only the expected days' folders are listed. What lies below ``exclude``,
    the archive, never belongs. The files are listed once and counted by one
    aggregate, so the driver gets a row for each day; their content is read
    only where a file is so short that it may be a lone byte-order mark.
    """
    nothing = Deliveries({}, spark.createDataFrame([], "ref_date date, path string, empty boolean"))
    root = literal(landing.rstrip("/"))
    if match == "name":
        names = sorted(expected.values())
    elif match == "day":
        names = sorted(layout.replace("{day}", _format_day(d, f.file_day_format)) for d in expected) if layout else None
    else:
        raise ValueError(f"unknown match {match!r}")
    if names is not None and not names:
        return nothing
    if names is None:
        patterns = [root]
    else:
        some = [literal(n) for n in names]
        patterns = [f"{root}/{some[0]}" if len(some) == 1 else f"{root}/{{{','.join(some)}}}"]
    rel = _load(spark, patterns, glob)
    if rel is None:
        return nothing
    # a zero-byte file has a name but no row
    key, below = path_key(F.col("path")), norm(exclude).rstrip("/") + "/" if exclude else None
    if match == "name":
        ours = F.regexp_extract("path", "([^/]*)$", 1).isin(names)
    else:
        ours = day_from_path(F.col("path"), f.file_day_format).isin(sorted(expected))

    def of_request(paths: DataFrame) -> DataFrame:
        kept = paths.select(key.alias("k"), "path").where(ours)
        kept = kept.where(~F.col("k").startswith(below)) if below else kept
        return kept.select("k", "path", day_from_path(F.regexp_extract("path", "([^/]*)$", 1) if match == "name" else F.col("path"), f.file_day_format).alias("ref_date"))

    listed, full = of_request(_listed(spark, rel)), of_request(rel)
    tiny = of_request(rel.filter((F.col("length") <= 4) & mark_only(F.col("content"), f.encoding)))
    kinds = [part.select("ref_date", F.lit(kind).alias("kind")) for kind, part in enumerate((listed, full, tiny))]
    n = [F.count_if(F.col("kind") == kind) for kind in range(3)]
    days = reduce(DataFrame.union, kinds).groupBy("ref_date").agg(n[0].alias("files"), (n[0] - n[1] + n[2]).alias("empty")).collect()      # a row a day
    files = (listed.join(full.select("k", F.lit(True).alias("full")), "k", "left").join(tiny.select("k", F.lit(True).alias("tiny")), "k", "left")
             .select("ref_date", "path", (F.col("full").isNull() | F.col("tiny").isNotNull()).alias("empty")))
    return Deliveries({r.ref_date: Delivered(r.files, r.empty) for r in days if r.ref_date in expected}, files)


def _format_day(d: _dt.date, fmt: str) -> str:
    text = fmt.replace("yyyy", f"{d:%Y}").replace("MM", f"{d:%m}").replace("dd", f"{d:%d}")
    return text.replace("'", "")


def conform(spark: SparkSession, df: DataFrame, target: str | None, cols: list[str]) -> DataFrame:
    """Text columns ``cols`` in the target's types, so that every load of a table reads back with one schema.

    A value that does not fit its column's type widens the column once, in
    the table too (rewritten and swapped in); so does a new column. Without
    a table yet, types are inferred; a column without a value is text until
    one comes.
    """
    types = narrowest_types(df, cols)
    if target is None or not exists(spark, target):
        return df.select(*[F.col(c).try_cast(types[c] or "string").alias(c) if c in types else F.col(c) for c in df.columns])
    table = spark.read.parquet(target)
    have = {x.name: x.dataType.simpleString() for x in table.schema.fields}
    want = {c: wider(have.get(c), types[c]) or "string" for c in types}
    if any(have.get(c) != t for c, t in want.items()):
        cast = [F.col(c).cast(want.get(c, have[c])).alias(c) for c in table.columns]
        new = [F.lit(None).cast(t).alias(c) for c, t in want.items() if c not in have]
        replace_table(table.select(*cast, *new), target, spark=spark)
    lost = [F.lit(None).cast(have[c]).alias(c) for c in have if c not in df.columns]
    out = df.select(*[F.col(c).try_cast(want[c]).alias(c) if c in want else F.col(c) for c in df.columns], *lost)
    return out


def _read(spark: SparkSession, paths: list[str], f: Feed, target: str | None, counts: DayCounts, check_raw: bool) -> tuple[DataFrame, DataFrame | None]:
    """The files' typed rows with their reference date, counted as they pass; the records of a header feed, to be counted beside them.

    The lines of a headerless feed are counted and parsed in one read.
    """
    records = None
    if f.header:
        if f.schema is not None:
            df = read_header_file(spark, paths, f.sep, schema=f.schema, encoding=f.encoding, file_col=FILE_COL)
        else:
            df = read_header_text(spark, paths, f.sep, encoding=f.encoding, file_col=FILE_COL)
            df = conform(spark, df, target, [c for c in df.columns if c not in (FILE_COL, f.ref_col, f.import_col)])
            df = df.drop(f.ref_col, f.import_col)
        df = df.withColumn(f.ref_col, day_from_path(F.col(FILE_COL), f.file_day_format))
        records = header_records(spark, paths, f.sep, f.encoding)
    elif check_raw:
        lines = raw_lines(spark, paths, f).withColumn(DAY_COL, day_from_path(F.col(FILE_COL), f.file_day_format))
        df = typed_lines(counts.raw(lines, f, day=F.col(DAY_COL)), f, DAY_COL)
        df = with_ref_date(df, f, F.col(DAY_COL)).drop(DAY_COL)
    else:
        df = read_usage(spark, paths, f)
    return counts.parsed(df, f.ref_col), records


def _counts(df: DataFrame, col: str, name: str) -> dict[_dt.date, int]:
    return {r[col]: r[name] for r in df.collect() if r[col] is not None}


def _usage_load(spark: SparkSession, landing: str, f: Feed, days, target, mode, jdbc, import_day, today,
                match, glob, layout, check_raw, archive_dir) -> LoadResult:
    today = today or run_day()
    expected = {r.ref_date: r.file_name for r in expected_files(spark, days, f, today=today).collect()}
    got = deliveries(spark, landing, f, expected, match, glob, layout, archive_dir)
    missing = sorted(set(expected) - set(got.days))
    if missing:
        return _failed(spark, "missing delivery", missing)
    empty = sorted(d for d, n in got.days.items() if n.files == n.empty)
    plan = [] if empty and f.policy == "all_or_nothing" else sorted(set(expected) - set(empty))
    if not plan:
        return LoadResult(run_outcome(spark, plan, [], empty=empty), spark.createDataFrame([], RECON_SCHEMA), [], got.files)
    if match == "day" and layout and not glob:      # day folders are read by their names, whatever the number of their files
        where = [f"{landing.rstrip('/')}/{layout.replace('{day}', _format_day(d, f.file_day_format))}" for d in plan]
    elif match == "name":
        where = [f"{landing.rstrip('/')}/{expected[d]}" for d in plan]
    else:
        where = sorted(r.path for r in got.files.where(~F.col("empty") & F.col("ref_date").isin(plan)).select("path").toLocalIterator())
    counts = DayCounts(len(expected))
    df, records = _read(spark, where, f, target if jdbc is None else None, counts, check_raw)
    df = place_columns(add_import_date(df.drop(FILE_COL), f.import_col, today=import_day or today), [f.ref_col, f.import_col], 0)
    if jdbc is not None:
        append_table(df, jdbc=jdbc)
    elif mode == "replace":
        load_dates(df, target, f.ref_col, days=plan)
    elif mode == "append":
        append_table(df, target, partition_by=[f.ref_col])
    else:
        raise ValueError(f"unknown mode {mode!r}")
    parsed = counts.parsed_days()
    if check_raw:
        if f.header:   # every delivered file starts with one header line
            n = records.groupBy(day_from_path(F.col(FILE_COL), f.file_day_format).alias("d")).agg(F.count("*").alias("n"))
            raw = {d: k - got.days[d].files + got.days[d].empty for d, k in _counts(n, "d", "n").items() if d in got.days}
        else:
            raw = counts.raw_days()
        recon = [(d, parsed.get(d, 0), raw.get(d, 0), parsed.get(d, 0) == raw.get(d, 0)) for d in sorted({*parsed, *raw, *plan})]
    else:
        recon = [(d, parsed.get(d, 0), None, None) for d in plan]
    return LoadResult(run_outcome(spark, plan, recon, empty=empty), spark.createDataFrame(recon, RECON_SCHEMA), where, got.files)


def usage_load(spark: SparkSession, landing: str, feed: Feed | str, days=None, *,
               target: str | None = None, mode: str = "replace", jdbc: Mapping | None = None,
               import_day: _dt.date | None = None, today: _dt.date | None = None,
               match: str = "name", glob: str | None = None, layout: str | None = None, check_raw: bool = True,
               archive_dir: str | None = None, log: RunLog | None = None) -> LoadResult:
    """Load the requested days of a feed from a landing folder.

    ``days``: DataFrame / list / ``(first, last)`` / None (see S7).
    ``mode``: ``replace`` (K4, safe to repeat; a day delivered without a row
    is cleared), ``append`` (K1) or JDBC append when ``jdbc`` is given. The
    feed's ``policy`` decides what an empty file does (Q3). A missing
    delivery ends the run as ``ERROR`` without loading anything, as in the
    reference; so does any exception, with its text. ``match``, ``glob`` and
    ``layout``: see :func:`deliveries`. Rows and raw lines are counted per
    day in the pass that loads them; a header feed's records by a pass of
    their own. With ``check_raw=False`` lines and records are not counted;
    ``count_raw`` and ``matched`` are then NULL. With
    ``archive_dir`` the request's delivered files (loaded or empty) are
    moved there after a run that did not fail, below the folders they lay
    in. ``today`` is the run's day (UTC), for default days and for the
    import date. With ``log`` the run is opened and closed in a run log.
    """
    f = _feed(feed)

    def run() -> LoadResult:
        res = _usage_load(spark, landing, f, days, target, mode, jdbc, import_day, today, match, glob, layout, check_raw, archive_dir)
        if archive_dir and res.delivered is not None and res.outcome.first().status != "ERROR":
            archive_files(spark, res.delivered.select("path"), archive_dir, root=landing).write.format("noop").mode("overwrite").save()
        return res
    return logged(spark, log, f"load of {f.name}", run, lambda error: _failed(spark, error))


def extract_deliveries(spark: SparkSession, archives: str, feed: Feed | str, days=None, *,
                       out_dir: str | None = None, today: _dt.date | None = None) -> DataFrame:
    """S7 → Q2 → S6 for archived deliveries: one row per expected day with
    ``archive_found``, ``member_found`` and the extracted file's path.

    Only the expected archives are opened; each is read by one task and
    its member streamed to ``out_dir`` (default: a fresh folder in the
    shared folder).
    """
    f = _feed(feed)
    out_dir = out_dir or staging_path(spark, f"{f.name}-extracted")
    expected = expected_files(spark, days, f, today=today)
    lst = list_files(spark, archives, "*.zip").select("path", F.col("file_name").alias("archive_name"))
    present = expected.join(lst, "archive_name", "left")
    paths = [r.path for r in present.filter(F.col("path").isNotNull()).select("path").collect()]
    if paths:
        got = archive_members(spark, paths, f.archive_member, out_dir, f)
    else:
        got = spark.createDataFrame([], OUT_SCHEMA)
    got = got.select(path_key(F.col("archive")).alias("__a"), "found", "out_path")
    return (present.join(got, path_key(F.col("path")) == F.col("__a"), "left")
            .select("ref_date", "archive_name", "file_name",
                    F.col("path").isNotNull().alias("archive_found"),
                    F.coalesce(F.col("found"), F.lit(False)).alias("member_found"),
                    "out_path", F.lit(out_dir).alias("out_dir")))


def daily_load(spark: SparkSession, archives: str, feed: Feed | str, days=None, *,
               target: str | None = None, work_dir: str | None = None, **kw) -> LoadResult:
    """D1 / D3 from archives: extract the expected members, then
    :func:`usage_load` the extracted files. A missing archive or member
    ends the run as ``ERROR`` before anything is loaded."""
    f = _feed(feed)
    return daily_loads(spark, archives, [f], days, targets={f.name: target}, work_dir=work_dir, **kw)[f.name]


def daily_loads(spark: SparkSession, archives: str, feeds: list[Feed | str], days=None, *,
                targets: Mapping[str, str], work_dir: str | None = None, **kw) -> dict[str, LoadResult]:
    """D1 for several feeds delivered in the same archives (App, Web and
    Media come in one zip per day): every archive is opened once for all
    members, then each feed is loaded from the shared extraction folder
    (file names differ per feed). A feed whose member is missing ends as
    ``ERROR``; the others still load."""
    fs = [_feed(f) for f in feeds]
    try:
        work_dir = work_dir or staging_path(spark, "usage-extracted")
        expected = expected_files(spark, days, fs[0], today=kw.get("today"))
        by_archive = {r.archive_name: r.ref_date for r in expected.collect()}   # one row per requested day
        lst = list_files(spark, archives, "*.zip").select("path", "file_name")
        paths = [r.path for r in lst.filter(F.col("file_name").isin(list(by_archive))).collect()]
        got = archive_members(spark, paths, [f.archive_member for f in fs], work_dir, fs).collect() if paths else []
    except Exception as e:  # noqa: BLE001
        text = f"{type(e).__name__}: {(str(e).splitlines() or [''])[0][:500]}"
        return {f.name: _failed(spark, text) for f in fs}
    out = {}
    for f in fs:
        have = {by_archive[re.sub("^.*/", "", unquote(r.archive))] for r in got if r.member == f.archive_member and r.found}
        missing = sorted(set(by_archive.values()) - have)
        if missing:
            out[f.name] = _failed(spark, "missing archive or member", missing)
        else:
            out[f.name] = usage_load(spark, work_dir, f, days, target=targets[f.name], **kw)
    return out
