"""Pick up only new delivery files, load each once, archive the sources."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelflow.functions.columns import add_import_date, place_columns
from panelflow.functions.dates import day_from_path, parse_path_day
from panelflow.operators.gates import run_outcome
from panelflow.operators.reconcile import DayCounts
from panelflow.plans.outcome import RunLog, logged
from panelflow.schemas import Feed, feed as _feed
from panelflow.session import staging_path
from panelflow.sinks.files import archive_files
from panelflow.sinks.paths import delete, exists, folders, qualified
from panelflow.sinks.tables import append_table
from panelflow.sources.files import norm, path_key, run_day
from panelflow.sources.header import read_header_file, read_header_text
from panelflow.sources.usage import FILE_COL, raw_lines, typed_lines, with_ref_date
from panelflow.streaming import ledger

SOURCE_FILE = "source_file"      # which file a row came from, in tables replaced by file
LOAD_ID = "load_id"              # the micro-batch that wrote a row; the table's folders are load_id=…/<day>
FILES_A_BATCH = 10_000           # files of a micro-batch unless the caller asks for fewer
RECON_SCHEMA = "ref_date date, count_df bigint, count_raw bigint, matched boolean"

# The stream follows the ledger's own files, which the file source would
# forget when they are a week older than the newest one.
_NEVER = "36500d"


@dataclass
class IngestResult:
    outcome: DataFrame              # Q4: one row: status, loaded days, rows, matched
    reconcile: DataFrame            # J4 per day: count_df, count_raw, matched
    query: StreamingQuery | None    # the finished stream over the ledger


def _stamped(df: DataFrame, f: Feed, import_day: _dt.date | None) -> DataFrame:
    df = add_import_date(df, f.import_col, today=import_day or run_day())
    return place_columns(df, [f.ref_col, f.import_col], 0)


def _below(root: str) -> Column:
    """A row's file, as its path below the landing folder."""
    # a file path in a row is URL-encoded, but for the plus sign
    path = path_key(F.url_decode(F.replace(FILE_COL, F.lit("+"), F.lit("%2B"))))
    return F.substring(path, len(root) + 1, 1 << 30)


def read_files(spark: SparkSession, paths: list[str], f: Feed, types: str | None = None, counts: DayCounts | None = None) -> DataFrame:
    """Rows of delivered files with their reference date and file path.

    Header feeds are read by name; without a declared schema (the feed's or
    ``types``) their columns stay text, so that every file fits one table.
    UTF-16 files are read in the byte order of their mark. ``counts`` are
    taken while the rows pass: raw lines and parsed rows of headerless feeds,
    rows of header feeds.
    """
    if f.header:
        schema = f.schema if f.schema is not None else types
        df = (read_header_file(spark, paths, f.sep, schema=schema, encoding=f.encoding, file_col=FILE_COL) if schema is not None
              else read_header_text(spark, paths, f.sep, encoding=f.encoding, file_col=FILE_COL))
        df = df.withColumn(f.ref_col, day_from_path(F.col(FILE_COL), f.file_day_format))
    else:
        lines = raw_lines(spark, paths, f)
        df = with_ref_date(typed_lines(counts.raw(lines, f) if counts else lines, f), f)
    return counts.parsed(df, f.ref_col) if counts else df


def _forget(spark: SparkSession, target: str, f: Feed, files: list[str], days: list, load_id: int) -> None:
    """Remove the rows that ``files`` have in earlier loads; only day folders that hold one are written again.

    A file's rows lie in the day of its path, so only the files' days are
    looked into. Done twice, it finds nothing the second time; a folder left
    without a row goes, as dynamic overwrite would keep it.
    """
    table = spark.read.parquet(target)
    names = spark.createDataFrame([(x,) for x in files], f"{SOURCE_FILE} string")
    old = table.where((F.col(LOAD_ID) != load_id) & (F.col(f.ref_col).isin(days) | F.col(f.ref_col).isNull()))
    hit = old.join(names, SOURCE_FILE, "left_semi").select(LOAD_ID, f.ref_col).distinct().collect()      # day folders, not rows
    if not hit:
        return
    folder = F.lit(False)
    for r in hit:
        folder = folder | ((F.col(LOAD_ID) == r[LOAD_ID]) & F.col(f.ref_col).eqNullSafe(F.lit(r[f.ref_col]).cast("date")))
    stage = staging_path(spark, "ingest-kept")
    try:
        old.where(folder).join(names, SOURCE_FILE, "left_anti").write.partitionBy(LOAD_ID, f.ref_col).parquet(stage)
        kept = {(a, b) for a in folders(spark, stage) if "=" in a for b in folders(spark, f"{stage}/{a}")}
        if kept:
            (spark.read.schema(table.schema).parquet(stage).select(*table.columns).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_ID, f.ref_col).parquet(target))
        for r in hit:
            day = "__HIVE_DEFAULT_PARTITION__" if r[f.ref_col] is None else r[f.ref_col]
            if (f"{LOAD_ID}={r[LOAD_ID]}", f"{f.ref_col}={day}") not in kept:
                delete(spark, f"{target}/{LOAD_ID}={r[LOAD_ID]}/{f.ref_col}={day}")
    finally:
        delete(spark, stage)


def ingest_new_files(spark: SparkSession, landing: str, feed: Feed | str, target: str | None,
                     checkpoint: str, *, import_day: _dt.date | None = None,
                     archive_dir: str | None = None,
                     max_files_per_trigger: int | None = None,
                     mode: str = "append", jdbc: Mapping | None = None,
                     types: str | None = None, log: RunLog | None = None) -> IngestResult:
    """Load every file version not yet loaded and stop (``availableNow``).

    Replaces the daily loop, the date list and the file moves: run it on a
    schedule, one run at a time. A run lists ``landing`` and adds the new
    file versions (path, modification time, length) to a ledger below
    ``checkpoint``; a stream follows the ledger, and each of its micro-batches
    loads the files of one ledger file. A run without new files adds nothing;
    a late file is loaded whatever its age, and so is one delivered again at
    its path. A retried batch first removes what it had written. The
    checkpoint belongs in the shared folder.

    Any feed, UTF-16 in either byte order, with or without a header. The
    table has a folder for each load and in it one for each reference date,
    however many files they take. ``mode``:

    * ``append``: every version's rows are added; none is ever removed.
    * ``replace_files``: rows carry their file, as its path below ``landing``
      (``source_file``), and those of a new version replace those of the one
      before. A version without rows leaves none. Files of one name in two
      folders are two files.
    * ``jdbc`` given: each micro-batch is appended to the JDBC table (K1);
      a batch retried after a failure may be appended twice.

    With ``archive_dir`` the loaded files are moved there after the run, below
    the folders they lay in; of a file delivered again the new version gets
    the run's number in its name. A file that changed since its load stays,
    for the next run. ``archive_dir`` may lie inside ``landing``.

    The result holds one outcome row (Q4) and per-day counts of parsed rows
    beside raw lines, taken while the files are read; an error ends the run
    as ``ERROR`` and its batch is taken up by the next run. With ``log`` the
    run is opened and closed in a run log.
    """
    f = _feed(feed)
    if mode not in ("append", "replace_files"):
        raise ValueError(f"unknown mode {mode!r}")
    checkpoint = checkpoint.rstrip("/")
    table_of_versions = f"{checkpoint}/versions"
    root = qualified(spark, landing).rstrip("/") + "/"
    target = target.rstrip("/") if target else None
    parsed: dict[_dt.date, int] = {}
    raw: dict[_dt.date, int] = {}
    broken: list[Exception] = []        # what ended the batch: the stream's own error names only itself

    def load(batch: DataFrame, load_id: int) -> None:
        try:
            load_files(batch, load_id)
        except Exception as e:
            broken.append(e)
            raise

    def load_files(batch: DataFrame, load_id: int) -> None:
        session = batch.sparkSession
        files = ledger.current(batch, ledger.versions(session, table_of_versions)).collect()      # a micro-batch's files
        if jdbc is None:
            delete(session, f"{target}/{LOAD_ID}={load_id}")
        if not files:
            return
        days = {parse_path_day(r.path, f.file_day_format) for r in files} - {None}
        counts = DayCounts(len(days))
        df = _stamped(read_files(session, [r.path for r in files], f, types, counts).withColumn(SOURCE_FILE, _below(root)).drop(FILE_COL), f, import_day)
        if jdbc is not None:
            append_table(df.drop(SOURCE_FILE), jdbc=jdbc)
        else:
            df = df if mode == "replace_files" else df.drop(SOURCE_FILE)
            df.write.partitionBy(f.ref_col).parquet(f"{target}/{LOAD_ID}={load_id}")
            again = [path[len(root):] for r in files if r.again and (path := norm(r.path)).startswith(root)]
            if mode == "replace_files" and again:
                _forget(session, target, f, again, sorted(days), load_id)
        for d, n in counts.parsed_days().items():
            parsed[d] = parsed.get(d, 0) + n
        for d, n in (counts.parsed_days() if f.header else counts.raw_days()).items():
            raw[d] = raw.get(d, 0) + n

    def failed(error: str) -> IngestResult:
        return IngestResult(run_outcome(spark, sorted(parsed), [], error=error, n_rows=sum(parsed.values())), spark.createDataFrame([], RECON_SCHEMA), None)

    def run() -> IngestResult:
        ledger.record_new(spark, landing, table_of_versions, max_files_per_trigger or FILES_A_BATCH, archive_dir)
        new = (spark.readStream.schema(ledger.SCHEMA).option("maxFilesPerTrigger", "1").option("maxFileAge", _NEVER).parquet(table_of_versions))
        q = new.writeStream.option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).foreachBatch(load).start()
        try:
            q.awaitTermination()
        except StreamingQueryException:
            if broken:
                raise broken[0] from None
            raise
        if archive_dir:
            _archive(spark, landing, table_of_versions, archive_dir)
        recon = [(d, parsed.get(d, 0), None if f.header else raw.get(d, 0), None if f.header else parsed.get(d, 0) == raw.get(d, 0))
                 for d in sorted({*parsed, *raw})]
        return IngestResult(run_outcome(spark, sorted(parsed), recon), spark.createDataFrame(recon, RECON_SCHEMA), q)

    return logged(spark, log, f"ingest of {f.name}", run, failed)


def _archive(spark: SparkSession, landing: str, table_of_versions: str, archive_dir: str) -> None:
    """Move the files whose version in the landing folder is the one that was loaded."""
    done = ledger.listed(spark, landing, ledger.versions(spark, table_of_versions), archive_dir).where("known")
    again = ledger.versions(spark, table_of_versions).where("again").select(path_key(F.col("path")).alias("key")).distinct()
    named = done.withColumn("key", path_key(F.col("path")))
    for files, suffix in ((named.join(again, "key", "left_anti"), ""), (named.join(again, "key", "left_semi"), "seen.run")):
        if suffix:
            for r in files.groupBy("seen.run").count().collect():      # one row for each run that brought them
                archive_files(spark, files.where(F.col("seen.run") == r.run).select("path"), archive_dir, f".{r.run}", landing).collect()
        else:
            archive_files(spark, files.select("path"), archive_dir, root=landing).collect()
