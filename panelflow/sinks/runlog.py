"""K5: run log as an append-only event table.

``log_start`` opens a run (status and message, new id); ``log_status``
records a later status for that id. The current state of each run is its
latest event, found by an aggregate (no window, no update in place).
``compact_log`` folds the many one-event files into a base, while events go on
being written.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.sinks.paths import delete, files, folders, rename

_BASE = "_base"          # beside the event files; plain reads pass over such names
ROWS_A_FILE = 1 << 20    # events in a base file at most: a file is too well compressed to be cut by its bytes
_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
EVENT_SCHEMA = ("log_id string, task_id int, status int, log_time timestamp, "
                "message string, seq bigint")


def _utc(t: _dt.datetime | None) -> _dt.datetime:
    """A zone-aware time (now if none); a time without a zone is UTC. Naive
    values would be read in the machine's zone."""
    t = t or _dt.datetime.now(_dt.timezone.utc)
    return t if t.tzinfo else t.replace(tzinfo=_dt.timezone.utc)


def _append(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], EVENT_SCHEMA).write.mode("append").parquet(path)


def log_start(spark: SparkSession, path: str, task_id: int, status: int, message: str,
              now: _dt.datetime | None = None) -> tuple[int, str]:
    """Open a run; returns ``(1, log_id)`` as the reference's insert did."""
    log_id = str(uuid.uuid4()).upper()
    _append(spark, path, (log_id, int(task_id), int(status), _utc(now), message, 0))
    return 1, log_id


def log_status(spark: SparkSession, path: str, log_id: str | None, status: int, message: str,
               task_id: int | None = None, now: _dt.datetime | None = None) -> None:
    """Record a new status for a run; a blank id is rejected. The message
    is stored as data (no SQL text is built, so quotes need no escaping)."""
    if log_id is None or not str(log_id).strip():
        raise ValueError("log_id is blank")
    t = _utc(now)
    seq = (t - _EPOCH) // _dt.timedelta(microseconds=1)
    _append(spark, path, (str(log_id), task_id, int(status), t, message, seq))


def append_events(events: DataFrame, path: str) -> None:
    """Append many run-log events at once (same columns as EVENT_SCHEMA);
    e.g. when a scheduler's history is loaded in bulk."""
    cols = [c.split()[0] for c in EVENT_SCHEMA.split(", ")]
    events.select(*cols).write.mode("append").parquet(path)


def _bases(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published bases, ascending."""
    return sorted(int(n) for n in folders(spark, f"{path}/{_BASE}") if n.isdigit())


def _folded(spark: SparkSession, path: str, base: int | None) -> set[str]:
    """Names of the event files that ``base`` holds."""
    return {r.name for r in spark.read.schema("name string").parquet(f"{path}/{_BASE}/{base}/files").collect()} if base is not None else set()


def _level(spark: SparkSession, path: str, base: int | None, tail: list[str]) -> DataFrame:
    events = spark.read.schema(EVENT_SCHEMA)
    parts = [f"{path}/{_BASE}/{base}/events"] if base is not None else []
    return events.parquet(*parts, *[f"{path}/{n}" for n in tail]) if parts or tail else spark.createDataFrame([], EVENT_SCHEMA)


def log_events(spark: SparkSession, path: str) -> DataFrame:
    """Every event of the log: the latest base and the event files written since."""
    path = path.rstrip("/")
    base = next(reversed(_bases(spark, path)), None)
    if base is None:
        return spark.read.schema(EVENT_SCHEMA).parquet(path)
    held = _folded(spark, path, base)
    return _level(spark, path, base, [n for n in files(spark, path) if n not in held])


def compact_log(spark: SparkSession, path: str, parts: int | None = None) -> None:
    """Fold the event files there are now into a new base of ``parts`` tasks' files (by default as the rows need).

    No file holds more than ROWS_A_FILE events, so that a large base is
    written and read by many tasks.

    The log has two levels. A base holds the events of the files it names;
    the tail is every other file. A new base is written aside and renamed
    into its place, so a reader finds the old or the new one whole, and
    events may be written meanwhile: their files are in no base yet. Files
    go when a base that names them is the one before the latest, so that
    who still reads that base finds all it needs. One compaction runs at a
    time.
    """
    path = path.rstrip("/")
    bases = _bases(spark, path)
    last = bases[-1] if bases else None
    there, held = files(spark, path), _folded(spark, path, last)
    tail = [n for n in there if n not in held]
    if not tail:
        return
    new = f"{path}/{_BASE}/.new-{uuid.uuid4().hex}"
    try:
        events = _level(spark, path, last, tail)
        parts = parts or max(1, -(-events.count() // ROWS_A_FILE))
        events.coalesce(parts).write.option("maxRecordsPerFile", ROWS_A_FILE).parquet(f"{new}/events")
        spark.createDataFrame([(n,) for n in there], "name string").coalesce(1).write.parquet(f"{new}/files")
        rename(spark, new, f"{path}/{_BASE}/{(last or 0) + 1}")
    except BaseException:
        delete(spark, new)
        raise
    for n in held:                          # named by the base before, and by this one
        delete(spark, f"{path}/{n}")
    for old in bases[:-1]:
        delete(spark, f"{path}/{_BASE}/{old}")


def current_runs(spark: SparkSession, path: str) -> DataFrame:
    """Each run's latest status and message, its task and start time.

    A latest event holds text, so it is found by sorting; events are dealt
    out by run first, so that a task sorts its share of the runs and not
    whatever its files hold.
    """
    ev = log_events(spark, path).repartition("log_id")
    return (ev.groupBy("log_id").agg(
        F.max(F.struct("seq", "status", "message", "log_time")).alias("last"),
        F.min_by("task_id", "seq").alias("task_id"),
        F.min("log_time").alias("started"))
        .select("log_id", "task_id", F.col("last.status").alias("status"),
                F.col("last.message").alias("message"), "started",
                F.col("last.log_time").alias("log_time")))
