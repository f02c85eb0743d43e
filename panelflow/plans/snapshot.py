"""Panelist snapshot refresh.

newest delivery (S5) → header read with inferred types (S3, P7) → compact
date (P5) → load time in second place (P3) → full refresh of the snapshot
table (K2) → append never-seen respondents to the frozen table (K3).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.functions.columns import add_import_datetime, parse_compact_date
from panelflow.operators.gates import run_outcome
from panelflow.plans.outcome import RunLog, logged
from panelflow.schemas import SNAPSHOT_DATE, SNAPSHOT_KEY, SNAPSHOT_LOADED
from panelflow.sinks.files import archive_files
from panelflow.sinks.tables import append_new, replace_table
from panelflow.sources.files import latest_file
from panelflow.sources.header import read_snapshot


@dataclass
class SnapshotResult:
    outcome: DataFrame      # Q4's row, with the delivery that was loaded


def snapshot_refresh(spark: SparkSession, landing: str, contains: str, snapshot: str | None,
                     frozen: str | None, *, key: str = SNAPSHOT_KEY,
                     date_col: str | None = SNAPSHOT_DATE,
                     now: _dt.datetime | None = None, archive_dir: str | None = None,
                     jdbc_snapshot: Mapping | None = None, jdbc_frozen: Mapping | None = None,
                     schema: str | None = None, log: RunLog | None = None) -> DataFrame:
    """Refresh ``snapshot`` from the newest matching delivery, then add rows
    of respondents ``frozen`` has never held (frozen rows never change).

    The frozen table is created from the snapshot on the first run. Either
    table may be a JDBC one (its options in ``jdbc_snapshot`` and
    ``jdbc_frozen``). With ``archive_dir`` the processed files are moved
    there with the run time added to their names. Returns Q4's outcome row
    with the delivery's path; an exception is an ``ERROR`` row.
    """
    def outcome(path: str | None, **kw) -> SnapshotResult:
        return SnapshotResult(run_outcome(spark, [], [], **kw).withColumn("file", F.lit(path).cast("string")))

    def run() -> SnapshotResult:
        path = latest_file(spark, landing, contains)
        if path is None:
            return outcome(None, error=f"no file containing {contains!r}")
        df = read_snapshot(spark, path, schema=schema)
        if date_col and date_col in df.columns:
            df = parse_compact_date(df, date_col)
        df = add_import_datetime(df, SNAPSHOT_LOADED, now=now, position=1)
        replace_table(df, snapshot, spark=spark, jdbc=jdbc_snapshot)
        fresh = spark.read.parquet(snapshot) if jdbc_snapshot is None else spark.read.format("jdbc").options(**jdbc_snapshot).load()
        append_new(fresh, frozen, key, spark=spark, jdbc=jdbc_frozen)
        if archive_dir:   # the processed files, stamped with the run time
            stamp = (now or _dt.datetime.now(_dt.timezone.utc)).strftime("_%Y-%m-%d %H-%M-%S")
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
            archive_files(spark, files, archive_dir, suffix=stamp, root=landing).collect()
        return outcome(path, n_rows=fresh.count())
    return logged(spark, log, "snapshot refresh", run, lambda error: outcome(None, error=error)).outcome
