"""Which versions of which delivered files a landing folder has shown.

A file version is (path, modification time, length). The ledger is an
append-only table of the versions found so far; a run lists the landing
folder and joins it with each path's latest version, so a file is new when
it was never seen, or when it came again at its path, whatever its age. Both
sides stay distributed: no path passes through the driver here.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.sinks.paths import exists
from panelflow.sources.files import list_files, path_key

# run orders the versions of a path; again: an earlier version of the path is in the ledger
SCHEMA = "path string, modified timestamp, length bigint, again boolean, run bigint"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions in the ledger (none before its first run)."""
    return spark.read.schema(SCHEMA).parquet(path) if exists(spark, path) else spark.createDataFrame([], SCHEMA)


def latest(seen: DataFrame) -> DataFrame:
    """Each path's latest version: ``key, seen`` (a struct of time, length and run)."""
    return seen.groupBy(path_key(F.col("path")).alias("key")).agg(F.max_by(F.struct("modified", "length", "run"), "run").alias("seen"))


def _same(now: str, then: str) -> Column:
    """Are two versions of a path the same? An empty file has no modification time in a listing."""
    return F.col(f"{now}modified").eqNullSafe(F.col(f"{then}.modified")) & F.col(f"{now}length").eqNullSafe(F.col(f"{then}.length"))


def listed(spark: SparkSession, landing: str, seen: DataFrame, exclude: str | None = None) -> DataFrame:
    """The files now under ``landing``: ``path, modified, length, seen`` (their latest version in the ledger)
    and ``known``, whether that is the version that lies there."""
    files = list_files(spark, landing, exclude=exclude).filter(~F.col("file_name").rlike("^[._]"))
    return (files.join(latest(seen), path_key(F.col("path")) == F.col("key"), "left")
            .withColumn("known", F.col("seen").isNotNull() & _same("", "seen")).select("path", "modified", "length", "seen", "known"))


def record_new(spark: SparkSession, landing: str, path: str, files_a_batch: int, exclude: str | None = None) -> None:
    """Add the versions under ``landing`` that the ledger lacks, ``files_a_batch`` to a file of the table, ordered by path."""
    seen = versions(spark, path)
    now = int(_dt.datetime.now(_dt.timezone.utc).timestamp() * 1e6)
    run = max(now, (seen.agg(F.max("run")).first()[0] or 0) + 1)
    new = (listed(spark, landing, seen, exclude).where("not known")
           .select("path", "modified", "length", F.col("seen").isNotNull().alias("again"), F.lit(run).cast("bigint").alias("run")))
    # paths come as they are read: decoded; the table's own files are never changed, so a stream may follow them by name
    new.orderBy("path").write.mode("append").option("maxRecordsPerFile", str(files_a_batch)).parquet(path)


def current(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """Those of ``batch`` whose path has no later version in the ledger, which a later batch brings."""
    key = path_key(F.col("path"))
    return (batch.withColumn("key", key).join(latest(seen), "key", "left")
            .where("seen is null or seen.run <= run").drop("key", "seen"))
