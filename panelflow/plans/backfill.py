"""D1 over many days, in steps that a later run takes up.

A step loads some of the days left (:func:`usage_load`, per-date replace) and
then adds a commit row for each of them. A run that was killed is started
again with the same request: the days that have a commit row are left out by
an anti join. A step killed between its load and its commit rows is loaded
again, over what it had written, so a day's rows are there once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.operators.gates import run_outcome
from panelflow.plans.outcome import RunLog, logged
from panelflow.plans.usage_load import RECON_SCHEMA, LoadResult, deliveries, usage_load
from panelflow.schemas import Feed, feed as _feed
from panelflow.sinks.paths import exists
from panelflow.sources.files import expected_files

# state: loaded, or empty (delivered without a character, and passed over)
COMMIT_SCHEMA = "ref_date date, state string, count_df bigint, count_raw bigint, matched boolean, committed timestamp"


def committed(spark: SparkSession, commits: str) -> DataFrame:
    """The latest commit row of each day."""
    if not exists(spark, commits):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    rows = spark.read.schema(COMMIT_SCHEMA).parquet(commits)
    return rows.groupBy("ref_date").agg(F.max_by(F.struct("state", "count_df", "count_raw", "matched", "committed"), "committed").alias("c")).select("ref_date", "c.*")


def backfill(spark: SparkSession, landing: str, feed: Feed | str, days, *, target: str, commits: str,
             days_a_step: int = 31, steps: int | None = None, today: _dt.date | None = None, match: str = "name",
             glob: str | None = None, layout: str | None = None, archive_dir: str | None = None, log: RunLog | None = None, **kw) -> LoadResult:
    """Load the requested days that are not committed, ``days_a_step`` at a time, oldest first.

    ``days`` and the options are those of :func:`usage_load` in mode
    ``replace``; ``commits`` is a table of its own, for one target. Before
    the first step all days left are checked: one without a delivery ends the
    run as ``ERROR`` with nothing loaded, and so, without an error, does an
    empty one under the ``all_or_nothing`` policy. A step that fails ends the
    run; the steps before it stay committed. ``steps`` bounds one run, for
    schedules that have a window. The outcome covers every day of the request
    that is committed by then.
    """
    f = _feed(feed)
    where = {"match": match, "glob": glob, "layout": layout, "archive_dir": archive_dir}

    def rows(requested: DataFrame) -> list:
        return committed(spark, commits).join(requested, "ref_date", "left_semi").orderBy("ref_date").collect()     # one row a day

    def result(requested: DataFrame, error: str | None = None, missing=(), empty=()) -> LoadResult:
        done = rows(requested)
        recon = [(r.ref_date, r.count_df, r.count_raw, r.matched) for r in done if r.state == "loaded"]
        skipped = sorted({*empty, *(r.ref_date for r in done if r.state == "empty")})
        return LoadResult(run_outcome(spark, [r[0] for r in recon], recon, missing=missing, empty=skipped, error=error), spark.createDataFrame(recon, RECON_SCHEMA), [])

    def run() -> LoadResult:
        requested = expected_files(spark, days, f, today=today)
        left = requested.join(committed(spark, commits), "ref_date", "left_anti").select("ref_date", "file_name")
        names = {r.ref_date: r.file_name for r in left.collect()}      # one row a day
        found = deliveries(spark, landing, f, names, match, glob, layout, archive_dir).days if names else {}
        missing = sorted(set(names) - set(found))
        if missing:
            return result(requested, "missing delivery", missing)
        empty = sorted(d for d, n in found.items() if n.files == n.empty)
        if empty and f.policy == "all_or_nothing":
            return result(requested, empty=empty)
        todo = sorted(names)
        chunks = [todo[k:k + days_a_step] for k in range(0, len(todo), days_a_step)][:steps]
        for chunk in chunks:
            step = usage_load(spark, landing, f, chunk, target=target, mode="replace", today=today, **where, **kw)
            out = step.outcome.first()
            if out.status == "ERROR":
                return result(requested, out.error)
            now = _dt.datetime.now(_dt.timezone.utc)
            loaded = {r.ref_date: r for r in step.reconcile.collect()}
            commit = [(d, "loaded", loaded[d].count_df, loaded[d].count_raw, loaded[d].matched, now) if d in loaded else (d, "empty", 0, 0, None, now) for d in chunk]
            spark.createDataFrame(commit, COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(commits)
        return result(requested)

    def failed(error: str) -> LoadResult:
        return LoadResult(run_outcome(spark, [], [], error=error), spark.createDataFrame([], RECON_SCHEMA), [])
    return logged(spark, log, f"backfill of {f.name}", run, failed)
