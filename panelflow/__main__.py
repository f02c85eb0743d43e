"""Command line for the scheduled jobs (one JSON outcome line per feed).

    python -m panelflow usage --feed app --archives DIR --target DIR [--days A..B | --days A,B]
    python -m panelflow usage --feed app --landing DIR --target DIR
    python -m panelflow usage --feed app,web,media --archives DIR --target-root DIR
    python -m panelflow snapshot --landing DIR --contains NAME --snapshot DIR --frozen DIR
    python -m panelflow gate --log DIR --requirements FILE.json --day D [--calendar DIR]
    python -m panelflow ingest --feed app --landing DIR --target DIR --checkpoint DIR

Without ``--days`` a feed loads its default day (yesterday for usage, today
for compliance). The exit status is 0 for OK, 1 for WARNING, 2 for ERROR.
"""

from __future__ import annotations

import argparse
import json
import sys

from panelflow.schemas import FEEDS, SNAPSHOT_KEY

_EXIT = {"OK": 0, "WARNING": 1, "ERROR": 2}


def _days(text: str | None):
    if not text:
        return None
    if ".." in text:
        a, b = text.split("..", 1)
        return (a, b)
    return [d for d in text.split(",") if d]


def _options(path: str | None) -> dict | None:
    """JDBC options from a JSON file."""
    if path is None:
        return None
    with open(path) as fh:
        return {k: str(v) for k, v in json.load(fh).items()}


def _emit(name: str, row) -> int:
    d = row.asDict()
    d["feed"] = name
    print(json.dumps(d, default=str))
    return _EXIT.get(d.get("status"), 2)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="panelflow")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    u = sub.add_parser("usage", help="load feeds for a day list (D1/D3)")
    u.add_argument("--feed", required=True, help="one or more of " + ",".join(FEEDS))
    src = u.add_mutually_exclusive_group(required=True)
    src.add_argument("--archives")
    src.add_argument("--landing")
    u.add_argument("--target")
    u.add_argument("--target-root")
    u.add_argument("--days")
    u.add_argument("--mode", default="replace", choices=["replace", "append"])
    u.add_argument("--jdbc", help="JSON file of JDBC options (url, dbtable, ...): append there instead of --target")
    u.add_argument("--layout", help="with --landing: day folders below it, such as day={day}")
    u.add_argument("--log", help="run log (sinks.runlog) to open and close the run in")
    u.add_argument("--task-id", type=int, default=0, help="the run's task in --log")
    u.add_argument("--archive-dir", help="move the request's delivered files here after the load")
    u.add_argument("--no-raw-check", action="store_true",
                   help="skip the independent raw line count (a second pass over the input)")

    s = sub.add_parser("snapshot", help="panelist snapshot refresh (D2)")
    s.add_argument("--landing", required=True)
    s.add_argument("--contains", required=True)
    s.add_argument("--snapshot")
    s.add_argument("--frozen")
    s.add_argument("--jdbc-snapshot", help="JSON file of JDBC options: the snapshot table is there")
    s.add_argument("--jdbc-frozen", help="JSON file of JDBC options: the frozen table is there")
    s.add_argument("--key", default=SNAPSHOT_KEY)
    s.add_argument("--log", help="run log (sinks.runlog) to open and close the run in")
    s.add_argument("--task-id", type=int, default=0, help="the run's task in --log")
    s.add_argument("--archive-dir", help="move the processed file here, stamped with the run time")

    g = sub.add_parser("gate", help="may the gated tasks run (D4)")
    g.add_argument("--log", required=True, help="run log written by sinks.runlog")
    g.add_argument("--requirements", required=True,
                   help='JSON list of {"gate_id":…, "task_id":…, "allowed":[…]}')
    g.add_argument("--day", required=True)
    g.add_argument("--calendar", help="parquet table with a 'holiday' column")
    g.add_argument("--include-weekend", type=int, default=1)
    g.add_argument("--as-of", action="store_true", help="take runs of earlier days too")

    i = sub.add_parser("ingest", help="load new files only (T1)")
    i.add_argument("--feed", required=True)
    i.add_argument("--landing", required=True)
    i.add_argument("--target", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--archive-dir")
    i.add_argument("--mode", default="append", choices=["append", "replace_files"])
    i.add_argument("--log", help="run log (sinks.runlog) to open and close the run in")
    i.add_argument("--task-id", type=int, default=0, help="the run's task in --log")

    a = p.parse_args(argv)
    from panelflow.plans.outcome import RunLog
    from panelflow.session import get_session
    spark = get_session(a.master)

    if a.cmd == "usage":
        from panelflow.plans.usage_load import daily_loads, usage_load
        names = a.feed.split(",")
        days = _days(a.days)
        if len(names) > 1 or a.target_root:
            root = (a.target_root or a.target).rstrip("/")
            targets = {n: f"{root}/{n}" for n in names}
        else:
            targets = {names[0]: a.target}
        kw = {"mode": a.mode, "check_raw": not a.no_raw_check, "archive_dir": a.archive_dir, "jdbc": _options(a.jdbc),
              "log": RunLog(a.log, a.task_id) if a.log else None}
        if a.archives:
            res = daily_loads(spark, a.archives, names, days, targets=targets, **kw)
        else:
            res = {n: usage_load(spark, a.landing, n, days, target=targets[n], layout=a.layout,
                                 match="day" if a.layout else "name", **kw) for n in names}
        return max(_emit(n, r.outcome.first()) for n, r in res.items())

    if a.cmd == "snapshot":
        from panelflow.plans.snapshot import snapshot_refresh
        return _emit("snapshot", snapshot_refresh(spark, a.landing, a.contains, a.snapshot, a.frozen,
                                                  key=a.key, archive_dir=a.archive_dir,
                                                  jdbc_snapshot=_options(a.jdbc_snapshot), jdbc_frozen=_options(a.jdbc_frozen),
                                                  log=RunLog(a.log, a.task_id) if a.log else None).first())

    if a.cmd == "gate":
        from pyspark.sql import functions as F

        from panelflow.plans.run_control import run_control
        from panelflow.sinks.runlog import current_runs
        with open(a.requirements) as fh:
            req = spark.createDataFrame(json.load(fh), "gate_id string, task_id int, allowed array<int>")
        log = current_runs(spark, a.log).drop("log_time").withColumn("log_time", F.col("started"))
        cal = spark.read.parquet(a.calendar) if a.calendar else None
        rows = run_control(log, req, a.day, calendar=cal, include_weekend=a.include_weekend, as_of=a.as_of).collect()
        for r in rows:
            print(json.dumps(r.asDict(), default=str))
        return 0 if all(r.may_run for r in rows) else 1

    if a.cmd == "ingest":
        from panelflow.streaming.ingest import ingest_new_files
        res = ingest_new_files(spark, a.landing, a.feed, a.target, a.checkpoint, archive_dir=a.archive_dir, mode=a.mode,
                               log=RunLog(a.log, a.task_id) if a.log else None)
        return _emit(a.feed, res.outcome.first())
    return 2


if __name__ == "__main__":
    sys.exit(main())
