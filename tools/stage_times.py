"""Summarise a Spark event log: jobs, stages and task time per job group.

    python tools/stage_times.py EVENT_LOG_FILE_OR_DIR [--top N]

Reads the JSON-lines event log Spark writes with ``spark.eventLog.enabled``
(no UI or REST server involved) and prints, per job group (bench.py uses the
query name), the number of jobs and stages, wall time of its jobs, and the
summed task run time.
"""

from __future__ import annotations

import collections
import json
import os
import sys


def _events(path):
    """Events of a log file, or of every log under a folder (Spark 4 writes
    rolling logs as ``eventlog_v2_<app>/events_<n>_<app>`` files)."""
    if os.path.isdir(path):
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                       if f.startswith("events_") or (d == path and not f.startswith(".")))
    else:
        files = [path]
    for fp in files:
        if fp.endswith(".zstd"):    # Spark's default event-log codec
            import io

            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(open(fp, "rb"))
            fh = io.TextIOWrapper(raw, encoding="utf-8")
        else:
            fh = open(fp, encoding="utf-8")
        with fh:
            for line in fh:
                if line.startswith("{"):
                    yield json.loads(line)


def summarise(path):
    group_of_job, job_start, stages_of_job = {}, {}, {}
    stage_job = {}
    per = collections.defaultdict(lambda: {"jobs": 0, "stages": 0, "job_ms": 0, "task_ms": 0})
    for e in _events(path):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            g = props.get("spark.jobGroup.id") or "(none)"
            jid = e["Job ID"]
            group_of_job[jid] = g
            job_start[jid] = e["Submission Time"]
            ids = e.get("Stage IDs") or []
            stages_of_job[jid] = ids
            for s in ids:
                stage_job[s] = jid
            per[g]["jobs"] += 1
            per[g]["stages"] += len(ids)
        elif ev == "SparkListenerJobEnd":
            jid = e["Job ID"]
            g = group_of_job.get(jid, "(none)")
            per[g]["job_ms"] += e["Completion Time"] - job_start.get(jid, e["Completion Time"])
        elif ev == "SparkListenerTaskEnd":
            g = group_of_job.get(stage_job.get(e["Stage ID"]), "(none)")
            m = e.get("Task Metrics") or {}
            per[g]["task_ms"] += m.get("Executor Run Time", 0)
    return per


def main(argv):
    top = int(argv[argv.index("--top") + 1]) if "--top" in argv else 50
    per = summarise(argv[1])
    print(f"{'group':28s} {'jobs':>5s} {'stages':>6s} {'job s':>8s} {'task s':>8s}")
    for g, v in sorted(per.items(), key=lambda kv: -kv[1]["job_ms"])[:top]:
        print(f"{g:28s} {v['jobs']:5d} {v['stages']:6d} {v['job_ms'] / 1000:8.2f} {v['task_ms'] / 1000:8.2f}")


if __name__ == "__main__":
    main(sys.argv)
