"""Time the per-date load pattern against panelflow's one-plan load.

    python tools/per_date_pattern.py [SF_DIR]

Both load the same derived delivery (``events`` as one UTF-16 file set per
day, whole table) into parquet on one machine:

* per-date pattern (how the reference ran: written here from its
  description, none of its code is used): for each day one Spark read with
  the fixed schema, stamp columns, append, a ``count()``, then a line count
  of the raw file in Python on the driver;
* ``usage_load``: every day in one plan, per-date replace, counts on
  executors.

Prints one JSON line with both times and rows loaded.
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

import panelflow.queries as q  # noqa: E402
from panelflow.plans.usage_load import usage_load  # noqa: E402
from panelflow.session import get_session, staging_path  # noqa: E402


def per_date(spark, landing: str, feed, target: str) -> tuple[int, list]:
    checks = []
    total = 0
    root = landing.replace("file:", "", 1)
    for day_dir in sorted(glob.glob(f"{root}/day=*")):
        day = day_dir.rsplit("=", 1)[1]
        files = sorted(glob.glob(f"{day_dir}/*.csv"))
        df = (spark.read.schema(feed.schema).options(sep="\t", header="false", encoding=feed.encoding,
                                                     lineSep="\n", **feed.options).csv(files)
              .withColumn("ref_date", F.lit(day).cast("date"))
              .withColumn("import_date", F.current_date()))
        df = df.select("ref_date", "import_date", *[c for c in df.columns if c not in ("ref_date", "import_date")])
        df.write.mode("append").parquet(target)
        n = df.count()
        lines = 0
        for fp in files:
            with open(fp, encoding="utf-16-le") as fh:
                lines += sum(1 for ln in fh.readlines() if ln.strip() != "")
        checks.append({"ref_date": day, "count df": n, "count raw file": lines})
        total += n
    return total, checks


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", "per-date-pattern", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    feed = q.EVENTS.with_(encoding="UTF-16LE")
    landing = q.stage_events(spark, sf_dir, feed)
    days = q._event_days(spark, sf_dir)
    usage_load(spark, landing, feed, days, target=staging_path(spark, "warm"), match="day")  # warm-up
    t = time.perf_counter()
    n_loop, checks = per_date(spark, landing, feed, staging_path(spark, "per-date"))
    t_loop = time.perf_counter() - t
    t = time.perf_counter()
    res = usage_load(spark, landing, feed, days, target=staging_path(spark, "one-plan"),
                     import_day=dt.date.today(), match="day")
    n_plan = res.outcome.first().n_rows
    t_plan = time.perf_counter() - t
    ok = all(c["count df"] == c["count raw file"] for c in checks)
    print(json.dumps({"sf": os.path.basename(sf_dir), "days": len(checks),
                      "per_date_sec": round(t_loop, 2), "one_plan_sec": round(t_plan, 2),
                      "rows_per_date": n_loop, "rows_one_plan": n_plan, "per_date_counts_match": ok}))


if __name__ == "__main__":
    main(sys.argv)
