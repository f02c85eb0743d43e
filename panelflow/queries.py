"""

``events`` plays a usage delivery (its day = ``CAST(ts AS DATE)``),
``orders`` the run log (task = ``o_custkey``, log time = ``o_orderdate``,
log id = ``o_orderkey``, status F→1, O→2, P→3) and ``customer`` the
panelist snapshot. Each binding reads whole tables; file-based operators
first write the table out as a delivery in the shared folder and then run
on what was written, so their work grows with the table.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.fixtures import delivery, mark_empty, set_age, write_delivery, write_lines, zip_parts
from panelflow.functions.columns import (
    add_import_date, date_key, null_out, parse_compact_date, place_columns)
from panelflow.operators.control import (
    gate_passed, invalid_status_codes, is_holiday, latest_status, prerequisite_status,
    status_allowed)
from panelflow.operators.keys import new_keys, newest, valid_dates
from panelflow.operators.reconcile import parsed_count, raw_count, reconcile
from panelflow.operators.gates import empty_feeds, load_plan, missing_feeds, with_day
from panelflow.plans.run_control import run_control
from panelflow.plans.snapshot import snapshot_refresh
from panelflow.plans.backfill import backfill
from panelflow.plans.usage_load import usage_load
from panelflow.schemas import (
    COMPLIANCE, EVENTS, SNAPSHOT_LOADED, STAMP_DAY, STATUS_CODES, UNDERSCORE_DAY, Feed, _schema)
from panelflow.session import staging_path
from panelflow.sinks.paths import folders, rename
from panelflow.sinks.runlog import append_events, compact_log, current_runs
from panelflow.sinks.tables import (
    append_new, append_table, load_dates, replace_table, update_table)
from panelflow.sources.archive import archive_members
from panelflow.sources.files import expected_files, list_files
from panelflow.sources.header import read_compliance, read_snapshot
from panelflow.sources.sql import query_df, query_rows
from panelflow.sources.usage import raw_lines, read_usage
from panelflow.streaming.ingest import ingest_new_files

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
IMPORT_DAY = _dt.date(2024, 2, 1)
HOLIDAYS = ("2024-01-01", "2024-01-15")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status_code(c):
    return (F.when(c == "F", 1).when(c == "O", 2).otherwise(3)).cast("int")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` seen as a run log."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("task_id"), F.col("o_orderkey").alias("log_id"),
                    _status_code(F.col("o_orderstatus")).alias("status"),
                    F.col("o_orderdate").alias("log_time"), "o_orderpriority")


def stage_events(spark: SparkSession, sf_dir: str, feed=EVENTS) -> str:
    def build(path):
        return write_delivery(table(spark, sf_dir, "events").select(*EVENT_COLS), path, feed)
    return delivery(spark, sf_dir, ("events",), (feed.name, feed.encoding, repr(feed.options)), build)


# --- S1 / S2 ---------------------------------------------------------------

def q_usage_read(spark, sf_dir):
    path = stage_events(spark, sf_dir)
    return read_usage(spark, path, EVENTS).select(*EVENT_COLS)


def q_usage_read_utf16(spark, sf_dir):
    """Files of either byte order, marked or not, with line feeds or CRLF, in one delivery."""
    f = EVENTS.with_(encoding="UTF-16LE")

    def build(path):
        ev = table(spark, sf_dir, "events").select(*EVENT_COLS)
        # Java's "UTF-16" writes big-endian with a mark; the other two carry none
        for k, more in enumerate(({"encoding": "UTF-16"}, {"lineSep": "\r\n"}, {})):
            write_delivery(ev.filter(F.col("event_id") % 3 == k), path, f, mode="append", **more)
        return path
    path = delivery(spark, sf_dir, ("events",), ("events-utf16-mixed",), build)
    return read_usage(spark, path, f).select(*EVENT_COLS)


def q_permissive_read(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    # ``n`` as text: even ids whole, odd ids with '.5' (not an int → NULL);
    # ``ts`` is written as a third field the two-column schema drops
    txt = ev.select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string"))
                    .otherwise(F.concat(F.col("event_id").cast("string"), F.lit(".5"))).alias("n"),
                    "ts")
    f = EVENTS.with_(name="numbers", schema=_schema("event_id bigint, n int"))
    path = delivery(spark, sf_dir, ("events",), ("numbers",), lambda p: write_delivery(txt, p, f))
    return read_usage(spark, path, f).select("event_id", "n")


# --- P1 … P7 ---------------------------------------------------------------

def q_stamped(spark, sf_dir):
    path = stage_events(spark, sf_dir)
    df = read_usage(spark, path, EVENTS)          # ref_date from the file path (P1)
    df = add_import_date(df, "import_date", today=IMPORT_DAY)
    df = place_columns(df, ["ref_date", "import_date"], 0)
    return df.select("ref_date", "import_date", "event_id", "user_id", "event_type")


def q_compact_date(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    txt = ev.select("event_id", F.when(F.col("event_id") % 10 == 0, F.lit("bad"))
                    .otherwise(F.date_format("ts", "yyyyMMdd")).alias("d"))
    return parse_compact_date(txt, "d")


def q_date_key(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", date_key("ts", STAMP_DAY).alias("start_key"),
                     date_key("ts", UNDERSCORE_DAY).alias("day_key"))


def q_null_out(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    return null_out(ev, ["error"])


# --- A1 / A2 / J4 ----------------------------------------------------------

def q_parsed_count(spark, sf_dir):
    path = stage_events(spark, sf_dir)
    return parsed_count(read_usage(spark, path, EVENTS), "ref_date", name="n")


def q_reconcile(spark, sf_dir):
    """Flagship: UTF-16 delivery → typed read vs raw line scan, per day."""
    f = EVENTS.with_(encoding="UTF-16LE")
    path = stage_events(spark, sf_dir, f)
    parsed = parsed_count(read_usage(spark, path, f), "ref_date")
    raw = raw_count(raw_lines(spark, path, f), f.file_day_format, "ref_date")
    return reconcile(parsed, raw, "ref_date")


def q_reconcile_broken(spark, sf_dir):
    """A delivery with blank lines everywhere, and on every seventh day lines
    of a lone no-break space: a row for the parser, blank to the raw count."""
    def build(path):
        ev = table(spark, sf_dir, "events")
        day = F.date_format("ts", "yyyy-MM-dd").alias("day")
        row = F.concat_ws("\t", F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                          F.col("user_id").cast("string"), "event_type", F.col("value").cast("string"))
        odd = (F.dayofmonth("ts") % 7 == 0) & (F.col("event_id") % 5 == 0)
        lines = F.array(row, F.when(F.col("event_id") % 3 == 0, F.lit("  ")), F.when(odd, F.lit("\u00a0")))
        return write_lines(ev.select(day, F.explode(F.array_compact(lines)).alias("value")), path)
    path = delivery(spark, sf_dir, ("events",), ("events-broken",), build)
    parsed = parsed_count(read_usage(spark, path, EVENTS), "ref_date")
    return reconcile(parsed, raw_count(raw_lines(spark, path, EVENTS), EVENTS.file_day_format, "ref_date"), "ref_date")


# --- J1 / W1 / J2 / A3 / J3 / O1 / X1 / X2 ---------------------------------

def q_new_keys(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")))
    return new_keys(c, o, "c_custkey", "o_custkey")


def q_new_keys_null_target(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 7 > 0, F.col("o_custkey")).alias("k"))
    return new_keys(c, o, "c_custkey", "k")


def q_latest_status(spark, sf_dir):
    log = run_log(spark, sf_dir)
    return latest_status(log, "1996-12-31", as_of=True).select("task_id", "log_id", "status")


def q_latest_status_on_day(spark, sf_dir):
    """The last day of the log alone (``as_of=False``)."""
    log = run_log(spark, sf_dir)
    last = log.agg(F.max(F.col("log_time").cast("date"))).first()[0]
    return latest_status(log, last).select("task_id", "log_id", "status")


def q_prerequisite_status(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    req = c.select(F.col("c_custkey").alias("task_id"),
                   F.array(F.lit(1), F.lit(3)).alias("allowed"))
    latest = latest_status(run_log(spark, sf_dir), "1996-12-31", as_of=True)
    return prerequisite_status(req, latest).select("task_id", "status", "ok")


def q_gate_passed(spark, sf_dir):
    log = run_log(spark, sf_dir)
    latest = latest_status(log, task_col=["task_id", "o_orderpriority"])
    allowed = F.array(F.lit(1), F.lit(3))
    checked = latest.select(F.col("task_id").alias("gate_id"),
                            status_allowed("status", allowed).alias("ok"))
    return gate_passed(checked, "gate_id", "ok")


def q_is_holiday(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    dates = ev.select(F.col("ts").cast("date").alias("d")).distinct()
    cal = spark.createDataFrame([(h,) for h in HOLIDAYS], "holiday string")
    return is_holiday(dates, cal, 1).select("d", "is_holiday")


def q_newest(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return newest(ev, "ts", 10, "event_id")


# Days that are delivered empty (or not at all) in the gate bindings.
IS_BAD_DAY = "day(ts) % 5 = 0"


def q_valid_dates(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    req = ev.select(F.col("ts").cast("date").alias("d"))
    return valid_dates(req, ev.filter(IS_BAD_DAY).select(F.col("ts").cast("date").alias("d")), "d")


def q_invalid_status_codes(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    req = n.select("n_nationkey", F.array(F.col("n_regionkey"), F.col("n_nationkey") - 20).alias("allowed"))
    return invalid_status_codes(req).select("n_nationkey", "invalid")


# --- S3 / S4 / S7 / S8 -------------------------------------------------------

CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _write_header_file(df: DataFrame, path: str, sep: str) -> str:
    df.write.options(sep=sep, header="true", escape='"').csv(path)
    return path


def _with_missing(c: DataFrame) -> DataFrame:
    """The customer columns with missing-value texts in two of them."""
    c = c.select(*CUSTOMER_COLS)
    return (c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 10 == 0, F.lit("N/A")).otherwise(F.col("c_mktsegment")))
            .withColumn("c_acctbal", F.when(F.col("c_custkey") % 7 == 0, F.lit("null")).otherwise(F.col("c_acctbal").cast("string"))))


def q_snapshot_read(spark, sf_dir):
    c = _with_missing(table(spark, sf_dir, "customer"))
    path = delivery(spark, sf_dir, ("customer",), ("customer-tsv",), lambda p: _write_header_file(c, p, "\t"))
    return read_snapshot(spark, path).select(*CUSTOMER_COLS)


def q_compliance_read(spark, sf_dir):
    c = _with_missing(table(spark, sf_dir, "customer"))
    path = delivery(spark, sf_dir, ("customer",), ("customer-csv",), lambda p: _write_header_file(c, p, ","))
    return read_compliance(spark, path).select(*CUSTOMER_COLS)


def q_expected_files(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("d"))
    return expected_files(spark, days, EVENTS)


def q_query_df(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return query_df(spark, "SELECT o_orderpriority, count(*) AS n FROM orders "
                           "WHERE o_orderstatus = :status GROUP BY o_orderpriority", {"status": "F"})


def q_query_rows(spark, sf_dir):
    """One row after another on the driver, as a control step reads them."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    rows = query_rows(spark, "SELECT o_orderpriority, CAST(count(*) AS INT) AS n FROM orders WHERE o_orderstatus <> :status "
                             "GROUP BY o_orderpriority", {"status": "F"})
    return spark.createDataFrame([tuple(r) for r in rows], "o_orderpriority string, n int")


# --- Q1 … Q4 and D1 ----------------------------------------------------------

def _bad_days(ev: DataFrame) -> DataFrame:
    return (ev.filter(IS_BAD_DAY)
            .select(F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct())


def stage_events_with_gaps(spark, sf_dir, how: str = "empty") -> str:
    """``events`` delivered with its bad days empty (``how='empty'``) or
    left out (``how='missing'``)."""
    def build(path):
        ev = table(spark, sf_dir, "events").select(*EVENT_COLS)
        bad = _bad_days(ev)
        good = ev.join(bad, F.date_format("ts", "yyyy-MM-dd") == F.col("day"), "left_anti")
        write_delivery(good, path)
        if how == "empty":
            bad.mapInPandas(mark_empty(path), "day string").write.format("noop").mode("overwrite").save()
        return path
    return delivery(spark, sf_dir, ("events",), (f"events-{how}",), build)


def q_empty_feeds(spark, sf_dir):
    path = stage_events_with_gaps(spark, sf_dir, "empty")
    return empty_feeds(spark, path, EVENTS).select("ref_date")


def q_missing_feeds(spark, sf_dir):
    path = stage_events_with_gaps(spark, sf_dir, "missing")
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("d"))
    expected = expected_files(spark, days, EVENTS)
    listed = with_day(list_files(spark, path), EVENTS)
    return missing_feeds(expected, listed).select("ref_date")


def _plan(spark, sf_dir, policy, days=None):
    path = stage_events_with_gaps(spark, sf_dir, "empty")
    days = _event_days(spark, sf_dir) if days is None else days
    expected = expected_files(spark, days, EVENTS)
    empty = empty_feeds(spark, path, EVENTS).join(expected.select("ref_date"), "ref_date", "left_semi")
    return load_plan(expected.select("ref_date"), empty.select("ref_date"), policy)


def q_load_plan(spark, sf_dir):
    return _plan(spark, sf_dir, "skip_empty")


def q_load_plan_all_or_nothing(spark, sf_dir):
    """Two requests: the first four days of the month, none of them empty, and all days."""
    days = _event_days(spark, sf_dir)
    some, every = (_plan(spark, sf_dir, "all_or_nothing", d) for d in (days.filter("day(d) < 5"), days))
    return some.withColumn("request", F.lit("some")).union(every.withColumn("request", F.lit("every")))


def _event_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("d"))


def q_run_outcome(spark, sf_dir):
    path = stage_events_with_gaps(spark, sf_dir, "empty")
    target = staging_path(spark, "events-loaded")
    res = usage_load(spark, path, EVENTS, _event_days(spark, sf_dir), target=target,
                     import_day=IMPORT_DAY, match="day", layout="day={day}")
    return res.outcome.select("status", "loaded_dates", "skipped_dates", "n_rows", "all_matched")


LINEITEM = Feed("lineitem", _schema(
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz"),
    encoding="UTF-16LE", file_prefix="lineitem_",
    options={"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})


def q_backfill_load(spark, sf_dir):
    """D1 as a multi-year backfill: ``lineitem`` delivered as one UTF-16
    file set per ship day (thousands of days), every day loaded by one plan."""
    li = table(spark, sf_dir, "lineitem")
    landing = delivery(spark, sf_dir, ("lineitem",), ("lineitem",), lambda path: write_delivery(
        li, path, LINEITEM, day=F.date_format("l_shipdate", "yyyy-MM-dd"), spread=True))
    days = li.select(F.col("l_shipdate").cast("date").alias("d"))
    target = staging_path(spark, "lineitem-loaded")
    res = usage_load(spark, landing, LINEITEM, days, target=target, import_day=IMPORT_DAY, match="day", layout="day={day}")
    if res.outcome.first().status != "OK":
        raise RuntimeError("backfill did not load cleanly")
    return spark.read.parquet(target).select("ref_date", "l_orderkey", "l_linenumber", "l_quantity",
                                             "l_returnflag", "l_shipdate")


def q_compliance_load(spark, sf_dir):
    """D3: ``events`` delivered as daily header CSV files (``yyyy_MM_dd``
    days), types inferred as pandas would, all-or-nothing policy. Columns
    come in another order on even days, and some values hold a line break."""
    f = COMPLIANCE.with_(options={"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})

    def build(path):
        ev = table(spark, sf_dir, "events").select(*EVENT_COLS)
        ev = ev.withColumn("event_type", F.when(F.col("event_id") % 11 == 0, F.lit('two\nlines, "quoted"')).otherwise(F.col("event_type")))
        even = F.dayofmonth("ts") % 2 == 0
        day = F.date_format("ts", "yyyy_MM_dd")
        for part in (ev.filter(~even), ev.filter(even).select(*reversed(EVENT_COLS))):
            write_delivery(part, path, f, day=day, mode="append")
        return path
    landing = delivery(spark, sf_dir, ("events",), ("compliance",), build)
    target = staging_path(spark, "compliance-loaded")
    res = usage_load(spark, landing, f, _event_days(spark, sf_dir), target=target,
                     import_day=IMPORT_DAY, match="day", layout="day={day}")
    r = res.outcome.first()
    if r.status != "OK" or not r.all_matched:
        raise RuntimeError(f"compliance load did not run cleanly: {r}")
    return spark.read.parquet(target).select("ref_date", "import_date", *EVENT_COLS)


def q_usage_load(spark, sf_dir):
    path = stage_events(spark, sf_dir)
    target = staging_path(spark, "events-loaded")
    for _ in range(2):   # a repeated day list must not duplicate rows
        usage_load(spark, path, EVENTS, _event_days(spark, sf_dir), target=target,
                   import_day=IMPORT_DAY, match="day", layout="day={day}")
    return spark.read.parquet(target).select("ref_date", "import_date", *EVENT_COLS)


def q_resumed_backfill(spark, sf_dir):
    """A backfill in steps of nine days whose first run ends after one step; the second takes up the days left."""
    path = stage_events(spark, sf_dir)
    target, commits = staging_path(spark, "events-backfilled"), staging_path(spark, "backfill-commits")
    for steps in (1, None):
        backfill(spark, path, EVENTS, _event_days(spark, sf_dir), target=target, commits=commits, days_a_step=9, steps=steps,
                 import_day=IMPORT_DAY, match="day", layout="day={day}")
    return spark.read.parquet(target).select("ref_date", "import_date", *EVENT_COLS)


# --- K1 … K6, T1 ----------------------------------------------------------------

def q_append_table(spark, sf_dir):
    df = read_usage(spark, stage_events(spark, sf_dir), EVENTS).select(*EVENT_COLS)
    target = staging_path(spark, "append")
    append_table(df, target)
    return spark.read.parquet(target)


def q_replace_table(spark, sf_dir):
    df = read_usage(spark, stage_events(spark, sf_dir), EVENTS).select(*EVENT_COLS)
    target = staging_path(spark, "replace")
    append_table(df, target)
    replace_table(df, target)      # the refresh leaves one copy, not two
    return spark.read.parquet(target)


def q_load_dates(spark, sf_dir):
    df = read_usage(spark, stage_events(spark, sf_dir), EVENTS).select("ref_date", *EVENT_COLS)
    target = staging_path(spark, "by-date")
    load_dates(df, target, "ref_date")
    load_dates(df, target, "ref_date")    # repeat: replaced, not appended
    return spark.read.parquet(target).select(*EVENT_COLS)


def _frozen(spark, sf_dir) -> str:
    c = table(spark, sf_dir, "customer")
    target = staging_path(spark, "frozen")
    (c.filter(F.col("c_custkey") % 3 == 0)
     .select("c_custkey", F.lit("FROZEN").alias("c_mktsegment")).write.parquet(target))
    return target


def q_append_new(spark, sf_dir):
    target = _frozen(spark, sf_dir)
    src = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    append_new(src, target, "c_custkey")
    return spark.read.parquet(target)


def q_update_where(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    target = staging_path(spark, "update")
    c.write.parquet(target)
    update_table(spark, target, F.col("c_acctbal") < 0, {"c_mktsegment": "DEBT"})
    return spark.read.parquet(target).select("c_custkey", "c_mktsegment")


def q_ingest_new_files(spark, sf_dir):
    """Two runs; in between comes a late delivery, ten days old by its time stamps."""
    ev = table(spark, sf_dir, "events").select(*EVENT_COLS)
    landing = staging_path(spark, "ingest-landing")
    target = staging_path(spark, "ingested")
    ckpt = staging_path(spark, "ingest-checkpoint")
    late = F.dayofmonth("ts") % 3 == 0
    write_delivery(ev.filter(~late), landing)
    ingest_new_files(spark, landing, EVENTS, target, ckpt, import_day=IMPORT_DAY)
    outside = write_delivery(ev.filter(late), staging_path(spark, "ingest-late"))
    set_age(spark, outside, 10)
    for day in folders(spark, outside):
        rename(spark, f"{outside}/{day}", f"{landing}/{day}")
    for _ in range(2):   # the last run finds no new file
        ingest_new_files(spark, landing, EVENTS, target, ckpt, import_day=IMPORT_DAY)
    return spark.read.parquet(target).select(*EVENT_COLS)


def q_ingest_header_files(spark, sf_dir):
    """A header feed of the whole table, some files a batch: one half of the events, then the other with its columns
    in another order. Each day's files come in several loads, and all stay."""
    f = COMPLIANCE.with_(name="orders-by-day")
    o = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    day = F.date_format("ts", "yyyy_MM_dd")
    landing = staging_path(spark, "ingest-landing")
    target = staging_path(spark, "ingested")
    ckpt = staging_path(spark, "ingest-checkpoint")
    for k, cols in enumerate((["event_id", "event_type"], ["event_type", "event_id"])):
        part = o.filter(F.col("event_id") % 2 == k)
        write_delivery(part.select(*cols, "ts"), landing, f, day=day, spread=True, mode="append")
        ingest_new_files(spark, landing, f, target, ckpt, import_day=IMPORT_DAY, mode="replace_files",
                         max_files_per_trigger=24, types="event_id bigint, event_type string")
    return spark.read.parquet(target).select("ref_date", "event_id", "event_type")


def q_archive_members(spark, sf_dir):
    days = stage_events(spark, sf_dir)

    def pack(archives):
        (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
         .option("recursiveFileLookup", "true").load(days).select("path", "content")
         .mapInPandas(zip_parts(days, archives), "name string")
         .write.format("noop").mode("overwrite").save())
        return archives
    archives = delivery(spark, sf_dir, ("events",), ("events-archives",), pack)
    out = staging_path(spark, "events-extracted")
    res = archive_members(spark, archives, "events.txt", out).collect()   # one row per archive
    if not all(r.found for r in res):
        raise RuntimeError("member missing from an archive")
    return read_usage(spark, out, EVENTS).select(*EVENT_COLS)


def q_current_runs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    lid = F.col("o_orderkey").cast("string")
    start = o.select(lid.alias("log_id"), F.col("o_custkey").cast("int").alias("task_id"),
                     F.lit(2).alias("status"), F.col("o_orderdate").cast("timestamp").alias("log_time"),
                     F.lit("task has started").alias("message"), F.lit(0).cast("bigint").alias("seq"))
    end = o.select(lid.alias("log_id"), F.lit(None).cast("int").alias("task_id"),
                   _status_code(F.col("o_orderstatus")).alias("status"),
                   (F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).cast("timestamp").alias("log_time"),
                   F.lit("it's done").alias("message"), F.lit(1).cast("bigint").alias("seq"))
    path = staging_path(spark, "run-log")
    append_events(start, path)
    compact_log(spark, path)           # the starts are the base, the ends the tail
    append_events(end, path)
    return current_runs(spark, path).select("log_id", "task_id", "status", "message")


# --- D2 / D4 ------------------------------------------------------------------

def q_snapshot_refresh(spark, sf_dir):
    """D2 from a delivery of several part files; the frozen table keeps its rows and gets the others."""
    c = table(spark, sf_dir, "customer")
    joined = F.when(F.col("c_custkey") % 9 == 0, F.lit("soon")).otherwise(
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 60).cast("int")), "yyyyMMdd"))
    src = c.select("c_custkey", joined.alias("joined"), "c_mktsegment")
    landing = delivery(spark, sf_dir, ("customer",), ("snapshot-landing",),
                       lambda p: _write_header_file(src.repartition(4, "c_custkey"), f"{p}/panelist-export-1", "\t") and p)
    frozen = staging_path(spark, "frozen")
    (c.filter(F.col("c_custkey") % 3 == 0)
     .select("c_custkey", F.lit("2023-01-01 00:00:00").alias(SNAPSHOT_LOADED), F.lit("2000-01-01").cast("date").alias("joined"),
             F.lit("FROZEN").alias("c_mktsegment")).write.parquet(frozen))
    r = snapshot_refresh(spark, landing, "panelist-export", staging_path(spark, "snapshot"), frozen,
                         key="c_custkey", date_col="joined", now=_dt.datetime(2024, 2, 1, 13, 15, 0)).first()
    if r.status != "OK":
        raise RuntimeError(f"snapshot refresh did not run cleanly: {r}")
    return spark.read.parquet(frozen).select("c_custkey", F.col(SNAPSHOT_LOADED).alias("loaded"), "joined", "c_mktsegment")


# Days asked for, whether weekends count, and whether the log is read up to the day.
GATE_DAYS = [("1996-12-31", 1), ("1996-12-28", 0), ("1996-12-28", 1), ("1996-12-25", 0)]
GATE_HOLIDAYS = ["1996-12-25", "1997-01-01"]


def q_run_control(spark, sf_dir):
    """Gates that pass (any status will do) and gates that fail, on a working day, a weekend and a holiday."""
    c = table(spark, sf_dir, "customer")
    any_status = F.array(*[F.lit(k) for k in STATUS_CODES])
    req = c.select(F.col("c_nationkey").alias("gate_id"), F.col("c_custkey").alias("task_id"),
                   F.when(F.col("c_nationkey") % 2 == 0, any_status).otherwise(F.array(F.lit(1), F.lit(3))).alias("allowed"))
    cal = spark.createDataFrame([(h,) for h in GATE_HOLIDAYS], "holiday string")
    log = run_log(spark, sf_dir)
    parts = [run_control(log, req, d, calendar=cal, include_weekend=w, as_of=True).withColumn("weekends", F.lit(w)) for d, w in GATE_DAYS]
    return reduce(DataFrame.union, parts)


QUERIES = {
    "usage_read": q_usage_read,                         # S1
    "usage_read_utf16": q_usage_read_utf16,             # S2
    "permissive_read": q_permissive_read,               # S1 (PERMISSIVE)
    "stamped": q_stamped,                               # P1 P2 P4
    "compact_date": q_compact_date,                     # P5
    "date_key": q_date_key,                             # P6
    "null_out": q_null_out,                             # P7
    "parsed_count": q_parsed_count,                     # A1
    "reconcile_broken": q_reconcile_broken,             # F1 A1 A2 J4 (counts that differ)
    "latest_status_on_day": q_latest_status_on_day,     # W1 (that day alone)
    "query_rows": q_query_rows,                         # S9
    "ingest_header_files": q_ingest_header_files,       # T1 (header feed, by file)
    "reconcile": q_reconcile,                           # F1 A1 A2 J4 (flagship)
    "new_keys": q_new_keys,                             # J1
    "new_keys_null_target": q_new_keys_null_target,     # J1 (NULL in target)
    "latest_status": q_latest_status,                   # W1
    "prerequisite_status": q_prerequisite_status,       # W1 J2 F2
    "gate_passed": q_gate_passed,                       # W1 F2 A3
    "is_holiday": q_is_holiday,                         # J3
    "newest": q_newest,                                 # O1
    "valid_dates": q_valid_dates,                       # X1
    "invalid_status_codes": q_invalid_status_codes,     # X2
    "snapshot_read": q_snapshot_read,                   # S3 P7
    "compliance_read": q_compliance_read,               # S4 P7
    "expected_files": q_expected_files,                 # S7 P6
    "query_df": q_query_df,                             # S8
    "empty_feeds": q_empty_feeds,                       # Q1
    "missing_feeds": q_missing_feeds,                   # Q2
    "load_plan": q_load_plan,                           # Q3 skip_empty
    "load_plan_all_or_nothing": q_load_plan_all_or_nothing,# Q3 all_or_nothing
    "run_outcome": q_run_outcome,                       # Q4 (D1)
    "usage_load": q_usage_load,                         # D1 K4, repeated
    "resumed_backfill": q_resumed_backfill,             # D1, in steps, taken up again
    "backfill_load": q_backfill_load,                   # D1, 2,526 days
    "compliance_load": q_compliance_load,               # D3
    "append_table": q_append_table,                     # K1
    "replace_table": q_replace_table,                   # K2
    "load_dates": q_load_dates,                         # K4
    "append_new": q_append_new,                         # K3
    "update_where": q_update_where,                     # K6
    "ingest_new_files": q_ingest_new_files,             # T1
    "snapshot_refresh": q_snapshot_refresh,             # D2 S5 S3 P3 K2 K3
    "run_control": q_run_control,                       # D4 X2 W1 J2 F2 A3 J3
    "archive_members": q_archive_members,               # S6
    "current_runs": q_current_runs,                     # K5
}

_USAGE = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
_CUSTOMER = ("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, CASE WHEN c_custkey % 7 <> 0 "
             "THEN c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
_BAD = "SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE day(ts) % 5 = 0"
_GOOD = f"SELECT DISTINCT CAST(ts AS DATE) AS d FROM events EXCEPT {_BAD}"
_FROZEN = ("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'FROZEN' ELSE c_mktsegment END "
           "AS c_mktsegment FROM customer")

ORACLE_SQL = {
    "usage_read": _USAGE,
    "usage_read_utf16": _USAGE,
    "permissive_read":
        "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS INTEGER) END AS n FROM events",
    "stamped":
        "SELECT CAST(ts AS DATE) AS ref_date, DATE '2024-02-01' AS import_date, event_id, user_id, "
        "event_type FROM events",
    "compact_date":
        "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS d FROM events",
    "date_key":
        "SELECT event_id, strftime(ts, '%Y%m%dT000000Z') AS start_key, strftime(ts, '%Y_%m_%d') AS day_key "
        "FROM events",
    "null_out": "SELECT event_id, NULLIF(event_type, 'error') AS event_type FROM events",
    "parsed_count": "SELECT CAST(ts AS DATE) AS ref_date, count(*) AS n FROM events GROUP BY 1",
    "reconcile":
        "SELECT CAST(ts AS DATE) AS ref_date, count(*) AS count_df, count(*) AS count_raw, true AS matched "
        "FROM events GROUP BY 1",
    "new_keys":
        "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE "
        "o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1998-01-01')",
    "new_keys_null_target":
        "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderkey % 7 > 0 THEN o_custkey END "
        "FROM orders)",
    "latest_status":
        "SELECT o_custkey AS task_id, o_orderkey AS log_id, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 "
        "ELSE 3 END AS status FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate "
        "DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01') t WHERE rn = 1",
    "prerequisite_status":
        "WITH l AS (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders "
        "WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1) SELECT c_custkey AS task_id, "
        "COALESCE(CASE s WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END, -1) AS status, "
        "COALESCE(s IN ('F','P'), false) AS ok FROM customer LEFT JOIN l ON c_custkey = o_custkey",
    "gate_passed":
        "SELECT o_custkey AS gate_id, bool_and(s IN ('F','P')) AS passed FROM (SELECT o_custkey, "
        "o_orderpriority, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders GROUP BY 1, 2) t "
        "GROUP BY 1",
    "is_holiday":
        "SELECT DISTINCT CAST(ts AS DATE) AS d, (isodow(ts) >= 6 OR CAST(ts AS DATE) IN (DATE '2024-01-01', "
        "DATE '2024-01-15')) AS is_holiday FROM events",
    "newest": "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 10",
    "valid_dates":
        "SELECT CAST(ts AS DATE) AS d FROM events EXCEPT SELECT CAST(ts AS DATE) FROM events "
        "WHERE day(ts) % 5 = 0",
    "invalid_status_codes":
        "SELECT n_nationkey, array_to_string(list_sort(list_distinct(list_filter([n_regionkey, "
        "n_nationkey - 20], lambda x: x NOT IN (-1, 1, 2, 3)))), ',') AS invalid FROM nation",
    "snapshot_read": _CUSTOMER,
    "compliance_read": _CUSTOMER,
    "expected_files":
        "SELECT DISTINCT CAST(ts AS DATE) AS ref_date, 'usage-' || strftime(CAST(ts AS DATE), '%Y%m%dT000000Z') "
        "|| '-' || strftime(CAST(ts AS DATE) + INTERVAL 1 DAY, '%Y%m%dT000000Z') || '.zip' AS archive_name, "
        "'events_' || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '.txt' AS file_name, "
        "strftime(CAST(ts AS DATE), '%Y%m%dT000000Z') AS start_key, "
        "strftime(CAST(ts AS DATE) + INTERVAL 1 DAY, '%Y%m%dT000000Z') AS end_key FROM events",
    "query_df":
        "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority",
    "empty_feeds": f"SELECT d AS ref_date FROM ({_BAD}) b",
    "missing_feeds": f"SELECT d AS ref_date FROM ({_BAD}) b",
    "load_plan": f"SELECT d AS ref_date FROM ({_GOOD}) g",
    "load_plan_all_or_nothing":
        f"SELECT DISTINCT CAST(ts AS DATE) AS ref_date, 'some' AS request FROM events WHERE day(ts) < 5 "
        f"UNION ALL SELECT d, 'every' FROM ({_GOOD}) g WHERE NOT EXISTS (SELECT 1 FROM ({_BAD}) b)",
    "run_outcome":
        f"WITH b AS ({_BAD}), g AS ({_GOOD}) SELECT CASE WHEN (SELECT count(*) FROM b) > 0 THEN 'WARNING' "
        "ELSE 'OK' END AS status, COALESCE((SELECT string_agg(strftime(d, '%Y-%m-%d'), ',' ORDER BY d) "
        "FROM g), '') AS loaded_dates, COALESCE((SELECT string_agg(strftime(d, '%Y-%m-%d'), ',' ORDER BY d) "
        "FROM b), '') AS skipped_dates, "
        "(SELECT count(*) FROM events WHERE CAST(ts AS DATE) IN (SELECT d FROM g)) AS n_rows, "
        "true AS all_matched",
    "usage_load":
        "SELECT CAST(ts AS DATE) AS ref_date, DATE '2024-02-01' AS import_date, event_id, ts, user_id, "
        "event_type, value, props FROM events",
    "resumed_backfill":
        "SELECT CAST(ts AS DATE) AS ref_date, DATE '2024-02-01' AS import_date, event_id, ts, user_id, "
        "event_type, value, props FROM events",
    "backfill_load":
        "SELECT CAST(l_shipdate AS DATE) AS ref_date, l_orderkey, l_linenumber, l_quantity, l_returnflag, "
        "l_shipdate FROM lineitem",
    "compliance_load":
        "SELECT CAST(ts AS DATE) AS ref_date, DATE '2024-02-01' AS import_date, event_id, "
        "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, CASE WHEN event_id % 11 = 0 THEN 'two' || chr(10) || "
        "'lines, \"quoted\"' ELSE event_type END AS event_type, value, props FROM events",
    "append_table": _USAGE,
    "replace_table": _USAGE,
    "load_dates": _USAGE,
    "append_new": _FROZEN,
    "update_where":
        "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment "
        "FROM customer",
    "ingest_new_files": _USAGE,
    "snapshot_refresh":
        "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '2023-01-01 00:00:00' ELSE '2024-02-01 13:15:00' END AS loaded, "
        "CASE WHEN c_custkey % 3 = 0 THEN DATE '2000-01-01' WHEN c_custkey % 9 <> 0 THEN "
        "CAST(DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER) AS DATE) END AS joined, "
        "CASE WHEN c_custkey % 3 = 0 THEN 'FROZEN' ELSE c_mktsegment END AS c_mktsegment FROM customer",
    "reconcile_broken":
        "SELECT CAST(ts AS DATE) AS ref_date, count(*) + count(*) FILTER (WHERE day(ts) % 7 = 0 AND event_id % 5 = 0) AS count_df, "
        "count(*) AS count_raw, count(*) FILTER (WHERE day(ts) % 7 = 0 AND event_id % 5 = 0) = 0 AS matched FROM events GROUP BY 1",
    "latest_status_on_day":
        "SELECT o_custkey AS task_id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS log_id, "
        "arg_max(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, (o_orderdate, o_orderkey)) AS status FROM orders "
        "WHERE CAST(o_orderdate AS DATE) = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) GROUP BY 1",
    "query_rows":
        "SELECT o_orderpriority, CAST(count(*) AS INTEGER) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderpriority",
    "ingest_header_files":
        "SELECT CAST(ts AS DATE) AS ref_date, event_id, event_type FROM events",
    "run_control":
        "WITH days AS (SELECT * FROM (VALUES (DATE '1996-12-31', 1, false), (DATE '1996-12-28', 0, false), "
        "(DATE '1996-12-28', 1, true), (DATE '1996-12-25', 0, true)) v(d, weekends, holiday)), "
        "l AS (SELECT d, weekends, o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM days JOIN orders "
        "ON o_orderdate < d + INTERVAL 1 DAY GROUP BY ALL), "
        "g AS (SELECT c_nationkey AS gate_id, days.d, days.weekends, holiday, bool_and(c_nationkey % 2 = 0 OR "
        "COALESCE(s IN ('F','P'), false)) AS passed FROM customer CROSS JOIN days LEFT JOIN l ON c_custkey = o_custkey "
        "AND l.d = days.d AND l.weekends = days.weekends GROUP BY ALL) "
        "SELECT gate_id, d, passed, holiday AS is_holiday, passed AND NOT holiday AS may_run, weekends FROM g",
    "archive_members": _USAGE,
    "current_runs":
        "SELECT CAST(o_orderkey AS VARCHAR) AS log_id, CAST(o_custkey AS INTEGER) AS task_id, "
        "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS status, 'it''s done' AS message "
        "FROM orders",
}
