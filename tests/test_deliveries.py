"""Awkward deliveries and failures: what must not be lost, swapped, kept or overwritten."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from panelflow.operators.gates import empty_feeds
from panelflow.operators.keys import valid_dates
from panelflow.plans.outcome import RunLog
from panelflow.plans.snapshot import snapshot_refresh
from panelflow.plans.usage_load import usage_load
from panelflow.schemas import APP, COMPLIANCE, Feed, _schema
from panelflow.session import shared_dir
from panelflow.sinks import tables
from panelflow.sinks.files import archive_files
from panelflow.sinks.runlog import compact_log, current_runs, log_start, log_status
from panelflow.sinks.tables import load_dates, replace_table, update_table
from panelflow.sources.files import latest_file, list_files
from panelflow.sources.header import read_snapshot
from panelflow.sources.usage import raw_lines, read_usage
from panelflow.streaming.ingest import ingest_new_files
from tests.conftest import ROOT

S = Feed("s", _schema("a string, n int"), file_prefix="s_", import_col="import_date")
U = S.with_(encoding="UTF-16LE")


def _write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding) if isinstance(text, str) else text)


def _rows(spark, path, *cols):
    return sorted(tuple(r) for r in spark.read.parquet(str(path)).select(*cols).collect())


def test_archiving_keeps_every_file_of_every_day_folder(spark, tmp_path):
    land, arch = tmp_path / "land", tmp_path / "arch"
    for d in ("2024-01-01", "2024-01-02"):
        for k in range(2):
            _write(land / f"day={d}" / f"part-{k}.txt", f"{d}\t{k}\n")
    res = usage_load(spark, str(land), S, ("2024-01-01", "2024-01-02"), target=str(tmp_path / "t"), match="day",
                     layout="day={day}", archive_dir=str(arch))
    assert (res.outcome.first().status, res.outcome.first().n_rows) == ("OK", 4)
    assert sorted(str(p.relative_to(arch)) for p in arch.rglob("*.txt")) == [f"day=2024-01-0{d}/part-{k}.txt" for d in (1, 2) for k in (0, 1)]
    _write(land / "day=2024-01-01" / "part-0.txt", "again\t9\n")
    with pytest.raises(Exception, match="already in the archive"):
        archive_files(spark, [str(land / "day=2024-01-01" / "part-0.txt")], str(arch), root=str(land)).collect()
    assert (arch / "day=2024-01-01" / "part-0.txt").read_text() == "2024-01-01\t0\n"


@pytest.mark.parametrize("match", ["name", "day"])
def test_archive_inside_the_landing_folder_is_not_loaded_again(spark, tmp_path, match):
    land = tmp_path / "data"
    arch = str(land / "archived")
    kw = {"target": str(tmp_path / "t"), "archive_dir": arch, "match": match}
    _write(land / "s_2024-01-01.txt", "x\t1\n")
    assert usage_load(spark, str(land), S, ["2024-01-01"], **kw).outcome.first().n_rows == 1
    _write(land / "new" / "s_2024-01-01.txt" if match == "day" else land / "s_2024-01-02.txt", "y\t2\n")
    res = usage_load(spark, str(land), S, ["2024-01-01" if match == "day" else "2024-01-02"], **kw)
    assert (res.outcome.first().status, res.outcome.first().n_rows) == ("OK", 1)


@pytest.mark.parametrize("folder", ["Working Project", "50% [a]{b}", "a+b é"])
def test_blanks_and_signs_in_paths(spark, tmp_path, folder):
    land = tmp_path / folder
    _write(land / "s_2024-01-01.txt", "x\t1\n")
    _write(land / "s_2024-01-02.txt", "")
    assert {r.file_name: r.length for r in list_files(spark, str(land)).collect()} == {"s_2024-01-01.txt": 4, "s_2024-01-02.txt": 0}
    o = usage_load(spark, str(land), S, ("2024-01-01", "2024-01-02"), target=str(tmp_path / "t")).outcome.first()
    assert (o.status, o.loaded_dates, o.skipped_dates, o.n_rows) == ("WARNING", "2024-01-01", "2024-01-02", 1)
    _write(land / "export-1.csv", "a\n1\n")
    assert latest_file(spark, str(land), "export-").endswith("export-1.csv")


def test_header_columns_go_by_name(spark, tmp_path):
    _write(tmp_path / "land" / "compliance_2024_01_01.csv", "id,grp\n1,2\n")
    _write(tmp_path / "land" / "compliance_2024_01_02.csv", "grp,id,more\n20,10,x\n")
    o = usage_load(spark, str(tmp_path / "land"), COMPLIANCE, ("2024-01-01", "2024-01-02"), target=str(tmp_path / "t")).outcome.first()
    assert (o.status, o.all_matched) == ("OK", True)
    assert _rows(spark, tmp_path / "t", "id", "grp", F.coalesce("more", F.lit(""))) == [(1, 2, ""), (10, 20, "x")]


def test_header_table_stays_readable_when_types_change(spark, tmp_path):
    land, t = tmp_path / "land", str(tmp_path / "t")
    for day, text in enumerate(("id,v\n1,1\n", "id,v,w\nx1,2.5,9\n", "id,v\n3,\n"), 1):
        _write(land / f"compliance_2024_01_0{day}.csv", text)
        o = usage_load(spark, str(land), COMPLIANCE, [f"2024-01-0{day}"], target=t).outcome.first()
        assert (o.status, o.n_rows) == ("OK", 1)
    df = spark.read.parquet(t)
    assert {c: k for c, k in df.dtypes if c in "idvw"} == {"id": "string", "v": "double", "w": "bigint"}
    assert sorted((r.id, r.v, r.w) for r in df.collect()) == [("1", 1.0, None), ("3", None, None), ("x1", 2.5, 9)]


def test_quoted_line_breaks_and_long_integers(spark, tmp_path):
    _write(tmp_path / "land" / "compliance_2024_01_01.csv", 'id,note\n123456789012345678901,"two\nlines"\n123456789012345678902,"a ""b"", c"\n')
    o = usage_load(spark, str(tmp_path / "land"), COMPLIANCE, ["2024-01-01"], target=str(tmp_path / "t")).outcome.first()
    assert (o.status, o.n_rows, o.all_matched) == ("OK", 2, True)
    assert _rows(spark, tmp_path / "t", "id", "note") == [("123456789012345678901", "two\nlines"), ("123456789012345678902", 'a "b", c')]


def test_utf16_byte_orders_marks_and_line_ends(spark, tmp_path):
    land = tmp_path / "land"
    _write(land / "s_2024-01-01.txt", b"\xfe\xff" + "é\t1\r\nb\t2\r\n".encode("utf-16-be"))
    _write(land / "s_2024-01-02.txt", b"\xff\xfe" + "c\t3\rd\t4\n".encode("utf-16-le"))     # a lone carriage return
    _write(land / "s_2024-01-03.txt", "e\t5\n".encode("utf-16-le"))                          # no mark
    o = usage_load(spark, str(land), U, ("2024-01-01", "2024-01-03"), target=str(tmp_path / "t")).outcome.first()
    assert (o.status, o.n_rows, o.all_matched) == ("OK", 5, True)
    assert _rows(spark, tmp_path / "t", "n", "a") == [(1, "é"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]
    assert raw_lines(spark, str(land), U).filter("trim(value) <> ''").count() == 5
    assert read_usage(spark, str(land / "s_2024-01-01.txt"), U).count() == 2


def test_empty_means_nothing_beside_one_mark(spark, tmp_path):
    for day, data in enumerate((b"\xff\xfe", b"\xfe\xff", b"", b"\xff\xfe\xff\xfe", b"a\x00"), 1):
        _write(tmp_path / f"s_2024-01-0{day}.txt", data)
    assert sorted(r.ref_date.day for r in empty_feeds(spark, str(tmp_path), U).collect()) == [1, 2, 3]


def test_a_day_delivered_without_rows_is_cleared(spark, tmp_path):
    land, t = tmp_path / "land", str(tmp_path / "t")
    _write(land / "s_2024-01-01.txt", "x\t1\n")
    _write(land / "s_2024-01-02.txt", "y\t2\n")
    usage_load(spark, str(land), S, ("2024-01-01", "2024-01-02"), target=t)
    _write(land / "s_2024-01-01.txt", "  \n \n")
    o = usage_load(spark, str(land), S, ["2024-01-01"], target=t).outcome.first()
    assert (o.status, o.n_rows, o.all_matched) == ("OK", 0, True)
    assert _rows(spark, t, "a") == [("y",)]


def test_a_failed_refresh_leaves_the_old_table(spark, tmp_path, monkeypatch):
    t = str(tmp_path / "t")
    replace_table(spark.range(3), t)
    boom = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("boom"))).alias("id"))
    with pytest.raises(Exception, match="boom"):
        replace_table(boom, t)
    assert spark.read.parquet(t).count() == 3 and os.listdir(tmp_path) == ["t"]

    def cannot(*_):
        raise OSError("no rename")
    monkeypatch.setattr(tables, "swap", cannot)
    with pytest.raises(OSError):
        replace_table(spark.range(9), t)
    monkeypatch.undo()
    assert spark.read.parquet(t).count() == 3 and os.listdir(tmp_path) == ["t"]
    replace_table(spark.read.parquet(t).filter("id > 0"), t)
    assert spark.read.parquet(t).count() == 2 and os.listdir(tmp_path) == ["t"]


def test_update_keeps_partitions_and_rewrites_only_touched_ones(spark, tmp_path):
    t = str(tmp_path / "t")
    df = spark.createDataFrame([("2024-01-01", 1, "a"), ("2024-01-02", 2, "b"), ("2024-01-02", 3, "c")], "d string, n int, v string").withColumn("d", F.col("d").cast("date"))
    load_dates(df, t, "d")
    before = set(os.listdir(f"{t}/d=2024-01-01"))
    update_table(spark, t, F.col("n") == 2, {"v": "B"})
    assert set(os.listdir(f"{t}/d=2024-01-01")) == before
    assert _rows(spark, t, "n", "v") == [(1, "a"), (2, "B"), (3, "c")]
    load_dates(df.filter("n = 1").withColumn("v", F.lit("A")), t, "d")
    assert _rows(spark, t, "n", "v") == [(1, "A"), (2, "B"), (3, "c")]


def test_run_log_times_do_not_depend_on_the_machine_zone(tmp_path):
    code = f"""
import datetime as dt
from pyspark.sql import SparkSession
from panelflow.sinks.runlog import *
from panelflow.operators.control import latest_status
s = SparkSession.builder.master("local[1]").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
p = {str(tmp_path / "log")!r}
_, i = log_start(s, p, 7, 2, "started", now=dt.datetime(2024, 1, 5, 3))
log_status(s, p, i, 1, "done", now=dt.datetime(2024, 1, 5, 12, tzinfo=dt.timezone(dt.timedelta(hours=8))))
compact_log(s, p)
r = current_runs(s, p).selectExpr("cast(started as string) a", "cast(log_time as string) b", "status").first()
assert tuple(r) == ("2024-01-05 03:00:00", "2024-01-05 04:00:00", 1), r
assert latest_status(current_runs(s, p), "2024-01-05").first().status == 1
print("OK")
"""
    r = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env={**os.environ, "TZ": "Asia/Singapore"}, capture_output=True, text=True, timeout=300)
    assert r.stdout.strip().endswith("OK"), r.stderr[-1500:]


def test_ingest_takes_late_old_files_and_keeps_all_files_of_a_day(spark, tmp_path):
    land, t, ck = tmp_path / "land", str(tmp_path / "t"), str(tmp_path / "ck")
    _write(land / "s_2024-01-02.txt", "x\t1\n")
    ingest_new_files(spark, str(land), S, t, ck)
    _write(land / "s_2024-01-01.txt", "late\t2\n")
    os.utime(land / "s_2024-01-01.txt", (1.6e9, 1.6e9))
    ingest_new_files(spark, str(land), S, t, ck)
    assert _rows(spark, t, "a") == [("late",), ("x",)]
    t, ck = str(tmp_path / "t2"), str(tmp_path / "ck2")
    _write(land / "s2_2024-01-02.txt", "y\t3\n")
    for _ in range(2):
        ingest_new_files(spark, str(land), S, t, ck, mode="replace_files", max_files_per_trigger=1)
    assert _rows(spark, t, "a", "source_file") == [("late", "s_2024-01-01.txt"), ("x", "s_2024-01-02.txt"), ("y", "s2_2024-01-02.txt")]


def test_ingest_of_a_header_feed(spark, tmp_path):
    land, t, ck = tmp_path / "land", str(tmp_path / "t"), str(tmp_path / "ck")
    _write(land / "compliance_2024_01_01.csv", "id,grp\n1,2\n")
    ingest_new_files(spark, str(land), COMPLIANCE, t, ck, mode="replace_files", archive_dir=str(tmp_path / "arch"))
    _write(land / "compliance_2024_01_02.csv", "grp,id\n20,ten\n")
    ingest_new_files(spark, str(land), COMPLIANCE, t, ck, mode="replace_files")
    assert _rows(spark, t, "id", "grp") == [("1", "2"), ("ten", "20")]
    assert os.listdir(tmp_path / "arch") == ["compliance_2024_01_01.csv"]
    t, ck = str(tmp_path / "t2"), str(tmp_path / "ck2")
    for text in ("grp,id\n20,ten\n", "id,grp\n3,4\n"):                # every version is added
        _write(land / "compliance_2024_01_02.csv", text)
        ingest_new_files(spark, str(land), COMPLIANCE, t, ck)
    assert _rows(spark, t, "id", "grp") == [("3", "4"), ("ten", "20")]
    with pytest.raises(ValueError):
        ingest_new_files(spark, str(land), COMPLIANCE, t, ck, mode="replace")


def _ingested(spark, land, t, ck, **more):
    r = ingest_new_files(spark, str(land), S, str(t), str(ck), mode="replace_files", **more)
    return r.outcome.first(), _rows(spark, str(t), "a", "source_file")


def test_ingest_tells_files_of_one_name_in_two_folders_apart(spark, tmp_path):
    land = tmp_path / "a plus+b" / "land"
    for folder, text in (("a", "x\t1\ny\t2\n"), ("b c+%25", "z\t3\n")):
        _write(land / folder / "s_2024-01-05.txt", text)
    out, rows = _ingested(spark, land, tmp_path / "t", tmp_path / "ck", max_files_per_trigger=1)
    assert rows == [("x", "a/s_2024-01-05.txt"), ("y", "a/s_2024-01-05.txt"), ("z", "b c+%25/s_2024-01-05.txt")]
    assert (out.status, out.loaded_dates, out.n_rows, out.all_matched) == ("OK", "2024-01-05", 3, True)


def test_ingest_replaces_versions_and_clears_those_without_rows(spark, tmp_path):
    land, t, ck = tmp_path / "land", tmp_path / "t", tmp_path / "ck"
    for n, text in (("s_2024-01-01.txt", "x\t1\n"), ("p/s_2024-01-01.txt", "other\t2\n"), ("s_2024-01-02.txt", "z\t3\n")):
        _write(land / n, text)
    _ingested(spark, land, t, ck)
    _write(land / "s_2024-01-01.txt", "x2\t10\nx3\t11\n")             # again, with other rows
    _write(land / "s_2024-01-02.txt", "")                               # again, without any
    _write(land / "s_2024-01-03.txt", "late\t4\n")
    out, rows = _ingested(spark, land, t, ck)
    assert rows == [("late", "s_2024-01-03.txt"), ("other", "p/s_2024-01-01.txt"), ("x2", "s_2024-01-01.txt"), ("x3", "s_2024-01-01.txt")]
    assert out.n_rows == 3 and out.loaded_dates == "2024-01-01,2024-01-03"
    os.utime(land / "p" / "s_2024-01-01.txt", (1.5e9, 1.5e9))           # an older copy put back is a version too
    assert _ingested(spark, land, t, ck)[0].n_rows == 1
    assert _ingested(spark, land, t, ck) == (_ingested(spark, land, t, ck)[0], rows)
    h = tmp_path / "headers"
    for text in ("id,grp\n1,2\n", "id,grp\n"):                         # a header alone
        _write(h / "compliance_2024_01_01.csv", text)
        ingest_new_files(spark, str(h), COMPLIANCE, str(tmp_path / "t3"), str(tmp_path / "ck3"), mode="replace_files")
    assert not [f for _, _, names in os.walk(tmp_path / "t3") for f in names if f.startswith("part-") and "ref_date=" in f]
    assert not any("ref_date=" in d for d, _, names in os.walk(tmp_path / "t3") if any(n.startswith("part-") for n in names))


def test_ingest_reads_both_byte_orders(spark, tmp_path):
    f = S.with_(encoding="UTF-16LE")
    for n, (mark, codec) in enumerate((("\ufeff", "utf-16-be"), ("\ufeff", "utf-16-le"), ("", "utf-16-le"))):
        p = tmp_path / "land" / f"s_2024-01-0{n + 1}.txt"
        p.parent.mkdir(exist_ok=True)
        p.write_bytes((mark + f"é{n}\t{n}\r\nё\t7\n").encode(codec))
    r = ingest_new_files(spark, str(tmp_path / "land"), f, str(tmp_path / "t"), str(tmp_path / "ck"))
    assert _rows(spark, str(tmp_path / "t"), "a", "n") == sorted([("é0", 0), ("é1", 1), ("é2", 2)] + [("ё", 7)] * 3)
    assert [tuple(x)[1:] for x in r.reconcile.orderBy("ref_date").collect()] == [(2, 2, True)] * 3


def test_ingest_takes_up_a_failed_batch_and_logs_its_runs(spark, tmp_path, monkeypatch):
    from panelflow.plans.outcome import RunLog
    from panelflow.sinks.runlog import current_runs
    from panelflow.streaming import ingest
    land, t, ck, log = tmp_path / "land", tmp_path / "t", tmp_path / "ck", RunLog(str(tmp_path / "log"), 5)
    _write(land / "s_2024-01-01.txt", "x\t1\n")
    _ingested(spark, land, t, ck, log=log)
    _write(land / "s_2024-01-01.txt", "x2\t1\n")
    _write(land / "s_2024-01-02.txt", "y\t1\n")
    forget = ingest._forget

    def broken(*a):
        forget(*a)
        raise OSError("lost")
    monkeypatch.setattr(ingest, "_forget", broken)                      # written, the old rows gone, then it fails
    out = ingest_new_files(spark, str(land), S, str(t), str(ck), mode="replace_files", log=log).outcome.first()
    assert out.status == "ERROR" and "lost" in out.error
    monkeypatch.setattr(ingest, "_forget", forget)
    _write(land / "s_2024-01-02.txt", "y2\t1\n")                        # changed before the batch is taken up
    out, rows = _ingested(spark, land, t, ck, log=log)
    assert rows == [("x2", "s_2024-01-01.txt"), ("y2", "s_2024-01-02.txt")] and out.status == "OK"
    assert sorted(r.status for r in current_runs(spark, log.path).collect()) == [1, 1, 2]


def test_ingest_archives_each_version(spark, tmp_path):
    land, t, ck, arch = tmp_path / "land", tmp_path / "t", tmp_path / "ck", tmp_path / "land" / "archive"
    for text in ("x\t1\n", "x2\t1\n", "x3\t1\n"):
        _write(land / "in" / "s_2024-01-01.txt", text)
        _, rows = _ingested(spark, land, t, ck, archive_dir=str(arch))
        assert rows == [(text.split("\t")[0], "in/s_2024-01-01.txt")] and not (land / "in" / "s_2024-01-01.txt").exists()
    assert sorted((arch / "in" / n).read_text() for n in os.listdir(arch / "in") if not n.startswith(".")) == ["x\t1\n", "x2\t1\n", "x3\t1\n"]


def test_a_one_file_load_takes_at_most_ten_jobs(spark, tmp_path):
    _write(tmp_path / "land" / "s_2024-01-01.txt", "x\t1\n")
    t = str(tmp_path / "t")
    usage_load(spark, str(tmp_path / "land"), S, ["2024-01-01"], target=t)
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{os.getpid()}"
    spark.sparkContext.setJobGroup(group, "one file")
    try:
        assert usage_load(spark, str(tmp_path / "land"), S, ["2024-01-01"], target=t).outcome.first().status == "OK"
        assert len(tracker.getJobIdsForGroup(group)) <= 10
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_valid_dates_is_distinct_before_its_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = spark.range(1000).selectExpr("date_add(DATE'2024-01-01', int(id % 30)) AS d")
        plan = valid_dates(days, days.filter("day(d) = 3"), "d")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan.index("LeftAnti")
    assert plan[join:].count("HashAggregate") >= 2


def test_any_exception_is_an_outcome_and_closes_the_run(spark, tmp_path):
    _write(tmp_path / "land" / "s_2024-01-01.txt", "x\t1\n")
    log = RunLog(str(tmp_path / "log"), 42)
    bad = tmp_path / "target"
    bad.write_text("a file where the table should be")
    o = usage_load(spark, str(tmp_path / "land"), S, ["2024-01-01"], target=str(bad), log=log).outcome.collect()
    assert len(o) == 1 and o[0].status == "ERROR" and o[0].error
    r = current_runs(spark, log.path).first()
    assert (r.task_id, r.status) == (42, 2) and r.message == o[0].error
    assert usage_load(spark, str(tmp_path / "land"), S, ["2024-01-01"], target=str(tmp_path / "t"), log=log).outcome.first().status == "OK"
    assert sorted(r.status for r in current_runs(spark, log.path).collect()) == [1, 2]
    _write(tmp_path / "snap" / "export-1.csv", "RespondentID\n1\n")
    o = snapshot_refresh(spark, str(tmp_path / "snap"), "export-", str(bad / "x"), str(tmp_path / "f"), log=log).first()
    assert o.status == "ERROR" and o.error


@pytest.mark.parametrize("parts", [1, 4])
def test_snapshot_of_a_folder_of_part_files(spark, tmp_path, parts):
    src = spark.range(100).selectExpr("id AS RespondentID", "'20240101' AS SGP_MD2_EndTIme")
    src.repartition(parts).write.options(sep="\t", header="true").csv(str(tmp_path / "land" / "export-1"))
    o = snapshot_refresh(spark, str(tmp_path / "land"), "export-", str(tmp_path / "s"), str(tmp_path / "f")).first()
    assert (o.status, o.n_rows) == ("OK", 100) and spark.read.parquet(str(tmp_path / "f")).count() == 100
    assert read_snapshot(spark, str(tmp_path / "land" / "export-1")).count() == 100


def test_jdbc_targets_get_their_options(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tables, "append_table", lambda df, target=None, **kw: seen.append((df.count(), kw["jdbc"])))
    monkeypatch.setattr(type(spark.read), "load", lambda self, *a, **k: spark.range(2))
    tables.append_new(spark.range(4), None, "id", jdbc={"url": "jdbc:none:", "dbtable": "t"})
    assert seen == [(2, {"url": "jdbc:none:", "dbtable": "t"})]
    assert tables._jdbc_opts({"dbtable": "t", "batchsize": "5"}) == {"numPartitions": "8", "batchsize": "5", "dbtable": "t"}


def test_no_local_staging_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_log_start_and_blank_ids(spark, tmp_path):
    _, i = log_start(spark, str(tmp_path / "log"), 1, 2, "x", now=dt.datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        log_status(spark, str(tmp_path / "log"), " ", 1, "x")
    compact_log(spark, str(tmp_path / "log"))
    assert current_runs(spark, str(tmp_path / "log")).first().log_id == i


def test_header_feed_query_loads_every_event(spark, monkeypatch):
    from panelflow import queries
    from tests.conftest import SF_SMALL
    targets = []

    def spy(spark, landing, feed, target, *args, **more):
        targets.append(target)
        return ingest_new_files(spark, landing, feed, target, *args, **more)
    monkeypatch.setattr(queries, "ingest_new_files", spy)
    queries.q_ingest_header_files(spark, SF_SMALL)
    got = spark.read.parquet(targets[0]).select("ref_date", "event_id", "event_type")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").selectExpr("CAST(ts AS DATE)", "event_id", "event_type")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, events.collect()))


@pytest.mark.parametrize("few", [128, 1])
def test_byte_orders_of_few_and_many_files(spark, tmp_path, monkeypatch, few):
    from panelflow.sources import usage
    monkeypatch.setattr(usage, "FEW_FILES", few)
    land = tmp_path / "a b+c%20"
    for k in range(6):
        text = ("﻿" if k % 3 else "") + f"é{k}\t{k}\n"
        _write(land / f"day {k}" / f"s_2024-01-0{k + 1}.txt", text.encode("utf-16-be" if k % 3 == 1 else "utf-16-le"))
    _write(land / "s_2024-01-09.txt", b"")
    _write(land / "s_2024-01-08.txt", b"\xfe")
    little, big = usage.byte_orders(spark, str(land))
    assert sorted(p.rsplit("/", 1)[1][10:12] for p in big) == ["02", "05"] and len(little) == 6
    assert sorted((r.a, r.n) for r in usage.read_usage(spark, str(land), U).collect() if r.n is not None) == [(f"é{k}", k) for k in range(6)]
