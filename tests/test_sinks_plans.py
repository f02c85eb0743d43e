"""Sinks, run log, streaming ingest and the composed loads, end to end."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelflow.plans.run_control import run_control
from panelflow.plans.snapshot import snapshot_refresh
from panelflow.plans.usage_load import usage_load
from panelflow.schemas import APP, COMPLIANCE, MEDIA, Feed, _schema
from panelflow.sinks.runlog import current_runs, log_start, log_status
from panelflow.sinks.tables import load_dates, replace_table, update_table
from panelflow.streaming.ingest import ingest_new_files

APP_ROW = ["G", "P1", "PC", "C", "CK", "iOS", "14.4", "Apple", "iPhone", "phone", "1.0", "Games", "App",
           "2023-05-17 10:00:00", "2023-05-17 10:05:00", "2023-05-17 02:00:00", "2023-05-17 02:05:00",
           "2023-05-17", "10:00:00", "2023-05-17", "10:05:00", "300", "com.x", "IAB1", "T1"]


def _app_file(path, n, crlf=True):
    line = "\t".join(APP_ROW) + ("\r\n" if crlf else "\n")
    path.write_bytes(b"\xff\xfe" + (line * n + ("\r\n" if crlf else "\n")).encode("utf-16-le"))


def test_usage_load_skip_empty_and_repeat(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    _app_file(land / "usage_app_2023-05-17.txt", 3)
    _app_file(land / "usage_app_2023-05-18.txt", 2)
    (land / "usage_app_2023-05-19.txt").write_bytes(b"\xff\xfe")        # mark only = empty
    target = str(tmp_path / "app")
    days = ("2023-05-17", "2023-05-19")
    for _ in range(2):
        res = usage_load(spark, str(land), APP, days, target=target, import_day=dt.date(2023, 5, 20))
    out = res.outcome.first()
    assert (out.status, out.loaded_dates, out.skipped_dates, out.n_rows, out.all_matched) == \
        ("WARNING", "2023-05-17,2023-05-18", "2023-05-19", 5, True)
    t = spark.read.parquet(target)
    assert t.count() == 5                      # repeated run replaced, not appended
    assert t.columns[0] == "importDate" and t.columns[-1] == "refDate"   # partition column last
    assert {r.refDate for r in t.select("refDate").distinct().collect()} == \
        {dt.date(2023, 5, 17), dt.date(2023, 5, 18)}


def test_usage_load_all_or_nothing_and_missing(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    media_row = "\t".join(["G", "P", "1", "K", "iOS", "14", "ios", "A", "M", "phone", "pl", "m1", "no", "vod",
                           "T", "S", "E", "3", "D", "C", "Ch", "2023-05-17 01:00:00", "2023-05-17 09:00:00",
                           "60", "120", "2023-05-18 00:00:00"]) + "\n"
    (land / "usage_media_2023-05-17.txt").write_bytes(b"\xff\xfe" + media_row.encode("utf-16-le"))
    (land / "usage_media_2023-05-18.txt").write_bytes(b"")
    res = usage_load(spark, str(land), MEDIA, ("2023-05-17", "2023-05-18"), target=str(tmp_path / "m"))
    out = res.outcome.first()
    assert out.status == "WARNING" and out.loaded_dates == "" and out.n_rows == 0
    res = usage_load(spark, str(land), MEDIA, ("2023-05-17", "2023-05-19"), target=str(tmp_path / "m"))
    out = res.outcome.first()
    assert out.status == "ERROR" and out.missing_dates == "2023-05-19"


def test_compliance_load(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "compliance_2023_05_17.csv").write_text("PanelistId,Compliant\np1,1\np2,0\n")
    (land / "compliance_2023_05_18.csv").write_text("PanelistId,Compliant\np1,NA\n")
    f = COMPLIANCE.with_(schema=_schema("PanelistId string, Compliant int"))
    res = usage_load(spark, str(land), f, ("2023-05-17", "2023-05-18"), target=str(tmp_path / "c"),
                     import_day=dt.date(2023, 5, 18))
    o = res.outcome.first()
    assert o.status == "OK" and o.all_matched and o.n_rows == 3    # header lines not counted as rows
    t = spark.read.parquet(str(tmp_path / "c"))
    assert t.count() == 3 and t.filter(F.col("Compliant").isNull()).count() == 1


def test_replace_and_update_read_their_own_target(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(10).write.parquet(p)
    replace_table(spark.read.parquet(p).filter("id < 5"), p)
    assert spark.read.parquet(p).count() == 5
    update_table(spark, p, F.col("id") == 2, {"id": 20})
    assert sorted(r.id for r in spark.read.parquet(p).collect()) == [0, 1, 3, 4, 20]


def test_load_dates_keeps_other_dates(spark, tmp_path):
    p = str(tmp_path / "by_date")
    a = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "d date, v int")
    load_dates(a, p, "d")
    load_dates(spark.createDataFrame([(dt.date(2024, 1, 2), 3)], "d date, v int"), p, "d")
    assert sorted((r.d, r.v) for r in spark.read.parquet(p).collect()) == \
        [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 3)]


def test_run_log(spark, tmp_path):
    p = str(tmp_path / "log")
    flag, lid = log_start(spark, p, -99, 2, "task has started", now=dt.datetime(2024, 1, 1, 9))
    assert flag == 1 and lid
    log_status(spark, p, lid, 1, "it's done", now=dt.datetime(2024, 1, 1, 10))
    with pytest.raises(ValueError):
        log_status(spark, p, None, 1, "x")
    r = current_runs(spark, p).first()
    assert (r.task_id, r.status, r.message) == (-99, 1, "it's done")


def test_snapshot_refresh(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "export-1.csv").write_text(
        "RespondentID\tHousehold\tSGP_MD2_EndTIme\n1\t10\t20230517\n2\tNA\tbad\n2\t20\t20230518\n")
    snap, frozen = str(tmp_path / "snap"), str(tmp_path / "frozen")
    now = dt.datetime(2024, 1, 1, 13, 15)
    assert snapshot_refresh(spark, str(land), "export-", snap, frozen, now=now).first().status == "OK"
    assert spark.read.parquet(frozen).count() == 3
    (land / "export-2.csv").write_text(
        "RespondentID\tHousehold\tSGP_MD2_EndTIme\n1\t99\t20230601\n3\t30\t20230601\n")
    import os
    os.utime(land / "export-2.csv", (2e9, 2e9))
    snapshot_refresh(spark, str(land), "export-", snap, frozen, now=now)
    s = spark.read.parquet(snap)
    assert s.columns[1] == "Data_Import_Datetime" and s.count() == 2
    fr = {(r.RespondentID, r.Household) for r in spark.read.parquet(frozen).collect()}
    assert (3, 30) in fr and (1, 99) not in fr and (1, 10) in fr


def test_run_control(spark):
    log = spark.createDataFrame([(1, 1, 1, dt.datetime(2024, 1, 5, 8)), (2, 2, 2, dt.datetime(2024, 1, 5, 8))],
                                "task_id int, log_id int, status int, log_time timestamp")
    req = spark.createDataFrame([("a", 1, [1]), ("b", 2, [1, 3])], "gate_id string, task_id int, allowed array<int>")
    res = {r.gate_id: (r.passed, r.is_holiday, r.may_run) for r in run_control(log, req, "2024-01-05").collect()}
    assert res == {"a": (True, False, True), "b": (False, False, False)}
    bad = spark.createDataFrame([("a", 1, [1, 9])], "gate_id string, task_id int, allowed array<int>")
    with pytest.raises(ValueError):
        run_control(log, bad, "2024-01-05")


def test_ingest_new_files_once(spark, tmp_path):
    f = Feed("s", _schema("a string, n int"), file_prefix="s_", import_col="import_date")
    land = tmp_path / "land"
    land.mkdir()
    (land / "s_2024-01-01.txt").write_text("x\t1\ny\t2\n")
    target, ck = str(tmp_path / "t"), str(tmp_path / "ck")
    ingest_new_files(spark, str(land), f, target, ck)
    ingest_new_files(spark, str(land), f, target, ck)
    assert spark.read.parquet(target).count() == 2
    (land / "s_2024-01-02.txt").write_text("z\t3\n")
    ingest_new_files(spark, str(land), f, target, ck)
    t = spark.read.parquet(target)
    assert t.count() == 3 and t.columns[0] == "import_date" and t.columns[-1] == "ref_date"


def _zip(path, members):
    import io
    import zipfile
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    path.write_bytes(buf.getvalue())


def _app_bytes(n):
    line = "\t".join(APP_ROW) + "\r\n"
    return b"\xff\xfe" + (line * n).encode("utf-16-le")


def test_shared_landing_reads_only_the_feed(spark, tmp_path):
    from panelflow.schemas import WEB
    land = tmp_path / "land"
    land.mkdir()
    _app_file(land / "usage_app_2023-05-17.txt", 2)
    web = ["x"] * 36
    (land / "usage_web_2023-05-17.txt").write_bytes(b"\xff\xfe" + ("\t".join(web) + "\n").encode("utf-16-le"))
    res = usage_load(spark, str(land), APP, ["2023-05-17"], target=str(tmp_path / "a"))
    assert res.outcome.first().n_rows == 2 and len(res.loaded_files) == 1
    res = usage_load(spark, str(land), WEB, ["2023-05-17"], target=str(tmp_path / "w"))
    assert res.outcome.first().n_rows == 1
    assert len(spark.read.parquet(str(tmp_path / "w")).columns) == 38


def test_daily_load_from_archives(spark, tmp_path):
    from panelflow.plans.usage_load import daily_load
    arch = tmp_path / "arch"
    arch.mkdir()
    _zip(arch / "usage-20230517T000000Z-20230518T000000Z.zip", [("x/web.txt", b""), ("x/app.txt", _app_bytes(3))])
    _zip(arch / "usage-20230518T000000Z-20230519T000000Z.zip", [("x/app.txt", b"\xff\xfe")])
    _zip(arch / "usage-20230519T000000Z-20230520T000000Z.zip", [("x/app.txt", _app_bytes(1))])
    res = daily_load(spark, str(arch), APP, ("2023-05-17", "2023-05-19"), target=str(tmp_path / "t"),
                     work_dir=str(tmp_path / "work"))
    o = res.outcome.first()
    assert (o.status, o.loaded_dates, o.skipped_dates, o.n_rows, o.all_matched) == \
        ("WARNING", "2023-05-17,2023-05-19", "2023-05-18", 4, True)
    res = daily_load(spark, str(arch), APP, ("2023-05-17", "2023-05-20"), target=str(tmp_path / "t"),
                     work_dir=str(tmp_path / "work2"))
    o = res.outcome.first()
    assert o.status == "ERROR" and o.missing_dates == "2023-05-20"


def test_compliance_from_archives(spark, tmp_path):
    from panelflow.plans.usage_load import daily_load
    arch = tmp_path / "arch"
    arch.mkdir()
    _zip(arch / "compliance_2023_05_17.zip", [("daily_compliance.csv", b"PanelistId,Compliant\np1,1\n")])
    _zip(arch / "compliance_2023_05_18.zip", [("other.csv", b"x"), ("daily_compliance.csv", b"")])
    f = COMPLIANCE.with_(schema=_schema("PanelistId string, Compliant int"))
    res = daily_load(spark, str(arch), f, ("2023-05-17", "2023-05-18"), target=str(tmp_path / "t"),
                     work_dir=str(tmp_path / "work"))
    o = res.outcome.first()
    assert o.status == "WARNING" and o.loaded_dates == ""       # all or nothing


def test_ingest_archives_processed_files(spark, tmp_path):
    import os
    f = Feed("s", _schema("a string, n int"), file_prefix="s_", import_col="import_date")
    land, arch = tmp_path / "land", tmp_path / "archive"
    land.mkdir()
    target, ck = str(tmp_path / "t"), str(tmp_path / "ck")
    for day in ("01", "02", "03"):
        (land / f"s_2024-01-{day}.txt").write_text(f"x\t{day}\n")
        ingest_new_files(spark, str(land), f, target, ck, archive_dir=str(arch),
                         max_files_per_trigger=1)
    assert spark.read.parquet(target).count() == 3
    moved = [n for _, _, fs in os.walk(arch) for n in fs]
    assert moved and set(moved) <= {"s_2024-01-01.txt", "s_2024-01-02.txt", "s_2024-01-03.txt"}
    assert not set(moved) & set(os.listdir(land))


def test_reconcile_flags_a_mismatch(spark, tmp_path):
    # a no-break-space line: Spark's reader keeps it as a row, a Python
    # strip() line count drops it, so the day does not reconcile
    land = tmp_path / "land"
    land.mkdir()
    line = "\t".join(APP_ROW) + "\n"
    (land / "usage_app_2023-05-17.txt").write_bytes(b"\xff\xfe" + (line + "\xa0\n" + line).encode("utf-16-le"))
    _app_file(land / "usage_app_2023-05-18.txt", 2, crlf=False)
    res = usage_load(spark, str(land), APP, ("2023-05-17", "2023-05-18"), target=str(tmp_path / "t"))
    rec = {r.ref_date.day: (r.count_df, r.count_raw, r.matched) for r in res.reconcile.collect()}
    assert rec == {17: (3, 2, False), 18: (2, 2, True)}
    out = res.outcome.first()
    assert out.status == "WARNING" and out.all_matched is False
    assert out.checks == ('[{"ref_date":"2023-05-17","count_df":3,"count_raw":2},'
                          '{"ref_date":"2023-05-18","count_df":2,"count_raw":2}]')


def test_run_control_on_the_run_log(spark, tmp_path):
    p = str(tmp_path / "log")
    _, a = log_start(spark, p, 88, 2, "started", now=dt.datetime(2024, 1, 4, 9))
    log_status(spark, p, a, 1, "done", now=dt.datetime(2024, 1, 4, 10))
    _, b = log_start(spark, p, 89, 2, "started", now=dt.datetime(2024, 1, 4, 9))
    log_start(spark, p, 89, 2, "started late", now=dt.datetime(2024, 1, 6, 9))   # after the day
    runs = current_runs(spark, p).withColumnRenamed("started", "t").drop("log_time") \
        .withColumnRenamed("t", "log_time")
    req = spark.createDataFrame([("pld", 88, [1, 3]), ("pld", 89, [1]), ("chk", 89, [2])],
                                "gate_id string, task_id int, allowed array<int>")
    res = {r.gate_id: (r.passed, r.may_run) for r in run_control(runs, req, "2024-01-05", as_of=True).collect()}
    assert res == {"pld": (False, False), "chk": (True, True)}
    sat = {r.gate_id: (r.is_holiday, r.may_run) for r in run_control(runs, req, "2024-01-06", as_of=True).collect()}
    assert sat["chk"] == (True, False)           # Saturday counts as holiday by default


def test_ingest_replaces_a_file_delivered_again(spark, tmp_path):
    f = Feed("s", _schema("a string, n int"), file_prefix="s_", import_col="import_date")
    land = tmp_path / "land"
    (land / "a").mkdir(parents=True)
    (land / "a" / "s_2024-01-01.txt").write_text("x\t1\ny\t2\n")
    (land / "a" / "s_2024-01-02.txt").write_text("z\t3\n")
    target, ck = str(tmp_path / "t"), str(tmp_path / "ck")
    ingest_new_files(spark, str(land), f, target, ck, mode="replace_files")
    (land / "a" / "s_2024-01-01.txt").write_text("x2\t10\n")      # day 1 delivered again
    ingest_new_files(spark, str(land), f, target, ck, mode="replace_files")
    got = sorted((r.ref_date.day, r.a) for r in spark.read.parquet(target).collect())
    assert got == [(1, "x2"), (2, "z")]


def test_daily_loads_open_each_archive_once(spark, tmp_path):
    from panelflow.plans.usage_load import daily_loads
    from panelflow.schemas import WEB
    arch = tmp_path / "arch"
    arch.mkdir()
    web_line = ("\t".join(["w"] * 35) + "\t42\n").encode("utf-16-le")
    _zip(arch / "usage-20230517T000000Z-20230518T000000Z.zip",
         [("d/app.txt", _app_bytes(2)), ("d/web.txt", b"\xff\xfe" + web_line * 3)])
    _zip(arch / "usage-20230518T000000Z-20230519T000000Z.zip", [("d/app.txt", _app_bytes(1))])
    targets = {"app": str(tmp_path / "app"), "web": str(tmp_path / "web")}
    res = daily_loads(spark, str(arch), [APP, WEB], ("2023-05-17", "2023-05-18"), targets=targets,
                      work_dir=str(tmp_path / "work"))
    a, w = res["app"].outcome.first(), res["web"].outcome.first()
    assert (a.status, a.n_rows) == ("OK", 3)
    assert w.status == "ERROR" and w.missing_dates == "2023-05-18"
    res = daily_loads(spark, str(arch), [APP, WEB], ["2023-05-17"], targets=targets,
                      work_dir=str(tmp_path / "work2"))
    assert res["web"].outcome.first().n_rows == 3
    assert spark.read.parquet(targets["web"]).first().AppClientKey == "42"


def test_command_line_daily_load(tmp_path):
    import json
    import subprocess
    import sys
    from tests.conftest import ROOT
    arch = tmp_path / "arch"
    arch.mkdir()
    _zip(arch / "usage-20230517T000000Z-20230518T000000Z.zip", [("d/app.txt", _app_bytes(2))])
    r = subprocess.run([sys.executable, "-m", "panelflow", "--master", "local[2]", "usage", "--feed", "app",
                        "--archives", str(arch), "--target", str(tmp_path / "t"), "--days", "2023-05-17"],
                       cwd=ROOT, capture_output=True, text=True, timeout=600)
    out = json.loads(r.stdout.strip().splitlines()[-1])
    assert r.returncode == 0 and out["status"] == "OK" and out["n_rows"] == 2, r.stderr[-1500:]


def test_absent_or_empty_landing_is_an_error_outcome(spark, tmp_path):
    res = usage_load(spark, str(tmp_path / "nowhere"), APP, ("2023-05-17", "2023-05-18"), target=str(tmp_path / "t"))
    o = res.outcome.first()
    assert o.status == "ERROR" and o.missing_dates == "2023-05-17,2023-05-18"
    (tmp_path / "empty").mkdir()
    assert usage_load(spark, str(tmp_path / "empty"), APP, ["2023-05-17"],
                      target=str(tmp_path / "t")).outcome.first().status == "ERROR"


def test_usage_load_append_mode(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    _app_file(land / "usage_app_2023-05-17.txt", 3)
    target = str(tmp_path / "t")
    for _ in range(2):
        res = usage_load(spark, str(land), APP, ["2023-05-17"], target=target, mode="append")
        o = res.outcome.first()
        assert (o.status, o.n_rows, o.all_matched) == ("OK", 3, True)   # counted from this run's files
    assert spark.read.parquet(target).count() == 6                     # append keeps both runs


def test_usage_load_without_raw_check(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    _app_file(land / "usage_app_2023-05-17.txt", 3)
    res = usage_load(spark, str(land), APP, ["2023-05-17"], target=str(tmp_path / "t"), check_raw=False)
    r = res.reconcile.first()
    assert (r.count_df, r.count_raw, r.matched) == (3, None, None)
    o = res.outcome.first()
    assert o.n_rows == 3 and o.all_matched is None


def test_command_line_gate_and_snapshot(spark, tmp_path):
    import json
    import subprocess
    import sys
    from tests.conftest import ROOT
    log = str(tmp_path / "log")
    _, lid = log_start(spark, log, 88, 2, "started", now=dt.datetime(2024, 1, 4, 9))
    log_status(spark, log, lid, 1, "done", now=dt.datetime(2024, 1, 4, 10))
    req = tmp_path / "req.json"
    req.write_text(json.dumps([{"gate_id": "g", "task_id": 88, "allowed": [1, 3]}]))
    r = subprocess.run([sys.executable, "-m", "panelflow", "--master", "local[2]", "gate", "--log", log,
                        "--requirements", str(req), "--day", "2024-01-05", "--as-of"],
                       cwd=ROOT, capture_output=True, text=True, timeout=600)
    out = json.loads(r.stdout.strip().splitlines()[-1])
    assert r.returncode == 0 and out["may_run"] is True, r.stderr[-1500:]
    land = tmp_path / "land"
    land.mkdir()
    (land / "export-1.csv").write_text("RespondentID\tSGP_MD2_EndTIme\n1\t20230517\n")
    r = subprocess.run([sys.executable, "-m", "panelflow", "--master", "local[2]", "snapshot", "--landing",
                        str(land), "--contains", "export-", "--snapshot", str(tmp_path / "s"),
                        "--frozen", str(tmp_path / "f")], cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0 and json.loads(r.stdout.strip().splitlines()[-1])["status"] == "OK", r.stderr[-1500:]


def test_usage_load_archives_processed_files(spark, tmp_path):
    import os
    land, arch = tmp_path / "land", tmp_path / "archived"
    land.mkdir()
    _app_file(land / "usage_app_2023-05-17.txt", 2)
    (land / "usage_app_2023-05-18.txt").write_bytes(b"")
    (land / "usage_web_2023-05-17.txt").write_bytes(b"\xff\xfe")          # another feed: stays
    res = usage_load(spark, str(land), APP, ("2023-05-17", "2023-05-18"), target=str(tmp_path / "t"),
                     archive_dir=str(arch))
    assert res.outcome.first().status == "WARNING"
    assert sorted(os.listdir(arch)) == ["usage_app_2023-05-17.txt", "usage_app_2023-05-18.txt"]
    assert os.listdir(land) == ["usage_web_2023-05-17.txt"]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_snapshot_refresh_archives_the_file(spark, tmp_path):
    import os
    land, arch = tmp_path / "land", tmp_path / "arch"
    land.mkdir()
    (land / "export-7.csv").write_text("RespondentID\tSGP_MD2_EndTIme\n5\t20230517\n")
    snapshot_refresh(spark, str(land), "export-", str(tmp_path / "s"), str(tmp_path / "f"),
                     now=dt.datetime(2024, 3, 18, 13, 15, 2), archive_dir=str(arch))
    assert os.listdir(arch) == ["export-7_2024-03-18 13-15-02.csv"] and os.listdir(land) == []
