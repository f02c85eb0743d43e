"""Operators on small hand-made frames: NOT IN edge cases, run control, gates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelflow.functions.columns import (
    add_import_datetime, date_key, null_out, parse_compact_date, place_columns)
from panelflow.operators.control import (
    gate_passed, invalid_status_codes, is_holiday, latest_status, prerequisite_status)
from panelflow.operators.gates import empty_feeds, load_plan, run_outcome
from panelflow.operators.keys import new_keys, newest, valid_dates
from panelflow.operators.reconcile import non_blank_lines
from panelflow.schemas import APP, EVENTS


def _keys(spark, vals, name="k"):
    return spark.createDataFrame([(v,) for v in vals], f"{name} bigint")


@pytest.mark.parametrize("target", [[1, 2], [1, None], [None, None], [7, 8], []])
def test_new_keys_equals_not_in(spark, target):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c2"), (None, "n")], "k bigint, v string")
    tgt = _keys(spark, target, "t")
    got = sorted(new_keys(src, tgt, "k", "t").collect(), key=repr)
    src.createOrReplaceTempView("s")
    tgt.createOrReplaceTempView("tg")
    want = sorted(spark.sql("SELECT * FROM s WHERE k NOT IN (SELECT t FROM tg)").collect(), key=repr)
    assert got == want


def test_latest_status_as_of_and_on_day(spark):
    log = spark.createDataFrame([
        (1, 10, 2, dt.datetime(2024, 1, 1, 9)), (1, 11, 1, dt.datetime(2024, 1, 2, 9)),
        (1, 12, 3, dt.datetime(2024, 1, 3, 9)), (2, 20, 2, dt.datetime(2023, 12, 31, 9))],
        "task_id int, log_id int, status int, log_time timestamp")
    asof = {r.task_id: r.status for r in latest_status(log, "2024-01-02", as_of=True).collect()}
    assert asof == {1: 1, 2: 2}
    on_day = {r.task_id: r.status for r in latest_status(log, "2024-01-02", as_of=False).collect()}
    assert on_day == {1: 1}


def test_prerequisites_and_gates(spark):
    req = spark.createDataFrame([("g1", 1, [1, 3]), ("g1", 2, [1]), ("g2", 3, [-1])],
                                "gate_id string, task_id int, allowed array<int>")
    latest = spark.createDataFrame([(1, 3), (2, 2)], "task_id int, status int")
    chk = prerequisite_status(req, latest)
    assert {(r.task_id, r.status, r.ok) for r in chk.collect()} == {(1, 3, True), (2, 2, False), (3, -1, True)}
    gates = spark.createDataFrame([("g1",), ("g2",), ("g3",)], "gate_id string")
    res = {r.gate_id: r.passed for r in gate_passed(chk, gates=gates).collect()}
    assert res == {"g1": False, "g2": True, "g3": True}


def test_invalid_status_codes(spark):
    req = spark.createDataFrame([(1, [1, 3]), (2, [5, 1, 0, 5])], "t int, allowed array<int>")
    assert {r.t: r.invalid for r in invalid_status_codes(req).collect()} == {1: "", 2: "0,5"}


def test_is_holiday(spark):
    dates = spark.createDataFrame([("2024-01-01",), ("2024-01-06",), ("2024-01-08",)], "d string")
    cal = spark.createDataFrame([("2024-01-01",)], "holiday string")
    w = {r.d: r.is_holiday for r in is_holiday(dates, cal, 1).collect()}
    assert w == {"2024-01-01": True, "2024-01-06": True, "2024-01-08": False}
    nw = {r.d: r.is_holiday for r in is_holiday(dates, cal, 0).collect()}
    assert nw["2024-01-06"] is False
    with pytest.raises(ValueError):
        is_holiday(dates, cal, 2)


def test_columns(spark):
    df = spark.createDataFrame([("20230517", "NA", "x"), ("bad", "ok", "y")], "d string, s string, z string")
    assert [r.d for r in parse_compact_date(df, "d").collect()] == [dt.date(2023, 5, 17), None]
    assert [r.s for r in null_out(df).collect()] == [None, "ok"]
    out = add_import_datetime(df, now=dt.datetime(2024, 2, 1, 13, 15))
    assert out.columns[1] == "Data_Import_Datetime" and out.first()[1] == "2024-02-01 13:15:00"
    assert place_columns(df, ["z"], 0).columns == ["z", "d", "s"]
    k = spark.createDataFrame([("2023_05_17",)], "d string").select(
        date_key("d", "yyyy-MM-dd", frm="yyyy_MM_dd").alias("a"),
        date_key("d", "yyyyMMdd'T'000000'Z'", frm="yyyy_MM_dd", days=1).alias("b")).first()
    assert (k.a, k.b) == ("2023-05-17", "20230518T000000Z")


def test_non_blank_matches_python_strip(spark):
    lines = ["a", "", "  ", "\t\t", "\x1c", "\xa0", " b "]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert non_blank_lines(df).count() == sum(1 for x in lines if x.strip() != "")


def test_valid_dates_and_newest(spark):
    req = spark.createDataFrame([("2024-01-02",), ("2024-01-01",), ("2024-01-02",)], "d string")
    empty = spark.createDataFrame([("2024-01-01",)], "d string")
    assert [r.d for r in valid_dates(req, empty).collect()] == ["2024-01-02"]
    df = spark.range(100).withColumn("t", F.col("id") % 7)
    assert [r.id for r in newest(df, "t", 3, "id").collect()] == [97, 90, 83]


def test_empty_feeds_zero_and_mark_only(spark, tmp_path):
    (tmp_path / "usage_app_2024-01-01.txt").write_bytes(b"")
    (tmp_path / "usage_app_2024-01-02.txt").write_bytes(b"\xff\xfe")
    (tmp_path / "usage_app_2024-01-03.txt").write_bytes(b"\xff\xfe" + "a\n".encode("utf-16-le"))
    got = sorted(r.ref_date for r in empty_feeds(spark, str(tmp_path), APP).collect())
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    (tmp_path / "u8").mkdir()
    (tmp_path / "u8" / "events_2024-01-04.txt").write_bytes(b"\xef\xbb\xbf")
    assert empty_feeds(spark, str(tmp_path / "u8"), EVENTS).count() == 1


def test_load_plan_policies_and_outcome(spark):
    exp = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3)], "ref_date date")
    emp = spark.createDataFrame([(dt.date(2024, 1, 2),)], "ref_date date")
    assert load_plan(exp, emp, "skip_empty").count() == 2
    assert load_plan(exp, emp, "all_or_nothing").count() == 0
    none = spark.createDataFrame([], "ref_date date")
    assert load_plan(exp, none, "all_or_nothing").count() == 3
    recon = spark.createDataFrame([(dt.date(2024, 1, 1), 5, 5, True)],
                                  "ref_date date, count_df bigint, count_raw bigint, matched boolean")
    warn = run_outcome(spark, load_plan(exp, emp), recon, empty=emp).first()
    assert (warn.status, warn.loaded_dates, warn.skipped_dates, warn.n_rows) == \
        ("WARNING", "2024-01-01,2024-01-03", "2024-01-02", 5)
    assert run_outcome(spark, exp, recon).first().status == "OK"
    assert run_outcome(spark, exp, recon, missing=emp).first().status == "ERROR"
    assert run_outcome(spark, exp, recon, error="boom").first().error == "boom"
