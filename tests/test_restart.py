"""Backfills that are taken up again, and a run log compacted while it is written."""

import datetime as dt

from panelflow.plans import backfill as module
from panelflow.plans.backfill import backfill, committed
from panelflow.plans.usage_load import usage_load
from panelflow.schemas import Feed
from panelflow.sinks import runlog
from panelflow.sinks.paths import files, folders
from panelflow.sinks.runlog import compact_log, current_runs, log_events, log_start, log_status
from panelflow.schemas import _schema

S = Feed("s", _schema("a string, n int"), file_prefix="s_", import_col="import_date")
DAYS = ("2024-01-01", "2024-01-07")


def _deliver(land, days, text="x{d}\t{d}\n"):
    land.mkdir(exist_ok=True)
    for d in days:
        (land / f"s_2024-01-0{d}.txt").write_text(text.format(d=d))


def _rows(spark, t):
    return sorted((r.ref_date.day, r.a) for r in spark.read.parquet(str(t)).collect())


def test_a_killed_backfill_goes_on_with_the_days_left(spark, tmp_path, monkeypatch):
    land, t, c = tmp_path / "land", str(tmp_path / "t"), str(tmp_path / "commits")
    _deliver(land, range(1, 8))
    calls = []

    def killed(spark_, landing, f, chunk, **kw):
        calls.append([d.day for d in chunk])
        out = usage_load(spark_, landing, f, chunk, **kw)
        if len(calls) == 2:
            raise KeyboardInterrupt                      # after the step has loaded, before its commit rows
        return out
    monkeypatch.setattr(module, "usage_load", killed)
    try:
        backfill(spark, str(land), S, DAYS, target=t, commits=c, days_a_step=2)
    except KeyboardInterrupt:
        pass
    assert sorted(r.ref_date.day for r in committed(spark, c).collect()) == [1, 2]
    out = backfill(spark, str(land), S, DAYS, target=t, commits=c, days_a_step=2).outcome.first()
    assert calls == [[1, 2], [3, 4], [3, 4], [5, 6], [7]]
    assert _rows(spark, t) == [(d, f"x{d}") for d in range(1, 8)]
    assert (out.status, out.n_rows, out.all_matched) == ("OK", 7, True) and out.loaded_dates.count(",") == 6
    again = backfill(spark, str(land), S, DAYS, target=t, commits=c).outcome.first()
    assert len(calls) == 5 and again == out


def test_backfill_checks_all_days_before_it_loads_any(spark, tmp_path):
    land, t, c = tmp_path / "land", str(tmp_path / "t"), str(tmp_path / "commits")
    _deliver(land, [1, 2, 3, 4, 5, 7])
    out = backfill(spark, str(land), S, DAYS, target=t, commits=c, days_a_step=2).outcome.first()
    assert out.status == "ERROR" and out.missing_dates == "2024-01-06" and not (tmp_path / "t").exists()
    _deliver(land, [6], "")
    strict = S.with_(policy="all_or_nothing")
    out = backfill(spark, str(land), strict, DAYS, target=t, commits=c, days_a_step=2).outcome.first()
    assert (out.status, out.loaded_dates, out.skipped_dates) == ("WARNING", "", "2024-01-06") and not (tmp_path / "t").exists()
    out = backfill(spark, str(land), S, DAYS, target=t, commits=c, days_a_step=3, steps=1).outcome.first()
    assert out.loaded_dates == "2024-01-01,2024-01-02,2024-01-03"
    out = backfill(spark, str(land), S, DAYS, target=t, commits=c, days_a_step=3).outcome.first()
    assert (out.status, out.skipped_dates, out.n_rows) == ("WARNING", "2024-01-06", 6)
    assert _rows(spark, t) == [(d, f"x{d}") for d in (1, 2, 3, 4, 5, 7)]


def test_no_event_is_lost_in_a_compaction(spark, tmp_path, monkeypatch):
    p = str(tmp_path / "log")
    _, a = log_start(spark, p, 1, 2, "started", now=dt.datetime(2024, 1, 4, 9))
    real = runlog.rename
    late = []

    def publish(spark_, src, dst):                       # an event comes while the base is written
        late.append(log_start(spark_, p, 2, 2, "meanwhile", now=dt.datetime(2024, 1, 4, 9))[1])
        real(spark_, src, dst)
    monkeypatch.setattr(runlog, "rename", publish)
    for k in range(4):
        log_status(spark, p, a, k, f"step {k}", now=dt.datetime(2024, 1, 4, 10 + k))
        compact_log(spark, p)
        assert log_events(spark, p).count() == 1 + (k + 1) + len(late)
    monkeypatch.setattr(runlog, "rename", real)
    compact_log(spark, p)
    n = len(files(spark, p))
    compact_log(spark, p)                                # nothing new: no new base
    runs = {r.log_id: (r.status, r.message, r.task_id) for r in current_runs(spark, p).collect()}
    assert runs[a] == (3, "step 3", 1) and all(runs[x] == (2, "meanwhile", 2) for x in late) and len(runs) == 5
    assert len(folders(spark, f"{p}/_base")) <= 2 and n <= 3


def test_a_large_base_is_many_files_and_no_task_sorts_a_file(spark, tmp_path, monkeypatch):
    p = str(tmp_path / "log")
    monkeypatch.setattr(runlog, "ROWS_A_FILE", 10)
    runs = spark.range(0, 95, 1, 4).selectExpr("cast(id as string) log_id", "cast(id as int) task_id", "2 status",
                                               "timestamp'2024-01-01 00:00:00' log_time", "'started' message", "0L seq")
    runlog.append_events(runs, p)
    compact_log(spark, p)
    runlog.append_events(runs.selectExpr("log_id", "cast(null as int) task_id", "1 status", "log_time + interval 1 hour log_time", "'done' message", "1L seq"), p)
    base = f"{p}/_base/1/events"
    per_file = spark.read.parquet(base).groupBy("_metadata.file_name").count().collect()
    assert sum(r["count"] for r in per_file) == 95 and max(r["count"] for r in per_file) <= 10 and len(per_file) >= 10
    now = runlog.current_runs(spark, p)
    plan = now._jdf.queryExecution().sparkPlan().toString()
    assert "Repartition" in plan or "hashpartitioning(log_id" in plan
    assert {(r.log_id, r.task_id, r.status, r.message) for r in now.collect()} == {(str(k), k, 1, "done") for k in range(95)}


def test_a_failed_compaction_leaves_the_log_as_it_was(spark, tmp_path, monkeypatch):
    p = str(tmp_path / "log")
    log_start(spark, p, 1, 2, "started")

    def fails(*_):
        raise OSError("no rename")
    monkeypatch.setattr(runlog, "rename", fails)
    try:
        compact_log(spark, p)
    except OSError:
        pass
    assert log_events(spark, p).count() == 1 and folders(spark, f"{p}/_base") == []


def test_a_plan_of_many_part_files_is_one_row_a_day(spark, tmp_path, monkeypatch):
    from panelflow.plans.usage_load import deliveries
    land = tmp_path / "la nd+"
    want = {dt.date(2024, 1, d): f"s_2024-01-0{d}.txt" for d in range(1, 8)}
    for d in range(1, 8):
        for k in range(60):
            p = land / f"day=2024-01-0{d}" / f"part-{k:03d} +%.txt"
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_bytes(b"" if k % 3 == 0 or d == 4 else b"\xef\xbb\xbf" if k % 3 == 1 else f"x{k}\t{d}\n".encode())
    taken = []
    frame = type(spark.range(1))
    real = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: taken.append(len(out := real(self))) or out)
    got = deliveries(spark, str(land), S, want, "day", layout="day={day}")
    assert max(taken) == 7 and {d.day: tuple(n) for d, n in got.days.items()} == {d: (60, 60 if d == 4 else 40) for d in range(1, 8)}
    res = usage_load(spark, str(land), S, DAYS, target=str(tmp_path / "t"), match="day", layout="day={day}", archive_dir=str(tmp_path / "arch"))
    out = res.outcome.first()
    assert (out.status, out.skipped_dates, out.n_rows, out.all_matched) == ("WARNING", "2024-01-04", 120, True)
    assert sum(1 for p in (tmp_path / "arch").rglob("part-*") if p.is_file()) == 420 and not list(land.rglob("part-*.txt"))
