"""Run control: W1 latest status, J2 prerequisites, F2, A3, X2, J3."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelflow.schemas import STATUS_CODES


def latest_status(log: DataFrame, ref_date=None, *, as_of: bool = False,
                  task_col: str | list[str] = "task_id", time_col: str = "log_time",
                  id_col: str = "log_id", status_col: str = "status") -> DataFrame:
    """Each task's last log row (by time, then log id).

    ``ref_date`` bounds the log to rows on that day, or with ``as_of=True``
    to rows on or before it. The pick is a ``max`` over a
    struct, i.e. a partial aggregate: a task with a third of all rows still
    reduces map-side instead of being sorted in one task.
    """
    if ref_date is not None:
        d = (F.lit(ref_date.strftime("%Y-%m-%d") if isinstance(ref_date, (_dt.date, _dt.datetime))
                   else ref_date).cast("date"))
        t = F.col(time_col)
        end = F.date_add(d, 1).cast("timestamp_ntz")
        cond = t < end if as_of else (t >= d.cast("timestamp_ntz")) & (t < end)
        log = log.filter(cond)
    best = F.max(F.struct(F.col(time_col).alias("t"), F.col(id_col).alias("i"),
                          F.col(status_col).alias("s"))).alias("b")
    keys = [task_col] if isinstance(task_col, str) else list(task_col)
    return (log.groupBy(*keys).agg(best)
            .select(*keys, F.col("b.i").alias(id_col), F.col("b.s").alias(status_col),
                    F.col("b.t").alias(time_col)))


def status_allowed(status: Column | str, allowed: Column | str) -> Column:
    """is the status in the task's allowed list."""
    s = F.col(status) if isinstance(status, str) else status
    a = F.col(allowed) if isinstance(allowed, str) else allowed
    return F.coalesce(F.array_contains(a, s), F.lit(False))


def prerequisite_status(req: DataFrame, latest: DataFrame, task_col: str = "task_id",
                        status_col: str = "status", allowed_col: str | None = "allowed") -> DataFrame:
    """J2 (+F2): every required task with its latest status, -1 when none.

    One join for all tasks instead of one database round trip per task.
    """
    lat = latest.select(task_col, F.col(status_col).alias("__s"))
    out = (req.join(lat, task_col, "left")
           .withColumn(status_col, F.coalesce(F.col("__s"), F.lit(-1)).cast("int"))
           .drop("__s"))
    if allowed_col:
        out = out.withColumn("ok", status_allowed(status_col, allowed_col))
    return out


def gate_passed(checked: DataFrame, gate_col: str = "gate_id", ok_col: str = "ok",
                gates: DataFrame | None = None) -> DataFrame:
    """A3: a gate passes when all its prerequisites are allowed; a gate
    with no prerequisites passes (pass ``gates`` to list such gates)."""
    agg = checked.groupBy(gate_col).agg(F.bool_and(F.col(ok_col)).alias("passed"))
    if gates is None:
        return agg
    return (gates.select(gate_col).distinct().join(agg, gate_col, "left")
            .select(gate_col, F.coalesce(F.col("passed"), F.lit(True)).alias("passed")))


def invalid_status_codes(req: DataFrame, allowed_col: str = "allowed",
                         name: str = "invalid") -> DataFrame:
    """The allowed codes outside the valid set, sorted, as text."""
    valid = F.array(*[F.lit(c) for c in STATUS_CODES])
    bad = F.array_sort(F.array_except(F.col(allowed_col), valid))
    return req.withColumn(name, F.array_join(bad, ","))


def is_holiday(dates: DataFrame, calendar: DataFrame, include_weekend: int,
               date_col: str = "d", holiday_col: str = "holiday",
               name: str = "is_holiday") -> DataFrame:
    """A date is a holiday if the calendar has it, or, with
    ``include_weekend=1``, if it falls on Saturday or Sunday.

    How the calendar (one row per holiday) is joined is the planner's
    choice, from sizes measured at run time.
    """
    if include_weekend not in (0, 1):
        raise ValueError(f"include_weekend must be 0 or 1, got {include_weekend!r}")
    cal = (calendar.select(F.col(holiday_col).cast("date").alias("__h"))
           .filter(F.col("__h").isNotNull()).distinct())
    d = F.col(date_col).cast("date")
    hit = F.col("__h").isNotNull()
    if include_weekend:
        hit = hit | (F.weekday(d) >= 5)
    return (dates.join(cal, d == F.col("__h"), "left")
            .withColumn(name, hit).drop("__h"))
