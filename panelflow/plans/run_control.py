"""May a task run today?

requirements checked (X2) → latest log status per required task (W1) →
joined to the requirements (J2) → allowed? (F2) → all allowed per gate (A3),
beside the holiday test (J3's rule, for the one reference day). One join for all tasks and gates at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.operators.control import (
    gate_passed, invalid_status_codes, latest_status, prerequisite_status)


def bad_requirements(req: DataFrame, allowed_col: str = "allowed") -> DataFrame:
    """The requirements that allow an unknown status, with those codes."""
    return invalid_status_codes(req, allowed_col).filter(F.col("invalid") != "")


def check_requirements(req: DataFrame, allowed_col: str = "allowed") -> None:
    """X2 as a guard: raise if any requirement allows an unknown status."""
    n, codes = bad_requirements(req, allowed_col).agg(
        F.count("*"), F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.split("invalid", ","))))), ",")).first()
    if n:
        raise ValueError(f"{n} requirements have invalid allowed status codes ({codes}); see bad_requirements()")


def run_control(log: DataFrame, req: DataFrame, ref_date, *, calendar: DataFrame | None = None,
                include_weekend: int = 1, gate_col: str = "gate_id", as_of: bool = False) -> DataFrame:
    """Per gate: ``passed`` (every prerequisite's latest status on
    ``ref_date``, or up to it with ``as_of``, is allowed), ``is_holiday`` and ``may_run``.

    ``req``: ``gate_id, task_id, allowed array<int>``; ``log``:
    ``task_id, log_id, status, log_time``.
    """
    check_requirements(req)
    # only the required tasks' rows of the log reach the aggregate
    log = log.join(req.select("task_id").distinct(), "task_id", "left_semi")
    latest = latest_status(log, ref_date, as_of=as_of)
    checked = prerequisite_status(req, latest)
    gates = gate_passed(checked, gate_col, "ok", gates=req)
    if include_weekend not in (0, 1):
        raise ValueError(f"include_weekend must be 0 or 1, got {include_weekend!r}")
    d = F.lit(str(ref_date)).cast("date")
    # one day for every gate: a scalar lookup in the calendar, not a join
    hit = F.weekday(d) >= 5 if include_weekend else F.lit(False)
    if calendar is not None:
        in_cal = calendar.select(F.coalesce(F.max(F.col("holiday").cast("date") == d),
                                            F.lit(False))).scalar()
        hit = hit | in_cal
    day = gates.withColumn("d", d).withColumn("is_holiday", hit)
    return day.select(gate_col, "d", "passed", "is_holiday",
                      (F.col("passed") & ~F.col("is_holiday")).alias("may_run"))
