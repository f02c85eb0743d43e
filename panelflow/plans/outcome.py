"""Every pipeline ends in one outcome row (Q4), and may keep a run log (K5)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import SparkSession

from panelflow.sinks.runlog import log_start, log_status

# Run-log status while a run is going on, and by outcome. A run that ended in
# an error keeps the status of one that has not finished, so no gate passes it.
STARTED = 2
STATUS = {"OK": 1, "WARNING": 3, "ERROR": STARTED}


class RunLog(NamedTuple):
    """Where a pipeline's runs are logged, and as which task."""
    path: str
    task_id: int


def message(error: BaseException) -> str:
    """One line that names an exception."""
    return f"{type(error).__name__}: {(str(error).strip().splitlines() or [''])[0][:500]}"


def logged(spark: SparkSession, log: RunLog | None, what: str, run: Callable, failed: Callable):
    """``run()``; an exception becomes ``failed(text)`` instead of escaping.

    Both return an object with a one-row ``outcome``. With ``log`` the run is
    opened before and closed after with the status of its outcome.
    """
    log_id = log_start(spark, log.path, log.task_id, STARTED, f"{what} has started")[1] if log else None
    try:
        result = run()
    except Exception as e:  # noqa: BLE001  whatever it is, the run ends with a row that says so
        result = failed(message(e))
    if log:
        r = result.outcome.first()
        log_status(spark, log.path, log_id, STATUS[r.status], r.error or f"{what}: {r.status}, {r.n_rows} rows",
                   now=_dt.datetime.now(_dt.timezone.utc))
    return result
