"""Spark-native loading and control of daily media-panel usage data.

Every operator takes and returns DataFrames; nothing loops over dates on the
driver. See README.md for the operator map. The main entry points can be
imported from the package itself, e.g. ``from panelflow import usage_load``.
"""

import importlib as _importlib
import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers (archive extraction, file moves)
# travel with the task, so executors need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

_API = {
    "get_session": "panelflow.session",
    "read_usage": "panelflow.sources.usage",
    "raw_lines": "panelflow.sources.usage",
    "read_snapshot": "panelflow.sources.header",
    "read_compliance": "panelflow.sources.header",
    "list_files": "panelflow.sources.files",
    "latest_file": "panelflow.sources.files",
    "expected_files": "panelflow.sources.files",
    "archive_members": "panelflow.sources.archive",
    "query_df": "panelflow.sources.sql",
    "query_rows": "panelflow.sources.sql",
    "new_keys": "panelflow.operators.keys",
    "latest_status": "panelflow.operators.control",
    "prerequisite_status": "panelflow.operators.control",
    "gate_passed": "panelflow.operators.control",
    "is_holiday": "panelflow.operators.control",
    "reconcile": "panelflow.operators.reconcile",
    "empty_feeds": "panelflow.operators.gates",
    "missing_feeds": "panelflow.operators.gates",
    "load_plan": "panelflow.operators.gates",
    "run_outcome": "panelflow.operators.gates",
    "append_table": "panelflow.sinks.tables",
    "replace_table": "panelflow.sinks.tables",
    "append_new": "panelflow.sinks.tables",
    "load_dates": "panelflow.sinks.tables",
    "update_table": "panelflow.sinks.tables",
    "log_start": "panelflow.sinks.runlog",
    "log_status": "panelflow.sinks.runlog",
    "current_runs": "panelflow.sinks.runlog",
    "ingest_new_files": "panelflow.streaming.ingest",
    "usage_load": "panelflow.plans.usage_load",
    "daily_load": "panelflow.plans.usage_load",
    "daily_loads": "panelflow.plans.usage_load",
    "snapshot_refresh": "panelflow.plans.snapshot",
    "run_control": "panelflow.plans.run_control",
}


def __getattr__(name):
    if name in _API:
        return getattr(_importlib.import_module(_API[name]), name)
    raise AttributeError(f"module 'panelflow' has no attribute {name!r}")


def __dir__():
    return sorted(list(globals()) + list(_API))
