"""Day values carried in file paths and file names."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKENS = (("yyyy", r"\d{4}"), ("MM", r"\d{2}"), ("dd", r"\d{2}"))


def day_regex(fmt: str) -> str:
    """Regex for a day written with a simple pattern such as ``yyyy-MM-dd``."""
    rx = ""
    i = 0
    while i < len(fmt):
        for tok, sub in _TOKENS:
            if fmt.startswith(tok, i):
                rx += sub
                i += len(tok)
                break
        else:
            if fmt[i] == "'":
                j = fmt.index("'", i + 1)
                rx += "".join("\\" + c if not c.isalnum() else c
                              for c in fmt[i + 1:j])
                i = j + 1
            else:
                rx += "\\" + fmt[i] if not fmt[i].isalnum() else fmt[i]
                i += 1
    return rx


def parse_day(text: Column, fmt: str) -> Column:
    """Text → date; anything that does not parse becomes NULL (ANSI-safe)."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def parse_path_day(path: str, fmt: str) -> _dt.date | None:
    """:func:`day_from_path` for one path on the driver."""
    found = re.findall(f"(?={'(' + day_regex(fmt) + ')'})", path)
    if not found:
        return None
    plain = fmt.replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d").replace("'", "")
    try:
        return _dt.datetime.strptime(found[-1], plain).date()
    except ValueError:
        return None


def day_from_path(path: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """The last day written in ``fmt`` anywhere in a path, as a date.

    Works for ``name_<day>.txt`` deliveries and ``col=<day>/part-…``
    folders alike; evaluated per row but JVM-side, inside codegen.
    """
    rx = ".*(" + day_regex(fmt) + ")"
    text = F.regexp_extract(path, rx, 1)
    # no day in the path: NULL without attempting a (slow, failing) parse
    return F.when(text != "", parse_day(text, fmt))
