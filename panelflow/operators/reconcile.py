"""Did every day load completely?"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelflow.functions.dates import day_from_path
from panelflow.schemas import Feed
from panelflow.sources.usage import FILE_COL

# Python's str.strip() whitespace: Unicode White_Space plus the four
# information separators U+001C … U+001F.
_BLANK = r"(?U)^[\s\x{1c}-\x{1f}]*$"


def is_blank(c: Column) -> Column:
    # a line that begins with a printable ASCII character needs no pattern
    return c.isNull() | (~F.ascii(c).between(33, 126) & c.rlike(_BLANK))


def non_blank_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """drop lines that are empty after stripping whitespace."""
    return lines.filter(~is_blank(F.col(col)))


def parsed_count(df: DataFrame, ref_col: str = "ref_date", name: str = "count_df") -> DataFrame:
    """A1: rows per reference date (partial counts per task, then merged)."""
    return df.groupBy(ref_col).agg(F.count(F.lit(1)).alias(name))


def raw_count(lines: DataFrame, day_format: str = "yyyy-MM-dd", ref_col: str = "ref_date",
              name: str = "count_raw", col: str = "value") -> DataFrame:
    """A2: non-blank physical lines per date, the date taken from the path."""
    return (non_blank_lines(lines, col)
            .groupBy(day_from_path(F.col(FILE_COL), day_format).alias(ref_col))
            .agg(F.count(F.lit(1)).alias(name)))


_DAY_ZERO = _dt.date(1970, 1, 1)
_NUMBER = "__day_number"


class DayCounts:
    """A1 and A2 taken in the pass that loads the rows, without a scan of their own.

    Each is one mergeable aggregate observed on the load's plan: a histogram
    of day numbers. ``histogram_numeric`` is exact as long as it has a bin
    for each different value, and the days of a load are known before it
    runs; a day that two tasks both have may come twice, and is summed.
    The counts are there after the action on the observed frame has ended.
    """

    def __init__(self, days: int):
        self.bins = 2 * days + 64      # room for bins that come twice, so that few merges are needed
        self._raw, self._parsed = Observation(), Observation()

    def _histogram(self, df: DataFrame, seen: Observation, day: Column, counted: Column | None = None) -> DataFrame:
        n = F.unix_date(day).cast("double")     # merged bins are averages, a hair beside the whole number
        # in a projection, which is compiled: what an observation works out itself is interpreted for each row
        df = df.withColumn(_NUMBER, F.when(counted, n) if counted is not None else n)
        return df.observe(seen, F.histogram_numeric(_NUMBER, F.lit(self.bins)).alias("days")).drop(_NUMBER)

    def raw(self, lines: DataFrame, f: Feed, col: str = "value", day: Column | None = None) -> DataFrame:
        """``lines``, their non-blank ones counted by ``day``, or by the day in the file's path."""
        day = day_from_path(F.col(FILE_COL), f.file_day_format) if day is None else day
        return self._histogram(lines, self._raw, day, ~is_blank(F.col(col)))

    def parsed(self, df: DataFrame, ref_col: str) -> DataFrame:
        """``df``, its rows counted by reference date."""
        return self._histogram(df, self._parsed, F.col(ref_col))

    @staticmethod
    def _by_day(seen: Observation) -> dict[_dt.date, int]:
        out: dict[_dt.date, int] = {}
        for b in seen.get["days"] or ():
            d = _DAY_ZERO + _dt.timedelta(days=round(b["x"]))
            out[d] = out.get(d, 0) + round(b["y"])
        return out

    def raw_days(self) -> dict[_dt.date, int]:
        return self._by_day(self._raw)

    def parsed_days(self) -> dict[_dt.date, int]:
        return self._by_day(self._parsed)


def reconcile(parsed: DataFrame, raw: DataFrame, ref_col: str = "ref_date") -> DataFrame:
    """Per date, parsed rows beside raw lines, and whether they agree.

    Both inputs hold one row per date, so the full outer join moves only
    a handful of rows whatever the data size.
    """
    j = parsed.join(raw, ref_col, "full_outer")
    cdf = F.coalesce(F.col("count_df"), F.lit(0)).cast("bigint")
    craw = F.coalesce(F.col("count_raw"), F.lit(0)).cast("bigint")
    return (j.select(ref_col, cdf.alias("count_df"), craw.alias("count_raw"),
                     (cdf == craw).alias("matched"))
            .orderBy(ref_col))
