"""J1 new keys, X1 valid dates, O1 newest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_keys(src: DataFrame, target: DataFrame, key: str,
             target_key: str | None = None) -> DataFrame:
    """Rows of ``src`` whose key is ``NOT IN`` the target's keys.

    SQL ``NOT IN`` semantics, kept exactly: an empty target keeps every
    source row (NULL keys too); a target holding any NULL key keeps none;
    otherwise NULL source keys are dropped and duplicates all kept.

    Plan: one scalar aggregate over the target classifies it (empty /
    no NULL / has NULL), and a plain ``left_anti`` join against the
    *distinct* non-NULL target keys does the rest. The distinct runs a
    map-side partial aggregate, so a hot key is collapsed before the
    shuffle, and no null-aware broadcast of the whole target is needed.
    """
    tk = target.select(F.col(target_key or key).alias("__tk"))
    state = tk.agg(
        F.when(F.count(F.lit(1)) == 0, F.lit(0))
        .when(F.max(F.col("__tk").isNull()), F.lit(2))
        .otherwise(F.lit(1)).alias("s")).scalar()
    # the rule for each target state, picked with a single use of the
    # scalar so the target is aggregated once
    keep = F.array(F.lit(True), F.col(key).isNotNull(), F.lit(False))[state]
    keys = tk.filter(F.col("__tk").isNotNull()).distinct()
    return (src.filter(keep)
            .join(keys, F.col(key) == F.col("__tk"), "left_anti"))


def valid_dates(requested: DataFrame, empty: DataFrame, col: str = "d") -> DataFrame:
    """Distinct requested dates minus the empty ones, ascending.

    Both sides are made distinct first: the anti join that ``subtract``
    becomes then shuffles days, not rows, and a hot day is summed map-side.
    """
    return (requested.select(col).distinct().subtract(empty.select(col).distinct())
            .orderBy(col))


def newest(df: DataFrame, time_col: str, n: int = 10, *tie_cols: str) -> DataFrame:
    """O1: the ``n`` newest rows (top-k per partition, then merged)."""
    order = [F.col(time_col).desc()] + [F.col(c).desc() for c in tie_cols]
    return df.orderBy(*order).limit(n)
