"""Plan shapes that matter at scale (read from ``explain``)."""

import datetime as dt

from pyspark.sql import functions as F

from panelflow.operators.control import latest_status
from panelflow.operators.keys import new_keys
from panelflow.operators.reconcile import parsed_count
from panelflow.queries import EVENTS, stage_events
from panelflow.sources.usage import read_usage
from tests.conftest import SF_SMALL
from tests.oracle import plan_text


def _before_exchange(plan: str, op: str) -> bool:
    """Is a hash exchange fed directly by an ``op`` (a map-side partial
    aggregate: ``partial_…`` functions, or none for a distinct)?"""
    lines = plan.splitlines()
    ex = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    return any(op in lines[i + 1] and ("partial_" in lines[i + 1] or "functions=[]" in lines[i + 1])
               for i in ex if i + 1 < len(lines))


def test_feed_read_and_stamp_do_not_shuffle(spark):
    df = read_usage(spark, stage_events(spark, SF_SMALL), EVENTS)
    assert "Exchange" not in plan_text(df)
    p = plan_text(parsed_count(df))
    assert _before_exchange(p, "HashAggregate")      # map-side partial counts


def test_hot_key_is_collapsed_before_shuffle(spark):
    # a third of all rows share one key on both sides
    src = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    tgt = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 5000).alias("t"))
    p = plan_text(new_keys(src, tgt, "k", "t"))
    assert _before_exchange(p, "HashAggregate")
    assert new_keys(src, tgt, "k", "t").count() == 1999   # hot 7s and the id-7 row drop out
    log = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias("task_id"), F.col("id").alias("log_id"),
                                   F.lit(1).alias("status"), F.lit(dt.datetime(2024, 1, 1)).alias("log_time"))
    p = plan_text(latest_status(log))
    assert _before_exchange(p, "Aggregate")


def test_a_load_counts_days_from_a_column_and_reads_a_path_once(spark, tmp_path):
    from panelflow.operators.reconcile import DayCounts
    from panelflow.plans.usage_load import _read
    from panelflow.schemas import Feed, _schema
    p = tmp_path / "s_2024-01-05.txt"
    p.write_text("a\t1\n\n \nb\t2\n", encoding="utf-16-le")
    counts = DayCounts(1)
    df, _ = _read(spark, [str(p)], Feed("s", _schema("a string, n int"), file_prefix="s_", encoding="UTF-16LE"), None, counts, True)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    observed = [ln for ln in plan.splitlines() if "CollectMetrics" in ln]
    assert len(observed) == 2 and not any("regexp_extract" in ln or "RLIKE" in ln for ln in observed)
    assert len([ln for ln in plan.splitlines() if "regexp_extract" in ln]) == 1
    assert sorted((r.a, r.n) for r in df.collect()) == [("a", 1), ("b", 2)]
    assert counts.raw_days() == counts.parsed_days() == {dt.date(2024, 1, 5): 2}
