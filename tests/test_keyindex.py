"""The bucketed key index against the plain anti join."""

import pytest

from panelflow.operators.keys import new_keys
from panelflow.sinks.keyindex import KeyIndex
from panelflow.sinks.tables import append_new


@pytest.fixture
def frozen(spark, tmp_path):
    t = str(tmp_path / "frozen table")
    spark.range(0, 3000, 3).selectExpr("id as k", "'old' as v").union(spark.sql("select 3L, 'twice'")).repartition(3).write.parquet(t)
    return t


def _src(spark, lo, hi, v):
    return spark.range(lo, hi).selectExpr("id as k", f"'{v}' as v").repartition(5)


def test_only_the_new_side_is_exchanged(spark, tmp_path, frozen):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = KeyIndex(spark, str(tmp_path / "it's an index"), frozen, "k", buckets=16)
        assert not index.valid()
        index.rebuild()
        assert index.valid() and index.keys().count() == 1000
        plan = index.new(_src(spark, 0, 100, "x"))._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("SortMergeJoin"):]
        assert join.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_daily_appends_equal_the_plain_ones(spark, tmp_path, frozen):
    plain = str(tmp_path / "plain")
    spark.read.parquet(frozen).write.parquet(plain)
    path = str(tmp_path / "index")
    for lo, hi, v in ((0, 10, "a"), (5, 50, "b"), (5, 50, "c"), (2990, 3010, "d")):
        src = _src(spark, lo, hi, v).union(spark.sql("select null, 'n'")).union(spark.sql(f"select {hi + 9000}L, 'x'")).union(spark.sql(f"select {hi + 9000}L, 'y'"))
        KeyIndex(spark, path, frozen, "k", buckets=4).append_new(src)       # each day another run
        append_new(src, plain, "k")
        index = KeyIndex(spark, path, frozen, "k")
        assert index.buckets == 4 and index.valid()
    rows = lambda t: sorted(map(str, spark.read.parquet(t).collect()))
    assert rows(frozen) == rows(plain)
    assert index.keys().count() == spark.read.parquet(frozen).select("k").distinct().count()


def test_an_index_that_fell_behind_is_made_anew(spark, tmp_path, frozen, monkeypatch):
    path = str(tmp_path / "index")
    KeyIndex(spark, path, frozen, "k", buckets=4).append_new(_src(spark, 1, 3, "a"))
    monkeypatch.setattr(KeyIndex, "_write", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):                                         # the table has the rows, the index does not
        KeyIndex(spark, path, frozen, "k").append_new(_src(spark, 3, 6, "b"))
    monkeypatch.undo()
    assert not KeyIndex(spark, path, frozen, "k").valid()
    KeyIndex(spark, path, frozen, "k").append_new(_src(spark, 0, 8, "c"))
    got = {r.k: r.v for r in spark.read.parquet(frozen).where("k < 8 and v <> 'twice'").collect()}
    assert got == {0: "old", 1: "a", 2: "a", 3: "old", 4: "b", 5: "b", 6: "old", 7: "c"}


def test_null_in_the_table_keeps_nothing_new(spark, tmp_path, frozen):
    spark.sql("select cast(null as bigint) as k, 'n' as v").write.mode("append").parquet(frozen)
    index = KeyIndex(spark, str(tmp_path / "index"), frozen, "k", buckets=4)
    index.rebuild()
    src = _src(spark, 0, 9000, "x")
    assert index.new(src).count() == 0 == new_keys(src, spark.read.parquet(frozen), "k").count()
