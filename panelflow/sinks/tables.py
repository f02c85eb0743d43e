"""K1 append, K2 replace, K3 append new keys, K4 per-date replace, K6 update."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelflow.operators.keys import new_keys
from panelflow.session import staging_path
from panelflow.sinks.paths import delete, exists, folders, partition_columns, swap

# JDBC write defaults: several connections, batched inserts.
JDBC_WRITE = {"numPartitions": "8", "batchsize": "10000"}


def _jdbc_opts(jdbc: Mapping) -> dict:
    o = dict(JDBC_WRITE)
    o.update(jdbc)
    return o


def append_table(df: DataFrame, target: str | None = None, *, fmt: str = "parquet",
                 jdbc: Mapping | None = None, partition_by: list[str] | None = None) -> None:
    """K1: append rows to a lake path or a JDBC table (``dbtable`` in ``jdbc``).

    JDBC appends match columns by name; ``numPartitions`` bounds the
    number of concurrent connections.
    """
    if jdbc is not None:
        df.write.format("jdbc").options(**_jdbc_opts(jdbc)).mode("append").save()
        return
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(target)


def _beside(target: str) -> str:
    """A fresh folder beside ``target``, so that a swap is a rename in one filesystem."""
    return f"{target.rstrip('/')}.new-{uuid.uuid4().hex}"


def replace_table(df: DataFrame, target: str | None = None, *, fmt: str = "parquet",
                  jdbc: Mapping | None = None, spark: SparkSession | None = None,
                  partition_by: list[str] | None = None) -> None:
    """K2: full refresh.

    JDBC: ``overwrite`` with ``truncate`` keeps the table definition and
    is one transaction per partition. Lake path: the new version is written
    once, beside the table, and renamed into its place; the old table stays
    readable until then, whatever fails, and no staged copy is left. ``df``
    may read the target itself. A table keeps its partitioning unless
    ``partition_by`` says otherwise.
    """
    if jdbc is not None:
        (df.write.format("jdbc").options(**_jdbc_opts(jdbc)).option("truncate", "true")
         .mode("overwrite").save())
        return
    spark = spark or df.sparkSession
    cols = partition_columns(spark, target) if partition_by is None else partition_by
    new = _beside(target)
    try:
        w = df.write.format(fmt)
        (w.partitionBy(*cols) if cols else w).save(new)
        swap(spark, new, target)
    except BaseException:
        delete(spark, new)
        raise


def append_new(src: DataFrame, target: str | None, key: str, *, fmt: str = "parquet",
               spark: SparkSession | None = None, jdbc: Mapping | None = None) -> None:
    """K3: append the source rows whose key the target lacks (J1, ``NOT IN``);
    rows already in the target never change. Columns are written in the
    target's order. A target path that does not exist yet is created from
    all source rows; a table that cannot be read is an error."""
    spark = spark or src.sparkSession
    if jdbc is not None:
        tgt = spark.read.format("jdbc").options(**jdbc).load()
        append_table(new_keys(src, tgt, key).select(*tgt.columns), jdbc=jdbc)
        return
    if not exists(spark, target):   # no table yet: NOT IN an empty set keeps every row
        src.write.format(fmt).save(target)
        return
    tgt = spark.read.format(fmt).load(target)
    new = new_keys(src, tgt, key).select(*tgt.columns)
    # computed from the target's listing taken now; the append adds files
    new.write.mode("append").format(fmt).save(target)


def load_dates(df: DataFrame, target: str, ref_col: str, *, fmt: str = "parquet",
               days: Iterable | None = None) -> None:
    """K4: write the dates present in ``df``, replacing only those dates.

    Dynamic partition overwrite: a re-run of a day replaces it instead of
    appending it again. Each input file belongs to one day, so each task
    writes one partition folder and no shuffle is needed. ``days`` are the
    days asked for: one that ``df`` has no row of is cleared.
    """
    spark = df.sparkSession
    days = [str(d) for d in days or ()]
    seen = Observation()
    if days:   # the days that got rows are counted in the same pass
        df = df.observe(seen, F.array_join(F.collect_set(F.col(ref_col).cast("string")), ",").alias("days"))
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(ref_col).format(fmt).save(target))
    for d in sorted(set(days) - set((seen.get["days"] or "").split(","))) if days else ():
        delete(spark, f"{target.rstrip('/')}/{ref_col}={d}")


def update_where(df: DataFrame, cond: Column, values: Mapping[str, object]) -> DataFrame:
    """K6 as a projection: ``UPDATE … SET col = value WHERE cond``."""
    sets = {k: (v if isinstance(v, Column) else F.lit(v)) for k, v in values.items()}
    return df.select(*[
        F.when(cond, sets[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in sets else F.col(c) for c in df.columns])


def update_table(spark: SparkSession, target: str | None, cond: Column, values: Mapping[str, object],
                 *, fmt: str = "parquet", jdbc: Mapping | None = None) -> None:
    """K6 on a table.

    A partitioned lake table keeps its folders, and only those that hold a
    matching row are written again; any other table is rewritten and
    swapped in (K2). A JDBC table is read, staged and replaced.
    """
    if jdbc is not None:
        stage = staging_path(spark, "update")
        update_where(spark.read.format("jdbc").options(**jdbc).load(), cond, values).write.parquet(stage)
        replace_table(spark.read.parquet(stage), jdbc=jdbc)
        delete(spark, stage)
        return
    cols = partition_columns(spark, target)
    df = spark.read.format(fmt).load(target)
    if not cols or set(cols) & set(values):   # a new partition value moves rows between folders
        replace_table(update_where(df, cond, values), target, fmt=fmt, spark=spark)
        return
    touched = df.filter(cond).select(*cols).distinct()
    same = [df[c].eqNullSafe(touched[c]) for c in cols]
    stage = staging_path(spark, "update")
    try:
        update_where(df.join(touched, reduce(Column.__and__, same), "left_semi"), cond, values).write.partitionBy(*cols).format(fmt).save(stage)
        if folders(spark, stage):
            (spark.read.format(fmt).schema(df.schema).load(stage).select(*df.columns).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*cols).format(fmt).save(target))
    finally:
        delete(spark, stage)
