"""The different keys of a table, kept beside it in buckets.

The daily ``NOT IN`` compares a new snapshot with every key a table has
ever held. The index holds each key once, hashed into a fixed number of
buckets by Spark's own bucketing, so the join exchanges the snapshot alone:
the keys are read bucket by bucket, where they lie. The index names the
state of the table it was made from (its files, as one number); where that
is not the table's state now, after a failure between the two writes or an
append by someone else, it is made anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.operators.keys import new_keys
from panelflow.session import staging_path
from panelflow.sinks.paths import delete, exists, qualified
from panelflow.sources.files import list_files

_STATE = "files bigint, bytes bigint, names bigint, key string, buckets int"


class KeyIndex:
    """The keys of the table at ``target``, in ``buckets`` below ``path``.

    ``buckets`` should be no less than ``spark.sql.shuffle.partitions``, or
    Spark deals both sides anew. One writer at a time, as for the table.
    """

    def __init__(self, spark: SparkSession, path: str, target: str, key: str, buckets: int | None = None):
        self.spark, self.path, self.target, self.key = spark, path.rstrip("/"), target.rstrip("/"), key
        self.buckets = buckets or self._kept_buckets() or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def _kept(self):
        folder = f"{self.path}/_state"
        return self.spark.read.schema(_STATE).parquet(folder).first() if exists(self.spark, folder) else None

    def _kept_buckets(self) -> int | None:
        kept = self._kept()
        return kept.buckets if kept else None

    def _now(self) -> tuple:
        """The table's files: how many, how large, and the sum of their names' hashes."""
        root = qualified(self.spark, self.target)
        below = F.substring(F.regexp_replace("path", r"^file:/+", "file:/"), len(root) + 1, 1 << 30)
        r = (list_files(self.spark, self.target).filter(~F.col("file_name").rlike("^[._]"))
             .agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                  F.coalesce(F.sum(F.shiftright(F.xxhash64(below), 24)), F.lit(0)).alias("names")).first())
        return (r.files, r.bytes, r.names, self.key, self.buckets)

    def _table(self) -> str:
        """The index as a bucketed table of this session's catalog; its files are its own, so dropping it leaves them."""
        name = "panelflow_keys_" + uuid.uuid5(uuid.NAMESPACE_URL, f"{qualified(self.spark, self.path)}:{self.buckets}").hex
        kind = self.spark.read.parquet(self.target).schema[self.key].dataType.simpleString()
        where = f"{qualified(self.spark, self.path)}/keys".replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (`{self.key}` {kind}) USING parquet "
                       f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{where}'")
        self.spark.catalog.refreshTable(name)
        return name

    def _write(self, keys: DataFrame, mode: str) -> None:
        name = self._table()
        # one file a bucket and write; equal keys meet in one task, after a partial distinct
        (keys.select(self.key).distinct().repartition(self.buckets, self.key).write.mode(mode).format("parquet")
         .option("path", f"{qualified(self.spark, self.path)}/keys").bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(name))

    def _mark(self) -> None:
        delete(self.spark, f"{self.path}/_state")
        self.spark.createDataFrame([self._now()], _STATE).coalesce(1).write.parquet(f"{self.path}/_state")

    def valid(self) -> bool:
        """Does the index stand for the table as it is now?"""
        kept = self._kept()
        return kept is not None and tuple(kept) == self._now()

    def rebuild(self) -> None:
        """Make the index from the table: one pass over its key column."""
        delete(self.spark, f"{self.path}/_state")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table()}")
        delete(self.spark, f"{self.path}/keys")
        self._write(self.spark.read.parquet(self.target), "append")
        self._mark()

    def keys(self) -> DataFrame:
        """Every key of the table once, NULL if it holds one; read by buckets."""
        return self.spark.table(self._table())

    def new(self, src: DataFrame) -> DataFrame:
        """J1 against the index: rows of ``src`` whose key is ``NOT IN`` the table's keys."""
        return new_keys(src, self.keys(), self.key)

    def append_new(self, src: DataFrame) -> None:
        """K3: append the rows of ``src`` whose key the table lacks, and their keys to the index.

        The table must exist. The new rows are staged, so that table and
        index get the same ones; the state is written last, so a failure
        before it costs a rebuild, never a wrong answer.
        """
        if not self.valid():
            self.rebuild()
        stage = staging_path(self.spark, "new-keys")
        try:
            columns = self.spark.read.parquet(self.target).columns
            self.new(src).select(*columns).write.parquet(stage)
            new = self.spark.read.parquet(stage)
            new.write.mode("append").parquet(self.target)
            self._write(new, "append")
            self._mark()
        finally:
            delete(self.spark, stage)
