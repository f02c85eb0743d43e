"""SQL text to a DataFrame or to a few rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession


def query_df(spark: SparkSession, sql: str, args: dict | None = None,
             jdbc: dict | None = None) -> DataFrame:
    """Run SQL over registered views (bound ``:name`` parameters, no
    string splicing), or push the whole query to a JDBC source."""
    if jdbc is not None:
        if args:
            raise ValueError("bound parameters are not supported for JDBC push-down")
        return spark.read.format("jdbc").options(**jdbc).option("query", sql).load()
    return spark.sql(sql, args=args or None)


def query_rows(spark: SparkSession, sql: str, args: dict | None = None,
               jdbc: dict | None = None) -> Iterator[Row]:
    """A control result as rows, one after another.

    The caller iterates: one partition's rows are on the driver at a time,
    whatever the size of the result.
    """
    return query_df(spark, sql, args, jdbc).toLocalIterator()
