"""Bounded reads of detail tables (SRC-3, SRC-4, SRC-5, FL-3).

Detail rows come from a JDBC table or a Parquet copy; either way the time
range is a plain comparison on the text time column, so Catalyst pushes it
to the source (``PushedFilters``) together with the column list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def in_range(df: DataFrame, ts_col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """FL-3: half-open ``[start, end)`` on a ``yyyy-MM-dd HH:mm:ss`` text column."""
    if start is not None:
        df = df.where(F.col(ts_col) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(ts_col) < F.lit(end))
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, columns, **options) -> DataFrame:
    """A detail table over JDBC; ``options`` are passed through (user,
    password, driver, fetchsize, partitionColumn/lowerBound/upperBound/
    numPartitions for a parallel read)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(*columns)


def read_parquet(spark: SparkSession, path: str, columns) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def read_detail(detail: DataFrame, ts_col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """SRC-3: the rows of a detail table in ``[start, end)``."""
    return in_range(detail, ts_col, start, end)


def read_daily_totals(detail: DataFrame, ts_col: str, amount_col: str, where=None) -> DataFrame:
    """SRC-4/SRC-5: ``COUNT(1), SUM(amount)`` by the date prefix of the
    time text; ``where`` is an optional extra predicate (Column)."""
    if where is not None:
        detail = detail.where(where)
    return detail.groupBy(F.substring(F.col(ts_col), 1, 10).alias("day")).agg(
        F.count(F.lit(1)).alias("count"), F.sum(F.col(amount_col)).cast("bigint").alias("amount")
    )
