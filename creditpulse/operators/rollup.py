"""Aggregations and set operations (AG-*, ST-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["metric", "field", "day"]


def sum_deltas(deltas: DataFrame, key=KEY) -> DataFrame:
    """AG-1: sum by key; Spark adds the map-side partial aggregation."""
    return deltas.groupBy(*key).agg(F.sum("value").cast("bigint").alias("value"))


def row_counts(df: DataFrame, *by) -> DataFrame:
    """AG-7: row counts per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("records"))


def union_all(parts) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
