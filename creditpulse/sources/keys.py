"""Key-list file (SRC-6): one key per line; blank lines are skipped.

The reference stops at the first blank line; line order is not defined
across the splits of a distributed read, so every blank line is skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditpulse.functions.text import is_blank


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(~is_blank(F.col("value"))).select(F.col("value").alias("key"))
