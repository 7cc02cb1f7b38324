"""Helpers shared by the corpus operators.

Words are everywhere maximal runs of code points outside ``\\x20`` and
``\\x09-\\x0D``; ``bytes.split()`` without arguments splits on exactly these
bytes, and ``bytes.lower()`` lowers exactly ``A-Z``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditpulse.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHUNK_BYTES = 4 << 20
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows: texts may be long, and a
    batch is held whole by the JVM and by its Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared ``spark.checkpoint.dir`` and read it back:
    the plan starts anew from files that every executor can reach."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col):
    """Lower-case ``A-Z`` and nothing else."""
    return F.translate(col, UPPER, LOWER)


def byte_rows(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column's rows."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def chunks(sizes: list[int], limit: int = CHUNK_BYTES) -> Iterator[range]:
    """Consecutive row ranges of about ``limit`` bytes; a longer row is alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield range(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield range(start, len(sizes))


def with_row_id(docs: DataFrame, name: str) -> DataFrame:
    """Add the row's file and place in it: the same on every read, however the
    files are split. A frame that is no plain file scan is written first. A
    column that already has that name is replaced."""
    for frame in (docs, None):
        frame = cut(docs, "rows") if frame is None else frame
        try:
            meta = frame.metadataColumn("_metadata")
            return frame.withColumn(name, F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("at")))
        except AnalysisException:
            continue
    raise ValueError("no row number for this frame")


def numbered(docs: DataFrame, row_col: str | None) -> DataFrame:
    """``docs`` with a column ``__row``: the caller's own row numbers, or the places in files."""
    return docs.withColumn("__row", F.col(row_col)) if row_col else with_row_id(docs, "__row")
