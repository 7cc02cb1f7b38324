"""Size-rolled CSV export (SNK-4).

The reference rolls to a new numbered file once a file has reached a byte limit
(500 MB by default) and refuses an existing directory. Here every task encodes
its rows as CSV lines and numbers its files by a running sum of their bytes; the
number is a partition of the output, so each file is written by one task, in one
run of the export.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_FILE_MB = 500


def file_numbers(sizes: np.ndarray, limit: int, number: int, used: int) -> tuple[np.ndarray, int, int]:
    """The file of each row of ``sizes`` bytes, when ``used`` bytes are in file
    ``number`` already, and where that leaves off. A file that has reached
    ``limit`` takes no more rows."""
    out, ends, at = np.empty(len(sizes), np.int64), np.cumsum(sizes), 0
    before = 0  # bytes of the rows before ``at``
    while at < len(sizes):
        if used >= limit:
            number, used = number + 1, 0
        stop = min(len(sizes), int(np.searchsorted(ends, before + limit - used)) + 1)
        out[at:stop] = number
        used += int(ends[stop - 1]) - before
        at, before = stop, int(ends[stop - 1])
    return out, number, used


def write_csv(df: DataFrame, path: str, file_mb: float = DEFAULT_FILE_MB, null_value: str = "") -> None:
    """Write quoted CSV below ``path``, which must not exist: a folder
    ``file=<task>-<number>`` with one file in it for every ``file_mb`` of a task's
    lines. A file is at most its last line larger than that."""
    limit = max(1, int(file_mb * 1024 * 1024))
    line = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"nullValue": null_value, "quoteAll": "false", "escape": '"'})

    def run(batches):
        task, number, used = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            files, number, used = file_numbers(batch.column(1).to_numpy(), limit, number, used)
            yield pa.record_batch([batch.column(0), pa.array([f"{task:06d}-{n:06d}" for n in files.tolist()])], names=["line", "file"])

    lines = df.select(line.alias("line")).withColumn("bytes", (F.octet_length("line") + 1).cast("long"))
    lines.mapInArrow(run, "line string, file string").write.mode("errorifexists").partitionBy("file").text(path)


def read_csv(spark: SparkSession, path: str, columns, null_value: str = "") -> DataFrame:
    """What :func:`write_csv` wrote, all columns as text."""
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    reader = spark.read.schema(schema).option("nullValue", null_value).option("escape", '"').option("recursiveFileLookup", True)
    return reader.csv(path)
