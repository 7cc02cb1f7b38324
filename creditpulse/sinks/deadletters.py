"""Dead letters (SNK-3): write time, task name, reason and the raw record."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_dead_letters(bad: DataFrame, path: str | None = None, batch_id: int | None = None,
                       jdbc_url: str | None = None, table: str | None = None, **jdbc_options) -> None:
    """Append dead letters to Parquet (per batch directory, idempotent on
    retry, with the record's key if given) or to a JDBC table (``batchsize``
    etc. in ``jdbc_options``; at least once: a retried batch appends again)."""
    cols = ["collect_time", "task_name", "exception_info", "json"]
    out = bad.select(*cols, *(["record_key"] if jdbc_url is None and "record_key" in bad.columns else []))
    if jdbc_url is not None:
        writer = out.write.mode("append").format("jdbc").option("url", jdbc_url).option("dbtable", table)
        for k, v in jdbc_options.items():
            writer = writer.option(k, v)
        writer.save()
        return
    target = path if batch_id is None else f"{path}/batch_id={batch_id}"
    out.write.mode("overwrite" if batch_id is not None else "append").parquet(target)
