"""Counter store (SNK-1, SNK-2, SNK-5, SNK-6, SM-7, SM-8, SM-9).

A Parquet table of increments, partitioned by ``writer`` and ``since``, the first
day of the row's period; a counter is ``namespace, metric, family, field, day``
(``field`` is empty for scalar counters) and its value the sum of its
increments. A period is a day; a table that is filled with the history of years
at once takes longer ones (``period_days``, the same in every call). A
micro-batch only appends, so its cost does not depend on what is stored. Every
row carries its batch; a batch that is run again leaves its rows a second time,
and :func:`read_counters` counts a writer's batch once. (A writer of ``running``
totals stores the latest total of a key instead; a store has at most one such
writer.)

Periods are replaced whole, by dynamic partition overwrite: :func:`restate_store`
puts recomputed counters in the place of a day's, :func:`fold` leaves one row a
counter for many batches. :func:`remove_expired` deletes the folders of periods
that are past their retention.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditpulse.functions.timefn import ms_to_ntz, prev_day
from creditpulse.operators.catalogue import family_of, metrics_of
from creditpulse.session import materialised

KEY = ["namespace", "metric", "field", "day", "since"]
SCHEMA = ("namespace string, metric string, family string, field string, value bigint, written_at timestamp_ntz, "
          "day string, batch bigint, running boolean, writer string, since string")
RETENTION_DAYS = 32
RESTATED = "restated"  # the writer of what a restatement put in place


def period(day: Column, period_days: int = 1) -> Column:
    """The first day of a day's period."""
    if period_days == 1:
        return day
    at = F.unix_date(F.try_to_date(day))
    return F.coalesce(F.date_from_unix_date(at - F.pmod(at, F.lit(period_days))).cast("string"), day)


def increments(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the table; none if nothing has been written yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def _once(rows: DataFrame) -> DataFrame:
    """One row a counter, writer and batch, however often the batch was run."""
    return rows.groupBy(*KEY, "writer", "batch").agg(
        F.max("value").alias("value"), F.max("written_at").alias("written_at"), F.max("running").alias("running"))


def _totals(once: DataFrame, *more: str) -> DataFrame:
    running = F.col("running")
    value = F.coalesce(F.sum(F.when(~running, F.col("value"))), F.lit(0)) + F.coalesce(
        F.max_by("value", F.when(running, F.col("batch"))), F.lit(0))
    # No text is aggregated (that would sort all rows): the family is the metric's.
    return once.groupBy(*KEY, *more).agg(
        value.cast("bigint").alias("value"), F.max("written_at").alias("written_at"),
        F.max("batch").alias("batch"), F.max("running").alias("running")).withColumn("family", family_of(F.col("metric")))


def read_counters(spark: SparkSession, root: str) -> DataFrame:
    """``namespace, metric, field, day, since, family, value, written_at`` of every counter."""
    return _totals(_once(increments(spark, root))).drop("batch", "running")


def _append(totals: DataFrame, root: str, writer: str, batch_id: int, namespace: str, written_at: Column | None, running: bool,
            period_days: int) -> None:
    rows = totals.select(
        F.lit(namespace).alias("namespace"), "metric", family_of(F.col("metric")).alias("family"), "field",
        F.col("value").cast("bigint").alias("value"),
        (F.current_timestamp().cast("timestamp_ntz") if written_at is None else written_at).alias("written_at"),
        "day", F.lit(batch_id).cast("bigint").alias("batch"), F.lit(running).alias("running"),
        period(F.col("day"), period_days).alias("since"))
    # A period's rows come from one task: one small file for a batch and period.
    # Writers may run at the same time: each has a folder of its own to commit to.
    rows.repartition("since").write.mode("append").partitionBy("since").parquet(f"{root}/writer={writer}")


def sums(deltas: DataFrame, clock_ms: str | None = None) -> DataFrame:
    """``metric, field, day, value`` of deltas, and the newest ``clock_ms``: deltas
    of the same counters, one a key."""
    newest = [F.max(clock_ms).alias(clock_ms)] if clock_ms else []
    return deltas.groupBy("metric", "field", "day").agg(F.sum("value").alias("value"), *newest)


def add_deltas(deltas: DataFrame, root: str, batch_id: int, namespace: str = "", written_at: Column | None = None,
               clock_ms: str | None = None, writer: str = "counts", period_days: int = 1) -> None:
    """SNK-1/SNK-2: add deltas to the stored counters as ``writer``'s batch
    ``batch_id``, which counts once however often it is written.

    The write time is ``written_at``, or the newest ``clock_ms`` (epoch millis)
    of the key's deltas, or now.
    """
    at = ms_to_ntz(F.col(clock_ms)) if clock_ms else written_at
    _append(sums(deltas, clock_ms), root, writer, batch_id, namespace, at, False, period_days)


def write_totals(totals: DataFrame, root: str, batch_id: int, namespace: str = "", written_at: Column | None = None,
                 writer: str = "totals", period_days: int = 1) -> None:
    """Store running totals (``metric, field, day, value``): a key's value is the
    one of its last batch. For streams in update mode, whose state holds the sums."""
    _append(totals, root, writer, batch_id, namespace, written_at, True, period_days)


def _replace(rows: DataFrame, root: str, writer: str) -> None:
    """Put ``rows`` in the place of all that ``writer`` holds on their periods."""
    columns = [c for c in SCHEMA.replace(",", "").split()[::2] if c != "writer"]
    (rows.select(*columns).repartition("since").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("since").parquet(f"{root}/writer={writer}"))


def _remove(spark: SparkSession, root: str, periods, writer: str = "*") -> None:
    """Delete the folders of periods."""
    for since in periods:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/writer={writer}/since={since}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in fs.globStatus(path) or []:
            fs.delete(found.getPath(), True)


def fold(spark: SparkSession, root: str, before_batch: int, writer: str = "counts") -> None:
    """One row a counter for all of a writer's batches before ``before_batch``,
    which must be committed. Only periods that hold several batches are rewritten,
    without what is there of ``before_batch``: to be called by the writer itself,
    before it writes that batch (again)."""
    own = increments(spark, root).where((F.col("writer") == F.lit(writer)) & (F.col("batch") < F.lit(before_batch)))
    many = own.groupBy("since").agg(F.min("batch").alias("a"), F.max("batch").alias("b")).where("a < b")
    periods = [r.since for r in many.select("since").collect()]  # of the calendar, not of the data's size
    if periods:
        _replace(materialised(_totals(_once(own.where(F.col("since").isin(periods)))), "folded"), root, writer)


def restate_store(recomputed: DataFrame, root: str, day: str, metrics, namespace: str = "", written_at: Column | None = None,
                  period_days: int = 1) -> None:
    """SM-8: replace the counters of ``metrics`` on ``day`` and the day before by
    the totals in ``recomputed``; what is not there is removed, all other
    counters stay. Each writer's partitions of the two days are rewritten whole
    without the metrics, so it can be run again, also after a run that was cut
    short. No writer of running totals may go on with these metrics and days."""
    spark = recomputed.sparkSession
    days = F.lit(day), prev_day(F.lit(day))
    listed = F.col("metric").isin(list(metrics)) & F.col("day").isin(*days)
    stored = increments(spark, root).where(F.col("since").isin(*(period(d, period_days) for d in days)))
    kept = _totals(_once(stored), "writer").where(~(listed & (F.col("namespace") == F.lit(namespace))))
    now = F.current_timestamp().cast("timestamp_ntz") if written_at is None else written_at
    fresh = recomputed.where(listed).select(
        F.lit(namespace).alias("namespace"), "metric", "field", "day", period(F.col("day"), period_days).alias("since"),
        family_of(F.col("metric")).alias("family"), F.col("value").cast("bigint").alias("value"), now.alias("written_at"),
        F.lit(0).cast("bigint").alias("batch"), F.lit(False).alias("running"), F.lit(RESTATED).alias("writer"))
    rows = materialised(kept.unionByName(fresh), "restated")
    pairs = lambda df: {(r.writer, r.since) for r in df.select("writer", "since").distinct().collect()}  # noqa: E731  two periods of each writer
    before, after = pairs(stored), pairs(rows)
    for writer in {w for w, _ in after}:
        _replace(rows.where(F.col("writer") == F.lit(writer)), root, writer)
    for writer, empty in before - after:
        _remove(spark, root, [empty], writer)


def remove_expired(spark: SparkSession, root: str, as_of, days: int = RETENTION_DAYS) -> list[str]:
    """SNK-5: delete the folders of the periods in which no counter was written
    within ``days`` of ``as_of``; returns their first days."""
    limit = F.timestamp_add("DAY", F.lit(-days), _clock(as_of))
    last = increments(spark, root).groupBy("since").agg(F.max("written_at").alias("last"))
    gone = [r.since for r in last.where(F.col("last") <= limit).select("since").collect()]
    _remove(spark, root, gone)
    return sorted(gone)


def _clock(as_of) -> Column:
    return F.to_timestamp_ntz(F.lit(as_of)) if isinstance(as_of, str) else as_of


def expire(counters: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """SNK-5: keep counters whose key was written within ``days`` of ``as_of``.

    One stored key holds all fields of a hash, so the last write is taken
    per ``(namespace, day, family)``. ``as_of`` is a Column or a
    ``yyyy-MM-dd HH:mm:ss`` text (wall clock, same clock as ``written_at``).
    """
    key = ["namespace", "day", "family"]
    limit = F.timestamp_add("DAY", F.lit(-days), _clock(as_of))
    alive = counters.groupBy(*key).agg(F.max("written_at").alias("_last")).where(F.col("_last") > limit).drop("_last")
    return counters.join(alive, key, "left_semi")


def put_pointers(pointers: DataFrame, root: str) -> None:
    """SM-7 + ST-3: add cut-over pointers (``source, cutover_ms``: the time from
    which a source is counted live) to the set. A source that has one keeps it;
    all new ones are one write."""
    spark = pointers.sparkSession
    new = pointers.groupBy("source").agg(F.min("cutover_ms").cast("bigint").alias("cutover_ms"))
    new = materialised(new.join(read_pointers(spark, root), "source", "left_anti"), "pointers")
    if not new.isEmpty():
        new.coalesce(1).write.mode("append").parquet(root)


def read_pointers(spark: SparkSession, root: str) -> DataFrame:
    """``source, cutover_ms`` of all pointers; none if there is no such folder yet."""
    schema = "source string, cutover_ms bigint"
    try:
        return spark.read.schema(schema).parquet(root).groupBy("source").agg(F.min("cutover_ms").alias("cutover_ms"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def lookup(counters: DataFrame, family: str, day: str | None = None, period_days: int = 1) -> DataFrame:
    """SNK-6: the fields of one counter family (optionally of one day). The
    filters on metric and day are on keys of the store: they reach the scan, the
    day's period as a partition filter."""
    out = counters.where(F.col("metric").isin(metrics_of(family))) if "metric" in counters.columns else counters
    out = out.where(F.col("family") == F.lit(family))
    if day is not None:
        out = out.where(F.col("day") == F.lit(day))
        if "since" in counters.columns:
            out = out.where(F.col("since") == period(F.lit(day), period_days))
    return out.select("day", "field", "value")


def lookup_map(counters: DataFrame, family: str, day: str | None = None) -> DataFrame:
    """SNK-6, hash form: one row per day with a ``field -> value`` map.

    The map of one hash counter is bounded by its field domain (buckets of
    a day, places, codes), never by the number of records.
    """
    rows = lookup(counters, family, day)
    return rows.groupBy("day").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("fields"))
