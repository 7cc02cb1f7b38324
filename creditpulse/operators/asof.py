"""JN-1: loan ⋈ the latest customer type of its order, with an idle TTL.

Semantics (a key-value store with expiry, replayed in event time):

* a *touch* row (risk record with a type code and an order id) refreshes the
  order's expiry to ``ts + ttl``; when its code is known it also sets the
  type (creating the entry if it had expired);
* a touch with an unknown code on an expired entry does nothing;
* a loan row reads the type if the entry is alive at its time.

Equivalently, for a loan at position ``x`` (order by time, touch before
loan, then record id): let ``prev`` be the last touch before ``x``, a
*break* be a touch whose previous touch is missing or ``>= ttl`` earlier,
and ``set`` the last touch with a known type up to ``x``. The loan is typed
iff ``x.ts - prev.ts < ttl`` and ``set`` is at or after the last break.

All three quantities are prefix maxima, which makes the scan associative.
It runs in two levels so that no order — however hot — is processed by one
task: rows are windowed per ``(order, time chunk)``; each chunk is reduced
to a one-row summary; a window over the (small) summaries per order carries
state from earlier chunks; a join on ``(order, chunk)`` applies the carry.

A chunk is an hour. Hours in which an order has more than ``chunk_rows`` rows
are counted first and cut into ranges of position (time, then kind and record)
by row count, so a chunk stays below about twice that whatever the order does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditpulse.session import materialised

DEFAULT_TTL_MS = 5 * 86_400_000
DEFAULT_CHUNK_MS = 3_600_000
DEFAULT_CHUNK_ROWS = 500_000


def chunked(events: DataFrame, chunk_ms: int = DEFAULT_CHUNK_MS, chunk_rows: int = DEFAULT_CHUNK_ROWS,
            order_col: str = "order_id") -> DataFrame:
    """``events`` with their ``chunk``, a struct that sorts by time within an order:
    the hour, and for an hour with too many rows the range within it."""
    rows = events.withColumn("_hour", F.floor(F.col("ts") / F.lit(chunk_ms)).cast("bigint"))
    hour = [order_col, "_hour"]
    counts = rows.groupBy(*hour).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > F.lit(chunk_rows))
    hot_hours = materialised(counts, "hot-hours")  # at most one for every chunk_rows rows
    total = hot_hours.agg(F.sum("_rows")).first()[0]
    chunk = lambda part: F.struct("_hour", part.cast("int").alias("part"))
    if not total:
        return rows.withColumn("chunk", chunk(F.lit(0))).drop("_hour")
    hours = hot_hours.select(*hour)
    # Every range of the sorted rows is a part: a row's number breaks ties, so that
    # rows of one place can be cut too. Written, as the number must not change.
    hot = (rows.join(hours, hour, "left_semi").withColumn("_row", F.monotonically_increasing_id())
           .repartitionByRange(-(-total // chunk_rows), *hour, "ts", "is_loan", "rec_id", "_row").drop("_row")
           .withColumn("chunk", chunk(F.spark_partition_id())))
    hot = materialised(hot, "hot-rows")
    return rows.join(hours, hour, "left_anti").withColumn("chunk", chunk(F.lit(0))).unionByName(hot).drop("_hour")


def asof_type(
    events: DataFrame,
    ttl_ms: int = DEFAULT_TTL_MS,
    chunk_ms: int = DEFAULT_CHUNK_MS,
    order_col: str = "order_id",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Typed loans.

    ``events`` columns: ``order_id, ts (epoch ms), is_loan, type (label of a
    touch, null for an unknown code or a loan), rec_id`` plus any payload
    columns for loans (kept). Returns the loan rows that have a live type,
    with a ``type`` column.
    """
    o = F.col(order_col)
    ts = F.col("ts")
    is_loan = F.col("is_loan")
    is_touch = ~is_loan
    pos = F.struct(ts.alias("t"), is_loan.cast("int").alias("r"), F.col("rec_id").alias("id"))
    ttl = F.lit(ttl_ms).cast("bigint")

    rows = chunked(events, chunk_ms, chunk_rows, order_col).withColumn("pos", pos)
    local = Window.partitionBy(order_col, "chunk").orderBy("pos")
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    rows = rows.withColumn("l_prev", F.max(F.when(is_touch, ts)).over(before))
    local_break = is_touch & F.col("l_prev").isNotNull() & (ts - F.col("l_prev") >= ttl)
    set_at = F.when(is_touch & F.col("type").isNotNull(), F.struct(F.col("pos").alias("p"), F.col("type").alias("type")))
    rows = rows.withColumn("l_break_here", local_break).select(
        "*",
        F.max(F.when(F.col("l_break_here"), F.col("pos"))).over(upto).alias("l_break"),
        F.max(set_at).over(upto).alias("l_set"),
    )

    # One row per (order, chunk); the window above already partitions rows
    # this way, so this aggregation adds no exchange of the row data.
    summary = rows.groupBy(order_col, "chunk").agg(
        F.max(F.when(is_touch, ts)).alias("s_last_touch"),
        F.min(F.when(is_touch, F.col("pos"))).alias("s_first_pos"),
        F.max(F.when(F.col("l_break_here"), F.col("pos"))).alias("s_local_break"),
        F.max(set_at).alias("s_set"),
    )
    chunks = Window.partitionBy(order_col).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("c_touch", F.max("s_last_touch").over(chunks))
    first_break = F.col("s_first_pos").isNotNull() & (
        F.col("c_touch").isNull() | (F.col("s_first_pos.t") - F.col("c_touch") >= ttl)
    )
    summary = (
        summary.withColumn("first_break", F.when(first_break, F.col("s_first_pos")))
        .withColumn("s_break", F.greatest("s_local_break", "first_break"))
        .withColumn("c_break", F.max("s_break").over(chunks))
        .withColumn("c_set", F.max("s_set").over(chunks))
        .select(order_col, "chunk", "c_touch", "first_break", "c_break", "c_set")
    )

    loans = rows.where(is_loan).join(summary, [order_col, "chunk"])
    prev = F.coalesce(F.col("l_prev"), F.col("c_touch"))
    first_before = F.when(F.col("first_break") < F.col("pos"), F.col("first_break"))
    last_break = F.greatest(F.col("l_break"), first_before, F.col("c_break"))
    last_set = F.greatest(F.col("l_set"), F.col("c_set"))
    alive = (
        prev.isNotNull()
        & (ts - prev < ttl)
        & last_set.isNotNull()
        & (last_break.isNull() | (last_set.getField("p") >= last_break))
    )
    keep = [c for c in events.columns if c != "type"]
    return loans.where(alive).select(*keep, last_set.getField("type").alias("type"))
