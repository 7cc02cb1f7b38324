"""Live metrics job, batch form: logs -> parsed -> good/bad -> deltas -> sums.

The stream form (``creditpulse.streaming``) runs the same functions per
micro-batch. The only shuffle is the final aggregation on
``(metric, field, day)``; its key space is small (days x families x fields)
and partial aggregation collapses every task's rows before the exchange, so
a hot metric or day costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpulse.functions.envelope import parse_envelope
from creditpulse.functions.text import is_blank
from creditpulse.functions.envelope import payload
from creditpulse.operators import catalogue as cat
from creditpulse.operators.asof import asof_type
from creditpulse.operators.rules import (
    PAYLOAD_FIELDS,
    classify,
    customer_label,
    explode_deltas,
    loan_amount,
    outputs,
    split_errors,
)
from creditpulse.operators.catalogue import TASK_NAME
from creditpulse.operators.rollup import sum_deltas
from creditpulse.session import materialised
from creditpulse.sinks.counters import add_deltas
from creditpulse.sinks.deadletters import write_dead_letters

HUGE_METHOD = 8000  # bytes; HotSpot leaves longer methods to its interpreter


def classified(logs: DataFrame, tz: str = "UTC", kinds=None) -> DataFrame:
    """Parse and classify raw ``key, value`` logs (one row per record). The rules'
    generated method is longer than what the JVM compiles, in any session: under
    this limit Spark splits it by operator."""
    logs.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)
    return classify(parse_envelope(logs, tz=tz, fields=PAYLOAD_FIELDS), kinds=kinds)


def output_rows(logs: DataFrame, tz: str = "UTC", kinds=None) -> DataFrame:
    """Delta rows of good records plus one row per bad record."""
    return outputs(classified(logs, tz, kinds))


def slim(recs: DataFrame) -> DataFrame:
    """What the outputs need of classified records, without payload: the raw
    text of bad records only, the deltas, and ``ev``, the record's row in JN-1
    (a good risk record that touches an order's type or a good loan that reads
    it, else null). Written once, it serves every consumer with one parse."""
    kind = F.col("kind")
    is_loan = kind == "loan"
    order = F.when(is_loan, payload("orderId")).when(kind == "risk", payload("ORDER_ID"))
    takes_part = F.col("err").isNull() & ~is_blank(order) & (is_loan | ~is_blank(payload("Z_RESERVED_CHAR5")))
    ev = F.when(takes_part, F.struct(
        order.alias("order_id"), is_loan.alias("is_loan"),
        F.when(~is_loan, customer_label(payload("Z_RESERVED_CHAR5"))).alias("type"),
        F.when(is_loan, loan_amount()).alias("amount")))
    return recs.select(
        "key", F.when(F.col("err").isNotNull(), F.col("value")).alias("value"), "kind", "day", "collect_ms", "out", ev.alias("ev"))


def type_rows(slim_recs: DataFrame) -> DataFrame:
    """JN-1 input: ``order_id, ts, is_loan, type, rec_id, day, amount``."""
    return slim_recs.where(F.col("ev").isNotNull()).select(
        "ev.order_id", F.col("collect_ms").alias("ts"), "ev.is_loan", "ev.type", F.col("key").alias("rec_id"), "day", "ev.amount")


def type_events(logs: DataFrame, tz: str = "UTC") -> DataFrame:
    """JN-1 input from raw logs, materialised (the as-of scan reads it twice)."""
    return materialised(type_rows(slim(classified(logs, tz, kinds=["risk", "loan"]))), "type-events")


def typed_deltas(typed: DataFrame) -> DataFrame:
    """Typed loans -> ``<type>.amount`` deltas (FM-2 customer part)."""
    return typed.select(
        F.lit("RISK_CUSTOMER_DISTRIBUTION").alias("metric"), F.concat(F.col("type"), F.lit(".amount")).alias("field"),
        "day", F.col("amount").alias("value"), F.col("ts").alias("collect_ms"))


def known_deltas(recs: DataFrame) -> DataFrame:
    """``metric, field, day, value, collect_ms`` of good records, known families only."""
    good, _ = split_errors(outputs(recs))
    return good.where(F.col("metric").isin(cat.METRICS)).select("metric", "field", "day", "value", "collect_ms")


def all_deltas(logs: DataFrame, tz: str = "UTC") -> DataFrame:
    """Every delta of every kind, customer types included, from one parse."""
    recs = materialised(slim(classified(logs, tz)), "records")
    return known_deltas(recs).unionByName(typed_deltas(asof_type(type_rows(recs))))


def loan_type_deltas(logs: DataFrame, tz: str = "UTC", ttl_ms: int | None = None) -> DataFrame:
    """FM-2 customer part: ``<type>.amount`` for loans whose order has a live type."""
    kw = {} if ttl_ms is None else {"ttl_ms": ttl_ms}
    return typed_deltas(asof_type(type_events(logs, tz), **kw)).drop("collect_ms")


def metric_deltas(logs: DataFrame, tz: str = "UTC", kinds=None, with_types: bool = True) -> DataFrame:
    """All known deltas of the good records (not yet summed)."""
    if with_types and kinds is None:
        return all_deltas(logs, tz).drop("collect_ms")
    good, _ = split_errors(output_rows(logs, tz, kinds))
    deltas = cat.known_only(explode_deltas(good))
    if with_types and (kinds is None or ("loan" in kinds and "risk" in kinds)):
        deltas = deltas.unionByName(loan_type_deltas(logs, tz))
    return deltas


def metric_totals(logs: DataFrame, tz: str = "UTC", kinds=None, metrics=None, with_types: bool = True) -> DataFrame:
    """Summed counters ``metric, field, day, value`` (AG-1)."""
    deltas = metric_deltas(logs, tz, kinds, with_types)
    if metrics is not None:
        deltas = deltas.where(F.col("metric").isin(list(metrics)))
    return sum_deltas(deltas)


def run_batch(logs: DataFrame, counters_root: str, dead_letter_path: str, batch_id: int,
              tz: str = "UTC", namespace: str = "", task_name: str = TASK_NAME) -> None:
    """Job 1 over a bounded set of logs, with both outputs from one parse.

    The classified records, without payload, are written once to the shared
    folder and feed the counters, the customer-type as-of join and the dead
    letters. Counters are added as batch ``batch_id`` (idempotent), dead
    letters overwrite their batch directory.
    """
    recs = materialised(slim(classified(logs, tz)), "records")
    add_deltas(known_deltas(recs).unionByName(typed_deltas(asof_type(type_rows(recs)))), counters_root, batch_id, namespace)
    write_dead_letters(dead_rows(recs, task_name), dead_letter_path, batch_id=batch_id)


def dead_rows(recs: DataFrame, task_name: str = TASK_NAME) -> DataFrame:
    """SNK-3 rows of classified records: write time, task name, reason, raw text, key."""
    _, bad = split_errors(outputs(recs))
    return bad.select(F.current_timestamp().alias("collect_time"), F.lit(task_name).alias("task_name"),
                      F.col("err").alias("exception_info"), "json", F.col("key").alias("record_key"))
