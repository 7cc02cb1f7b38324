"""Log envelope parsing (SC-2, SC-3) and the per-record error column.

A record is bad when its text is not a JSON object, or when ``collectTime`` is
missing, not a number or no time that can be expressed (say, nanoseconds). The
error is a short reason text; rules later add their own reasons (FM-9). Of equal
keys in one object the last counts. A ``flatMap`` that is no object is no
payload: malformed for the known types, no error for unknown ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditpulse.functions.numbers import opt_long
from creditpulse.functions.timefn import TWO_MINUTES_MS, bucket_end, day_of, in_range
from creditpulse.operators.catalogue import LOG_TYPES

_ENVELOPE = "logNo STRING, collectTime STRING, flatMap {}, _corrupt_record STRING"
_HEAD_SCHEMA = "logNo STRING, collectTime STRING, _corrupt_record STRING"
_PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def _last_of_equal(payload: Column) -> Column:
    """The parser keeps every entry of an object in order, and a lookup finds the
    first of equal keys: where there are any, only the last of each is kept."""
    keys, entries = F.map_keys(payload), F.reverse(F.map_entries(payload))
    once = F.array_distinct(F.reverse(keys))
    last = F.map_from_arrays(once, F.transform(once, lambda k: F.filter(entries, lambda e: e["key"] == k)[0]["value"]))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), last).otherwise(payload)


def parse_envelope(
    logs: DataFrame,
    value_col: str = "value",
    tz: str = "UTC",
    width_ms: int = TWO_MINUTES_MS,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``log_no, collect_ms, p (payload map), day, bucket, env_err``.

    With ``fields``, ``p`` is a struct of these texts only: the parser puts each
    value in its place (the last of equal keys stays) and skips all others.

    All other input columns are kept; ``value`` stays as the raw text so a
    bad record can be written to the dead letters unchanged.
    """
    shape = "MAP<STRING,STRING>" if fields is None else "STRUCT<" + ", ".join(f"`{f}`: STRING" for f in fields) + ">"
    env = F.from_json(F.col(value_col), _ENVELOPE.format(shape), _PARSE_OPTIONS)
    # The parse goes through a generator: Catalyst never copies a later
    # filter (on kind, time or error) below a Generate, so one use of the
    # result parses each record once. A text that is no envelope, maybe because
    # of its payload alone, is parsed again without it, by a second one.
    parsed = logs.select(*logs.columns, F.inline_outer(F.array(env)))
    corrupt = F.col("_corrupt_record").isNotNull()
    head = F.from_json(F.col(value_col), _HEAD_SCHEMA, _PARSE_OPTIONS)
    parsed = parsed.select("*", F.inline_outer(F.when(corrupt, F.array(head))).alias("_log_no", "_time", "_no_head"))
    payload_map = F.col("flatMap") if fields is not None else _last_of_equal(F.col("flatMap"))
    parsed = parsed.select(
        *logs.columns, F.when(corrupt, F.col("_log_no")).otherwise(F.col("logNo")).alias("logNo"),
        F.when(corrupt, F.col("_time")).otherwise(F.col("collectTime")).alias("collectTime"),
        F.when(~corrupt, payload_map).alias("flatMap"),
        (F.col("_no_head").isNotNull() | (corrupt & F.col("_log_no").isin(*LOG_TYPES))).alias("_malformed"))
    given_ms = opt_long(F.col("collectTime"))
    # Only a time in range reaches a time function: none of them may raise.
    collect_ms = F.when(in_range(given_ms), given_ms)
    env_err = (
        F.when(F.col(value_col).isNull(), F.lit("empty record"))
        .when(F.col("_malformed"), F.lit("malformed json"))
        .when(given_ms.isNull(), F.lit("missing or bad collectTime"))
        .when(collect_ms.isNull(), F.lit("collectTime out of range"))
    )
    return parsed.select(
        *[c for c in logs.columns],
        F.col("logNo").alias("log_no"),
        collect_ms.alias("collect_ms"),
        F.col("flatMap").alias("p"),
        day_of(collect_ms, tz).alias("day"),
        bucket_end(collect_ms, width_ms).alias("bucket"),
        env_err.alias("env_err"),
    )


def payload(name: str, p: str = "p") -> Column:
    """A payload field as text (null when missing)."""
    return F.col(p).getItem(name)
