"""Corpus pipeline: quality rules, near-dedup, secret redaction, mixing, encoding.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame, which is written as Parquet and reread as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from creditpulse.llm.common import cut, table
from creditpulse.llm.stages import STAGES

ORACLE_SQL = None  # SimHash and the tokenizer are beyond SQL; tests hold it against brute force


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
