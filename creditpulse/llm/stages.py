"""Stages of the corpus pipeline, each a thin use of one operator.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the
columns of ``documents``, whatever else their input holds.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from creditpulse.llm.common import with_row_id
from creditpulse.llm.mixing import Mixture, copies
from creditpulse.llm.quality_rules import cleaned
from creditpulse.llm.secret_scans import redacted
from creditpulse.llm.sentencepiece_codec import encode
from creditpulse.llm.simhash_dedup import near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PIECES = "piece_bpe_32k.model"


def quality_stage(spark, docs, sf_dir):
    """The documents that the quality rules keep, without frequent lines and ``n_chars`` of changed texts set anew."""
    return cleaned(docs, COLUMNS)


def simhash_stage(spark, docs, sf_dir):
    """One document of each group of near-duplicates: the one with the smallest id."""
    docs = with_row_id(docs, "row_id")
    kept = near_duplicates(docs, row_col="row_id").where("kept").select("row_id")
    return docs.join(kept, "row_id", "left_semi").select(*COLUMNS)


def secrets_stage(spark, docs, sf_dir):
    """All documents, every secret in their texts replaced by a mark and ``n_chars`` set anew."""
    return redacted(docs, COLUMNS)


def mixing_stage(spark, docs, sf_dir):
    """Whole documents, each as often as the mix takes its words (rounded at
    random by its id's hash): sources near their targets, repeats as rows."""
    docs = with_row_id(docs, "row_id").select("row_id", *COLUMNS)
    times = copies(Mixture(docs, row_col="row_id").documents).where("copies > 0")
    return (docs.join(times, "row_id").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*COLUMNS))


def encoding_stage(spark, docs, sf_dir):
    """Token ids of every document, with its other columns in place of the text."""
    return encode(docs, public_tokenizers.path(PIECES), keep=["doc_id", "lang", "source", "n_chars"])


STAGES = [("quality", quality_stage), ("simhash", simhash_stage), ("secrets", secrets_stage),
          ("mixing", mixing_stage), ("encoding", encoding_stage)]
