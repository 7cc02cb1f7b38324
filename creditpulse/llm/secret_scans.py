"""Secret scans with an incremental blob ledger.

Method: every version of every path is addressed by its content (SHA-256). A
ledger table records which ``(blob, rule version)`` pairs were scanned and what
was found; a run scans only blobs without such a record, appends them, and
joins the findings back to all paths and versions that hold the blob.

A blob's text is moved once: map tasks drop their own copies before the
shuffle, so any number of equal texts costs one row per task. The ledger is
written by Spark's committed append; a rerun finds the finished blobs in it.

Spans are ``[start, end)`` in code points of the whole match, leftmost and
non-overlapping within a kind, ordered by start, then by kind as listed.

Defined results: null text is the empty blob; null or repeated ids and repeated
rows are kept row by row; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpulse.llm.common import byte_rows, small_batches
from creditpulse.session import scratch_path

RULE_VERSION = "3"
BASE = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
#: kind -> (pattern, text that every match holds). Matching the least length in
#: the pattern equals dropping shorter matches: these classes take a whole run.
RULES = {
    "access": (re.compile(r"AKIA[A-Z0-9]{12,}"), "AKIA"),
    "hex": (re.compile(r"[0-9a-f]{32,}"), ""),
    "github": (re.compile(r"gh[opsru]_[A-Za-z0-9]{36,}"), "gh"),
    "slack": (re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"), "xox"),
    "google": (re.compile(r"AIza[A-Za-z0-9_-]{35}"), "AIza"),
    "stripe": (re.compile(r"[rs]k_live_[A-Za-z0-9]{16,}"), "k_live_"),
    "jwt": (re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), "eyJ"),
    "pem": (re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(?:[^-]|-(?!----))*+-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"), "PRIVATE KEY"),
}
KINDS = ["assign", *RULES]
MIN_VALUE = 8
SPANS = "array<struct<kind:string,start:long,end:long>>"


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text, in order."""
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    for kind, (pattern, part) in RULES.items():
        if part in text:
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def redact(text: str, where: list[tuple[int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, end in sorted(where):
        if start < at:
            at = max(at, end)
            continue
        out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


def blob_of(text_col):
    return F.sha2(F.coalesce(text_col.cast("string"), F.lit("")), 256)


def scan_new(versions: DataFrame, ledger: str, text_col: str, rule_version: str) -> DataFrame:
    """Scan the blobs of ``versions`` that the ledger lacks; the ledger's rows for this rule version."""
    spark = versions.sparkSession
    small_batches(spark)
    schema = f"blob string, rule_version string, spans {SPANS}"
    try:
        known = spark.read.schema(schema).parquet(ledger)
        known.limit(0).count()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], schema)
    blobs = (versions.select(blob_of(versions[text_col]).alias("blob"),
                             F.coalesce(versions[text_col].cast("string"), F.lit("")).alias("text"))
             .dropDuplicates(["blob"]))
    unseen = blobs.join(known.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end"), s)) for s in spans(t.decode("utf-8", "replace"))]
                     for t in byte_rows(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array([rule_version] * len(found), pa.string()),
                                   pa.array(found, kind)], names=["blob", "rule_version", "spans"])

    unseen.mapInArrow(run, schema).write.mode("append").parquet(ledger)
    return spark.read.schema(schema).parquet(ledger).where(F.col("rule_version") == rule_version)


def find_secrets(versions: DataFrame, ledger: str | None = None, text_col: str = "text",
                 rule_version: str = RULE_VERSION) -> DataFrame:
    """``blob, spans`` of every blob of the ledger in which something was found.

    ``ledger`` is a folder of shared storage that lives on between runs; without
    one the run starts an empty ledger below ``spark.checkpoint.dir``.
    """
    ledger = ledger or scratch_path(versions.sparkSession, "llm-blob-ledger")
    return (scan_new(versions, ledger, text_col, rule_version).where(F.size("spans") > 0)
            .dropDuplicates(["blob"]).select("blob", "spans"))


def joined(part):
    return F.array_join(F.transform(part, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_documents(docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: id, ``blob``, counts per base kind, digest of the base spans, ``spans`` as text."""
    found = find_secrets(docs, ledger, text_col)
    rows = docs.select(docs[id_col], blob_of(docs[text_col]).alias("blob"))
    out = rows.join(found.withColumnRenamed("spans", "found"), "blob", "left")
    found = F.coalesce("found", F.array().cast(SPANS))
    base = F.filter(found, lambda s: s["kind"].isin(BASE))
    kinds = F.transform(found, lambda s: s["kind"])
    return out.select(
        id_col, "blob", *((F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(found).alias("spans"))


def redacted(docs: DataFrame, columns: list[str], ledger: str | None = None, text_col: str = "text",
             length_col: str | None = "n_chars") -> DataFrame:
    """``columns`` of ``docs`` with every found span replaced and the length set anew."""
    found = find_secrets(docs, ledger, text_col)
    rows = (docs.select(*columns).withColumn("__blob", blob_of(F.col(text_col)))
            .join(found.select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans")), "__blob", "left"))
    schema = docs.select(*columns).schema
    arrow_batches = rows.select(*columns, F.transform("__spans", lambda s: F.array(s["start"], s["end"])).alias("__where"))

    def run(batches):
        for batch in batches:
            at, length = columns.index(text_col), columns.index(length_col) if length_col else -1
            where = batch.column(len(columns)).to_pylist()
            cols = [batch.column(i) for i in range(len(columns))]
            if any(where):
                texts = cols[at].to_pylist()
                texts = [redact(t, [tuple(x) for x in w]) if w else t for t, w in zip(texts, where)]
                cols[at] = pa.array(texts, cols[at].type)
                if length_col:
                    sizes = cols[length].to_pylist()
                    cols[length] = pa.array([len(t) if w else n for t, w, n in zip(texts, where, sizes)], cols[length].type)
            yield pa.record_batch(cols, names=columns)

    return arrow_batches.mapInArrow(run, schema)
