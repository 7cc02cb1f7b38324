"""Quality rules with cross-document line frequency.

Method: the lines of every document are normalised and hashed; for every host
(here the ``source``) the distinct documents holding a line are counted, a line
in more than ``max_docs`` documents of a host is removed everywhere but in the first
document that holds it, and a document that keeps too little of its words is
rejected. Texts that are equal count as one document, so copies alone never
make a line frequent.

``quality`` judges every row; ``cleaned`` returns the kept rows with the frequent
lines taken out of their texts.

One pass over the texts measures the base columns and the line hashes; all
counting then runs on the hashes alone, and the frequent lines of each document
are joined back to its text by row. A hot line is counted by partial
aggregation. The limit is a number of documents and does not follow the host's
size: boilerplate of a small part of a large host is found as well.

Defined results: a null or empty text has no words and fails the base rules;
a null source is a host of its own; null or repeated ids and repeated rows are
kept row by row (equal texts get equal verdicts unless one of them is the
first holder of a frequent line); other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpulse.llm.common import byte_rows, cut, numbered, small_batches, with_row_id

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
DIGITS = re.compile(rb"[0-9]+")
CONTINUATION = bytes(range(0x80, 0xC0))

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def normal_line(line: bytes) -> bytes:
    """Lower-case ``A-Z``, digit runs as ``0``, single spaces."""
    return DIGITS.sub(b"0", b" ".join(line.lower().split()))


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words inside ``width``-word windows that occur twice or more."""
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    starts = np.fromiter((count[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for i in range(width):
        covered[i:i + len(starts)] |= starts
    return int(covered.sum())


def measure(text: bytes) -> tuple[list[int], list[int], list[int]]:
    """Base measures; hash and words of each distinct normalised line."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    per_line: dict[int, int] = {}
    for line in lines:
        h = line_hash(line)
        per_line[h] = per_line.get(h, 0) + len(line.split())
    base = [
        len(words),
        len(text.translate(None, SPACE + CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
    ]
    return base, list(per_line), list(per_line.values())


def measured(docs: DataFrame, id_col: str, host_col: str, text_col: str, row_col: str | None) -> DataFrame:
    """``row_id, id, host``, the base measures, text hash and lines of every row."""
    small_batches(docs.sparkSession)
    rows = numbered(docs, row_col).select(F.col("__row").alias("row_id"), F.col(id_col).alias("id"),
                                          F.col(host_col).alias("host"), F.col(text_col).cast("string").alias("text"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"row_id {kind['row_id']}, id {kind['id']}, host {kind['host']}", *(f"{m} long" for m in MEASURES),
                        "text_hash binary, line_hash array<long>, line_words array<int>"])

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in byte_rows(batch.column("text"))]
            base, hashes, counts = zip(*map(measure, texts)) if texts else ((), (), ())
            yield pa.record_batch(
                [*(batch.column(c) for c in ("row_id", "id", "host")),
                 *(pa.array([b[i] for b in base], pa.int64()) for i in range(len(MEASURES))),
                 pa.array([xxhash.xxh128_digest(t) for t in texts], pa.binary()),
                 pa.array(hashes, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32()))],
                names=["row_id", "id", "host", *MEASURES, "text_hash", "line_hash", "line_words"])

    return rows.mapInArrow(run, schema)


def line_hash(line: bytes) -> int:
    return xxhash.xxh64_intdigest(normal_line(line)) - (1 << 63)


def without_lines(text: bytes, gone: set[int]) -> bytes:
    """``text`` without the lines whose hashes are in ``gone``; other lines, blank ones too, stay as they are."""
    return b"\n".join(x for x in text.split(b"\n") if not x.strip(SPACE) or line_hash(x) not in gone)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            min_words: int = 10, max_repeat_pct: int = 20, max_docs: int = 100,
            min_left_words: int = 10, min_left_pct: int = 20, row_col: str | None = None) -> DataFrame:
    """``quality`` with ``removed_lines``, the hashes of each row's frequent lines (null if it has none).

    A line is frequent on a host if more than ``max_docs`` of the host's
    documents hold it. A document is depleted if fewer than
    ``min_left_words`` or ``min_left_pct`` per cent of its words are left.
    """
    rows = cut(measured(docs, id_col, host_col, text_col, row_col), "quality-rows")
    # Equal texts of a host are one document; its first row by id stands for it.
    lines = rows.select("host", "id", "row_id", "text_hash", F.explode("line_hash").alias("line"))
    frequent = cut(
        lines.groupBy("host", "line", "text_hash").agg(F.min(F.struct("id", "row_id")).alias("first"))
        .groupBy("host", "line").agg(F.count("*").alias("docs"), F.min("first").alias("first"))
        .where(F.col("docs") > max_docs).select("host", "line", "first"), "quality-lines")
    each = rows.select("host", "row_id", F.inline(F.arrays_zip(F.col("line_hash").alias("line"),
                                                               F.col("line_words").alias("words"))))
    removed = (each.alias("e").join(frequent.alias("f"), (F.col("e.line") == F.col("f.line"))
                                    & F.col("e.host").eqNullSafe(F.col("f.host")))
               .where(F.col("e.row_id") != F.col("first.row_id"))
               .groupBy("row_id").agg(F.sum("words").alias("gone"), F.collect_list("e.line").alias("removed_lines")))
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < min_left_words) | (100 * left < min_left_pct * F.col("n_words")))
    return (rows.join(removed, "row_id", "left")
            .select("row_id", F.col("id").alias(id_col), *MEASURES, base_failed.alias("base_failed"),
                    F.coalesce("gone", F.lit(0)).cast("long").alias("n_removed_words"), "removed_lines")
            .withColumn("kept", ~F.col("base_failed") & ~depleted))


def quality(docs: DataFrame, *args, **options) -> DataFrame:
    """``row_id``, id, base measures, ``base_failed``, ``n_removed_words``, ``kept`` of every row; options of ``judged``."""
    return judged(docs, *args, **options).drop("removed_lines")


def cleaned(docs: DataFrame, columns: list[str], text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """``columns`` of the kept rows without their frequent lines, the length of changed texts set anew."""
    docs = with_row_id(docs, "row_id")
    kept = judged(docs, text_col=text_col, row_col="row_id", **options).where("kept").select("row_id", F.col("removed_lines").alias("__gone"))
    rows = docs.select("row_id", *columns).join(kept, "row_id").select(*columns, "__gone")
    schema = docs.select(*columns).schema
    at, length = columns.index(text_col), columns.index(length_col) if length_col else -1

    def run(batches):
        for batch in batches:
            gone = batch.column(len(columns)).to_pylist()
            cols = [batch.column(i) for i in range(len(columns))]
            if any(gone):
                texts = [without_lines(t, set(g)).decode() if g else t and t.decode() for t, g in zip(byte_rows(cols[at]), gone)]
                cols[at] = pa.array(texts, cols[at].type)
                if length_col:
                    cols[length] = pa.array([len(t) if g else n for t, g, n in zip(texts, gone, cols[length].to_pylist())], cols[length].type)
            yield pa.record_batch(cols, names=columns)

    return rows.mapInArrow(run, schema)
