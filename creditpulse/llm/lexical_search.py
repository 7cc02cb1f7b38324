"""Ranked lexical search of items in documents: the Best Position Algorithm.

Terms are maximal runs of ASCII letters and digits and of all characters beyond
ASCII, with ``A-Z`` lower-cased. A document's score for an item is the sum of
its impacts under the item's terms, repeats included; an impact depends on the
term and the document only and is a whole number.

One pass over the texts keeps each document's length and its counts of the
items' terms; the corpus statistics are aggregated from that table. Its rows are
then searched where they lie, in shards of bounded size. A shard holds a list
per term, by impact, and the same list by document for direct access. For each
item the lists are read down together; every document met is scored at once by
direct accesses, which mark its place in all lists. A list's best position is
the last place before which everything has been seen, by either kind of access;
no unseen document can score more than the sum of the impacts at the best
positions. The search stops when that sum is strictly below the k-th score, so
no tie is lost. The k-th score found in one shard is where the task's next shard
starts. Each task returns at most k documents an item; two levels of windows
merge them.

Items are broadcast in blocks of about ``BLOCK_BYTES`` of text (an item that is
longer is a block of its own), each searched against all documents.

Defined results: null texts have no terms; a document without terms counts
nowhere; items without terms or hits give no rows. Rows with equal or null ids
are documents (items) of their own; null ids come last among equal scores. An
empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from creditpulse.llm.common import byte_rows, chunks, cut, with_row_id

BLOCK_BYTES = 8 << 20  # bound of the items' text that is broadcast at once
SHARD_POSTINGS = 2_000_000  # counts that a task holds at once, and one document's more
FIRST_READ = 16  # places read of each list at first; then twice as many each time
MERGERS = 64  # tasks' results merged in so many parts first
#: ASCII bytes outside terms become spaces, A-Z become a-z.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


@dataclass
class Items:
    """A block of items over its own vocabulary."""

    ids: pa.Array
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]  # distinct terms of each item
    times: list[np.ndarray]  # how often the item has them


def read_items(rows) -> Items:
    vocabulary: dict[bytes, int] = {}
    terms, times = [], []
    for text in byte_rows(rows.column(1).combine_chunks() if rows.num_rows else pa.array([], pa.string())):
        own = [vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text or b"")]
        t, n = np.unique(np.array(own, np.int64), return_counts=True)
        terms.append(t)
        times.append(n)
    return Items(rows.column(0).combine_chunks(), vocabulary, terms, times)


def term_counts(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, tfs``: all terms of each document, and the counts of those in the vocabulary."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        get, other = vocabulary.value.get, itertools.repeat(-1)
        for batch in batches:
            texts = [t or b"" for t in byte_rows(batch.column(1))]
            for part in chunks([len(t) for t in texts]):
                words = [terms_of(texts[i]) for i in part]
                n = np.fromiter(map(len, words), np.int64, len(words))
                flat = np.fromiter(map(get, itertools.chain.from_iterable(words), other), np.int64, int(n.sum()))
                row = np.repeat(np.arange(len(words)), n)[flat >= 0]
                found, tf = np.unique(row << 32 | flat[flat >= 0], return_counts=True)
                ends = pa.array(np.searchsorted(found, np.arange(len(words) + 1) << 32), pa.int32())
                yield pa.record_batch(
                    [batch.column(0).slice(part.start, len(part)), pa.array(n),
                     pa.ListArray.from_arrays(ends, pa.array((found & 0xFFFFFFFF).astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))],
                    names=["id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, f"id {kind}, n long, terms array<int>, tfs array<long>")


@dataclass
class Corpus:
    """What the whole table says."""

    n: int  # documents with a term
    length: int  # their terms
    weights: np.ndarray  # of the vocabulary's terms

    def norms(self, n: np.ndarray) -> np.ndarray:
        """A document's ``m``, times 8."""
        if len(n) and 75 * int(n.max()) * self.n >= 1 << 63:
            return np.array([8 * (25 + 75 * int(x) * self.n // self.length) for x in n], np.int64)
        return 8 * (25 + 75 * n * self.n // self.length)


def statistics(index: DataFrame, size: int) -> Corpus:
    n, length = index.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(size, np.int64)
    for row in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the vocabulary
        df[row.term] = row["count"]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df]
    return Corpus(n, int(length or 1), np.array(weights, np.int64))


class Shard:
    """Impact lists of a set of documents, and the same lists by document."""

    def __init__(self, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, corpus: Corpus):
        doc = np.repeat(np.arange(len(n)), np.diff(ends))
        impact = corpus.weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + corpus.norms(n)[doc]))
        some = impact > 0
        doc, terms, impact = doc[some], terms[some], impact[some]
        order = np.argsort(terms, kind="stable")  # by term, then by document
        self.doc, self.impact, terms = doc[order], impact[order], terms[order]
        self.start = np.searchsorted(terms, np.arange(len(corpus.weights) + 1))
        self.by_impact = np.lexsort((self.doc, -self.impact, terms))  # place in the lists -> posting
        place = np.empty(len(order), np.int64)
        place[self.by_impact] = np.arange(len(order))
        self.place = place - self.start[terms]  # of each posting in its list
        self.known = np.zeros(len(n), bool)

    def search(self, terms: np.ndarray, times: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the ``k`` best, and their scores: all that
        score at least ``floor`` and the k-th best of this shard."""
        lists = [(int(a), int(b), int(c)) for a, b, c in zip(self.start[terms], self.start[terms + 1], times) if b > a]
        seen = [np.zeros(b - a + 1, bool) for a, b, _ in lists]  # a last place that is never seen
        best = [0] * len(lists)  # places before the first unseen one
        found, scored = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        read, step, kth = 0, FIRST_READ, floor
        longest = max((b - a for a, b, _ in lists), default=0)
        top = np.empty(0, np.int64)
        while read < longest:
            posts = np.concatenate([self.by_impact[a + read:min(a + read + step, b)] for a, b, _ in lists])
            docs = self.doc[posts]
            docs = np.unique(docs[~self.known[docs]])
            read, step = read + step, step * 2
            if len(docs):
                self.known[docs] = True
                score = np.zeros(len(docs), np.int64)
                for i, (a, b, c) in enumerate(lists):  # direct accesses
                    own = self.doc[a:b]
                    at = np.searchsorted(own, docs)
                    at[at == b - a] = 0
                    hit = own[at] == docs
                    at = at[hit] + a
                    score[hit] += c * self.impact[at]
                    seen[i][self.place[at]] = True
                    best[i] += int(np.argmin(seen[i][best[i]:]))
                found.append(docs)
                scored.append(score)
                top = np.concatenate([top, score])
                if len(top) > k:
                    top = np.partition(top, len(top) - k)[len(top) - k:]
                if len(top) == k:
                    kth = max(floor, int(top.min()))
            bound = sum(c * int(self.impact[self.by_impact[a + p - 1]]) for (a, b, c), p in zip(lists, best) if p < b - a)
            if bound < kth:
                break
        docs, score = np.concatenate(found), np.concatenate(scored)
        self.known[docs] = False
        good = score >= max(kth, 1)
        return docs[good], score[good]


def best_in_task(batches, items: Items, corpus: Corpus, k: int):
    """``item, doc_id, score`` rows: at most ``k`` an item over all batches."""
    best: list[list] = [[] for _ in items.terms]  # (-score, id is null, id)

    def flush(held):
        n = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in held])
        sizes = np.concatenate([np.diff(b.column(2).offsets.to_numpy()) for b in held])
        terms = np.concatenate([b.column(2).flatten().to_numpy(zero_copy_only=False) for b in held])
        tfs = np.concatenate([b.column(3).flatten().to_numpy(zero_copy_only=False) for b in held])
        ids = pa.chunked_array([b.column(0) for b in held])
        shard = Shard(n, np.r_[0, np.cumsum(sizes)], terms, tfs, corpus)
        for i, (t, c) in enumerate(zip(items.terms, items.times)):
            floor = -best[i][-1][0] if len(best[i]) == k else 0
            docs, score = shard.search(t, c, k, floor)
            if len(docs):
                own = ids.take(pa.array(docs)).to_pylist()
                rows = best[i] + [(-s, d is None, d) for s, d in zip(score.tolist(), own)]
                best[i] = sorted(rows, key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))[:k]

    held, size = [], 0
    for batch in batches:
        rows = np.diff(batch.column(2).offsets.to_numpy())
        for part in chunks(rows.tolist(), SHARD_POSTINGS):
            piece = batch.slice(part.start, len(part))
            if held and size + int(rows[part.start:part.stop].sum()) > SHARD_POSTINGS:
                flush(held)
                held, size = [], 0
            held.append(piece)
            size += int(rows[part.start:part.stop].sum())
    if held:
        flush(held)
    return [(i, -s, d) for i, rows in enumerate(best) for s, _, d in rows]


def search_block(items: Items, docs: DataFrame, k: int, item_id: str, item_type: str, doc_id: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    index = cut(term_counts(docs, share(items.vocabulary), doc_id, text_col), "search-index")
    shared = share((items, statistics(index, len(items.vocabulary))))
    doc_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        block, corpus = shared.value
        rows = best_in_task(batches, block, corpus, k)
        if rows:
            at, score, ids = map(list, zip(*rows))
            yield pa.record_batch([pa.array(at, pa.int64()), block.ids.take(pa.array(at)), pa.array(ids, doc_kind), pa.array(score, pa.int64())],
                                  names=["at", "item", "id", "score"])

    doc_kind = to_arrow_type(docs.schema[doc_id].dataType)
    found = index.mapInArrow(run, f"at long, item {item_type}, id {doc_type}, score long")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    part = F.pmod(F.spark_partition_id(), F.lit(MERGERS))
    found = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("at", "part").orderBy(*order)))
    found = found.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("at").orderBy(*order)))
    return found.where(F.col("rank") <= k).select(
        F.col("item").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(doc_id), "score")


def search(items: DataFrame, docs: DataFrame, k: int = 10, item_id: str = "item_id", item_text: str = "text",
           doc_id: str = "doc_id", doc_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0."""
    rows = with_row_id(items.select(items[item_id].alias("id"), items[item_text].cast("string").alias("text")), "__row")
    rows = cut(rows.select("id", "text", F.xxhash64("__row").alias("row"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")), "search-items")
    total = rows.agg(F.sum("size")).first()[0] or 0
    blocks = 1
    while True:  # until no block of several items is too large
        block = F.pmod("row", F.lit(blocks))
        sizes = rows.groupBy(block.alias("block")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        if blocks > 64 * (1 + total // BLOCK_BYTES) or not sizes.where((F.col("size") > BLOCK_BYTES) & (F.col("n") > 1)).head(1):
            break
        blocks = max(blocks * 2, 2 * math.ceil(total / BLOCK_BYTES))
    item_type = items.schema[item_id].dataType.simpleString()
    parts = [search_block(read_items(rows.where(block == b).select("id", "text").toArrow()), docs, k, item_id, item_type, doc_id, doc_text)
             for b in range(blocks)]
    return functools.reduce(DataFrame.unionByName, parts)
