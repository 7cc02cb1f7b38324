"""Toxicity scores from a counterfactually regularised classifier.

Method: a logistic model over word features (whole words, their beginnings and
ends) is fitted to labelled texts. In every labelled sentence that names a
group, the identity term is swapped for the others of its kind, and the squared
change of the sentence's score is penalised; so the model cannot learn that
naming a group is toxic, and neutral mentions are not flagged.

Feature statistics are summed in Spark. The fit uses a bounded sample of
labelled rows (``max_rows``, those with the smallest hash of the id), reduced
to ``max_features`` features; both bound what reaches the driver.

Defined results: null or empty texts have no features and score as the model's
intercept; without training rows every score is 0.5; labels with a null id or
null mark are ignored; a null ``doc_id`` is not held out; repeated ids and rows
are kept row by row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpulse.llm.common import byte_rows, small_batches

#: Terms of a kind may replace each other.
IDENTITY = [
    ["woman", "man"], ["women", "men"], ["girl", "boy"], ["girls", "boys"], ["female", "male"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "african", "european", "arab"],
    ["gay", "straight", "lesbian", "bisexual", "transgender"],
    ["immigrant", "native", "refugee"], ["immigrants", "natives", "refugees"],
    ["disabled", "deaf", "blind"], ["old", "young", "elderly"],
    ["frau", "mann"], ["frauen", "männer"], ["christen", "muslime", "juden"], ["ausländer", "inländer"],
    ["femme", "homme"], ["femmes", "hommes"], ["chrétiens", "musulmans", "juifs"],
    ["mujer", "hombre"], ["mujeres", "hombres"], ["cristianos", "musulmanes", "judíos"],
]
SWAPS = {t: [u for u in kind if u != t] for kind in IDENTITY for t in kind}
WORDS = re.compile(r"[^\W\d_]+")
SENTENCES = re.compile(r"[.!?\n]+")
BEGINS, ENDS = range(3, 10), range(3, 6)  # characters
KNOWN_WORDS = 400_000  # words whose features a worker remembers


def word_features(word: str) -> list[str]:
    """The word itself, its beginnings and its ends: compounds and inflections share them."""
    return [word, *(f"^{word[:k]}" for k in BEGINS if len(word) > k), *(f"{word[-k:]}$" for k in ENDS if len(word) > k)]


def words_of(text: str) -> set[str]:
    return set(WORDS.findall(text.lower()))


class Features:
    """Maps words to the indices of the features that a model uses."""

    def __init__(self, names: list[str]):
        self.index = {n: i for i, n in enumerate(names)}
        self.known: dict[str, tuple] = {}
        self.live: set[str] = set()

    def of(self, words: set[str]) -> set[int]:
        new = words.difference(self.known)
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, self.live = {}, set()
            new = words
        for w in new:
            found = tuple(self.index[f] for f in word_features(w) if f in self.index)
            self.known[w] = found
            if found:
                self.live.add(w)
        out: set[int] = set()
        for w in words & self.live:
            out.update(self.known[w])
        return out


@dataclass
class Model:
    names: list[str]
    weights: np.ndarray
    intercept: float
    cache: dict = field(default_factory=dict, repr=False)


def sample_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, mark_col: str, max_rows: int) -> DataFrame:
    """``y, text`` of at most ``max_rows`` labelled training documents."""
    marks = (labels.where(labels[id_col].isNotNull() & labels[mark_col].isNotNull())
             .where(F.crc32(labels[id_col].cast("string").cast("binary")) % 3 != 1)
             .groupBy(labels[id_col].alias("__id")).agg(F.max(labels[mark_col].cast("int")).alias("y"))
             .orderBy(F.xxhash64("__id"), "__id").limit(max_rows))
    # Bounded by max_rows, hence safe to broadcast.
    texts = docs.select(docs[id_col].alias("__doc"), docs[text_col].cast("string").alias("text"))
    return texts.join(F.broadcast(marks), F.col("__doc") == F.col("__id")).select("y", "text")


def feature_names(rows: DataFrame, max_features: int, min_docs: int, min_z: float) -> list[str]:
    """The features that tell the classes apart best, and the identity terms that occur."""

    def run(batches):
        toxic, every = Counter(), Counter()
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1))):
                found = set()
                for w in words_of((text or b"").decode("utf-8", "replace")):
                    found.update(word_features(w))
                every.update(found)
                if y:
                    toxic.update(found)
        yield pa.record_batch([pa.array(list(every), pa.string()), pa.array(list(every.values()), pa.int64()),
                               pa.array([toxic[f] for f in every], pa.int64())], names=["feature", "docs", "toxic"])

    counts = (rows.mapInArrow(run, "feature string, docs long, toxic long").groupBy("feature")
              .agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
              .where((F.col("docs") >= min_docs) | F.col("feature").isin(list(SWAPS))))
    sizes = {bool(r.y): r["count"] for r in rows.groupBy(F.col("y") != 0).count().toDF("y", "count").collect()}
    all_toxic, all_clean = sizes.get(True, 0), sizes.get(False, 0)
    t, c = F.col("toxic") + 0.5, F.col("docs") - F.col("toxic") + 0.5
    rest_t, rest_c = all_toxic + 1 - t, all_clean + 1 - c
    odds = F.log(t / rest_t) - F.log(c / rest_c)
    ranked = (counts.withColumn("z", odds / F.sqrt(1 / t + 1 / c))
              .withColumn("term", F.col("feature").isin(list(SWAPS)))
              .where(F.col("term") | (F.abs("z") >= min_z)))
    top = ranked.orderBy(F.desc("term"), F.desc(F.abs("z")), "feature").limit(max_features).select("feature")
    return [r.feature for r in top.collect()]


def examples(rows: DataFrame, names: list[str]) -> pa.Table:
    """``y, have, lack``: a text's features; or, with a null ``y``, what a swap in one
    of its sentences adds to and takes from the sentence's features."""

    def run(batches):
        features = Features(names)
        for batch in batches:
            y, have, lack = [], [], []
            for mark, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1))):
                text = (text or b"").decode("utf-8", "replace")
                words = words_of(text)
                y.append(mark)
                have.append(sorted(features.of(words)))
                lack.append([])
                if words.isdisjoint(SWAPS):
                    continue
                pairs = set()
                for sentence in SENTENCES.split(text):
                    own = words_of(sentence)
                    before = features.of(own)
                    for term in own.intersection(SWAPS):
                        for other in SWAPS[term]:
                            after = features.of(own - {term} | {other})
                            pairs.add((tuple(sorted(after - before)), tuple(sorted(before - after))))
                for more, less in sorted(pairs):
                    y.append(None)
                    have.append(more)
                    lack.append(less)
            kind = pa.list_(pa.int32())
            yield pa.record_batch([pa.array(y, pa.int32()), pa.array(have, kind), pa.array(lack, kind)], names=["y", "have", "lack"])

    # Equal rows need no second copy: they are summed with their number.
    return (rows.mapInArrow(run, "y int, have array<int>, lack array<int>").groupBy("y", "have", "lack")
            .agg(F.count("*").alias("n")).toArrow())


def dense(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.to_pylist()
    out = np.zeros((len(lists), width), np.float32)
    for i, x in enumerate(lists):
        out[i, x] = 1
    return out


def fit(table: pa.Table, width: int, ridge: float, penalty: float, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Newton's method for the penalised logistic loss; the last column is the intercept."""
    y = np.array(table.column("y").to_pylist(), dtype=np.float64)  # null becomes nan
    n = table.column("n").to_numpy().astype(np.float64)
    real = ~np.isnan(y)
    if not real.any():
        return np.zeros(width), 0.0
    have, lack = dense(table.column("have"), width), dense(table.column("lack"), width)
    x, y, weight = np.c_[have[real], np.ones(real.sum(), np.float32)], y[real], n[real]
    swap = np.c_[have[~real] - lack[~real], np.zeros((~real).sum(), np.float32)].astype(np.float64)
    fixed = np.diag(np.r_[np.full(width, ridge), 1e-3])
    fixed += penalty * (swap * n[~real, None]).T @ swap
    w = np.zeros(width + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T.astype(np.float64) @ (weight * (p - y)) + fixed @ w
        curve = fixed.copy()
        for at in range(0, len(x), 4096):
            part = x[at:at + 4096].astype(np.float64)
            curve += (part * (weight * p * (1 - p))[at:at + 4096, None]).T @ part
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark_col: str = "toxic",
          max_rows: int = 20_000, max_features: int = 512, min_docs: int = 10, min_z: float = 3.0, ridge: float = 0.1, penalty: float = 10.0) -> Model:
    small_batches(docs.sparkSession)
    rows = sample_rows(docs, labels, id_col, text_col, mark_col, max_rows)
    names = feature_names(rows, max_features, min_docs, min_z)
    weights, intercept = fit(examples(rows, names), len(names), ridge, penalty)
    return Model(names, weights, intercept)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", flag_at: float = 0.7) -> DataFrame:
    """id, ``held_out, score, predicted`` of every row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held_out = F.coalesce(F.crc32(docs[id_col].cast("string").cast("binary")) % 3 == 1, F.lit(False))
    rows = docs.select(docs[id_col].alias("id"), held_out.alias("held_out"), docs[text_col].cast("string").alias("text"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        m = shared.value
        features = m.cache.setdefault("features", None) or Features(m.names)
        m.cache["features"] = features  # kept for the worker's next task
        weights = m.weights.tolist()
        for batch in batches:
            logits = [m.intercept + sum(weights[i] for i in sorted(features.of(words_of((t or b"").decode("utf-8", "replace")))))
                      for t in byte_rows(batch.column(2))]
            p = 1 / (1 + np.exp(-np.clip(np.array(logits, np.float64), -500, 500)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= flag_at).astype(np.int32))],
                                  names=["id", "held_out", "score", "predicted"])

    out = rows.mapInArrow(run, f"id {kind['id']}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
