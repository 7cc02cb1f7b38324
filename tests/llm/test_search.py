"""Ranked lexical search: the best positions and the operator against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditpulse.llm import lexical_search as L

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(items, docs, k=10):
    """``(item_id, rank, doc_id, score)``; items and docs are (id, text) rows."""
    own = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    own = [d for d in own if d[2]]
    n, total = len(own), sum(d[2] for d in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        rows = []
        for i, c, length in own:
            m = 100 - 75 + (75 * length * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        rows.sort(key=lambda r: r[:3])
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(rows[:k], 1)]
    return sorted(out, key=str)


def made_up(n, seed=1):
    rng = random.Random(seed)
    words = ["the", "The", "of", "and", "rare", "é", "世", "x9", "a-b", "q!"] + [f"w{i}" for i in range(60)]
    weights = [30, 5, 20, 15, 1, 2, 2, 2, 2, 1] + [60 / (i + 3) for i in range(60)]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, 80))) for _ in range(n)]


@pytest.mark.parametrize("postings", [40, 2_000_000])
def test_shards_and_stops_lose_nothing(postings, monkeypatch):
    """The search in one task, in one shard and in many, with k-th scores carried over."""
    import pyarrow as pa

    monkeypatch.setattr(L, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(L, "FIRST_READ", 2)
    docs = made_up(500) + ["rare rare the"] * 30
    queries = made_up(20, 2) + ["the", "rare", "the the rare", "nowhere", ""]
    items = L.read_items(pa.table({"id": list(range(len(queries))), "text": queries}))
    counts = [Counter(items.vocabulary.get(t.encode(), -1) for t in terms(d)) for d in docs]
    batch = pa.record_batch([
        pa.array(range(len(docs))), pa.array([len(terms(d)) for d in docs]),
        pa.array([sorted(t for t in c if t >= 0) for c in counts], pa.list_(pa.int32())),
        pa.array([[c[t] for t in sorted(c) if t >= 0] for c in counts], pa.list_(pa.int64()))], names=["id", "n", "terms", "tfs"])
    some = [len(terms(d)) for d in docs]
    df = Counter(t for c in counts for t in c)
    n = sum(map(bool, some))
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in range(len(items.vocabulary))]
    corpus = L.Corpus(n, sum(some), np.array(weights))
    got = L.best_in_task([batch], items, corpus, 10)
    want = brute(list(enumerate(queries)), list(enumerate(docs)))
    assert sorted(((i, d, s) for i, s, d in got), key=str) == sorted(((i, d, s) for i, _, d, s in want), key=str)


def test_the_search_stops_early():
    """Few documents are scored when the best are clear."""
    n = 20_000
    norm = np.full(n, 20)
    terms_, tfs, ends = [], [], [0]
    for d in range(n):
        own = [0, 1, 2] if d < 12 else [d % 3]
        terms_ += own
        tfs += [50] * 3 if d < 12 else [1]
        ends.append(len(terms_))
    shard = L.Shard(norm, np.array(ends), np.array(terms_), np.array(tfs), L.Corpus(n, 20 * n, np.array([900, 800, 700])))
    scored = []
    seen = np.unique
    L.np.unique = lambda x: scored.append(len(x)) or seen(x)
    try:
        docs, _ = shard.search(np.array([0, 1, 2]), np.array([1, 1, 1]), 10, 0)
    finally:
        L.np.unique = seen
    assert set(docs.tolist()) == set(range(12)) and sum(scored) < 200


def test_the_operator_equals_brute_force(spark, monkeypatch):
    docs = made_up(400, 3) + ["", None, "...", "the of " * 5000] + ["copy of the rare text"] * 25
    ids = [i if i % 50 else None for i in range(len(docs))]
    frame = spark.createDataFrame(list(zip(ids, docs)), "doc_id long, text string")
    frame = frame.withColumns({c: F.lit("x") for c in ("id", "n", "terms", "item_id", "score", "rank", "at")})
    queries = list(zip([*range(10), 3, None], made_up(9, 4) + ["copy rare", "copy", None]))
    items = spark.createDataFrame(queries, "item_id long, text string").withColumns({c: F.lit("x") for c in ("id", "size", "row", "doc_id")})
    want = brute(queries, list(zip(ids, docs)))
    assert sorted(map(tuple, L.search(items, frame.repartition(4)).collect()), key=str) == want
    monkeypatch.setattr(L, "BLOCK_BYTES", 300)  # several blocks of items
    assert sorted(map(tuple, L.search(items, frame.repartition(3)).collect()), key=str) == want


def test_odd_and_empty_tables(spark, odd_frame, empty_frame):
    items = odd_frame.select(F.col("doc_id").alias("item_id"), "text", "kept")
    rows = [(r.doc_id, r.text) for r in odd_frame.collect()]
    assert sorted(map(tuple, L.search(items, odd_frame).collect()), key=str) == brute(rows, rows)
    assert L.search(items, empty_frame).count() == 0 and L.search(items.where("false"), odd_frame).count() == 0


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "two one"), ("c", "three")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "One")], "item_id string, text string")
    assert [(r["rank"], r.doc_id) for r in sorted(L.search(items, docs).collect(), key=lambda r: r["rank"])] == [(1, "a"), (2, "b")]
