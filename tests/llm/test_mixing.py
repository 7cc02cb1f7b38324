"""Source mixing: targets by step-wise resharing, the rest by what must hold."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from creditpulse.llm.mixing import Mixture, copies, permuted, running_start


def stepwise(sizes, weights=(3, 1, 2), ratio=1.5, cap=2.0):
    """``sizes`` in source order -> targets, resharing the excess until none is above."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    most, target, free = [cap * s for s in sizes], [0.0] * len(sizes), set(range(len(sizes)))
    left = ratio * sum(sizes)
    while free and left > 1e-9:
        share = {i: left * w[i] / sum(w[j] for j in free) for i in free}
        over = [i for i in free if target[i] + share[i] > most[i] + 1e-9]
        if not over:
            for i in free:
                target[i] += share[i]
            return target
        left = 0.0
        for i in list(free):
            target[i] += share[i]
            if target[i] >= most[i] - 1e-9:
                left += target[i] - most[i]
                target[i] = most[i]
                free.discard(i)
    return target


def collection(seed, n=400):
    rng = random.Random(seed)
    names = [None, "b", "a", "é", "Z", "😀", "aa", ""]
    return [(i, " ".join(["w"] * rng.choice([0, 1, 3, 50, 200, 1000])), rng.choice(names + ["a"] * 6)) for i in range(n)]


@pytest.mark.parametrize("seed,block", [(1, 16), (2, 128)])
def test_mixture(spark, seed, block):
    rows = collection(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = Mixture(df, block_words=block, shard_slots=64)
    got = {r.id: r for r in mix.documents.collect()}
    size = Counter()
    for i, t, s in rows:
        size[s] += len(t.split())
        assert got[i].size == len(t.split()) and 0 <= got[i].taken <= 2 * got[i].size
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in size else [])
    target = dict(zip(order, stepwise([size[s] for s in order])))
    taken = Counter()
    for r in got.values():
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= block
    slots = [r for r in mix.ordered_slots().collect()]
    shards, uses = defaultdict(set), defaultdict(Counter)
    for r in slots:
        shards[r.shard].add(r.slot)
        uses[r.s][r.block] += 1
    assert all(v == set(range(len(v))) for v in shards.values())
    assert all(len(shards[k]) == 64 for k in range(max(shards)))  # full shards
    for r in mix.sources.collect():
        if r.n_slots:
            assert sum(uses[r.s].values()) == r.n_slots and set(uses[r.s]) <= set(range(r.blocks))
            often = {uses[r.s][b] for b in range(r.blocks)}
            assert max(often) - min(often) <= 1  # all once before any twice
    pieces = defaultdict(list)
    for r in mix.pieces.collect():
        assert 0 < r.words <= block
        pieces[r.id].append((r.first_word, r.words))
    for i, t, _ in rows:  # the pieces of a document are all its words, in order
        at = 0
        for first, words in sorted(pieces[i]):
            assert first == at
            at += words
        assert at == len(t.split())
    again = {r.id: r.taken for r in Mixture(df.repartition(5), block_words=block, shard_slots=64).documents.collect()}
    assert again == {i: r.taken for i, r in got.items()}
    whole = {r.row_id: r.copies for r in copies(mix.documents).collect()}
    assert abs(sum(whole[r.row_id] * r.size for r in got.values() if r.row_id in whole) - sum(taken.values())) < 0.1 * sum(taken.values())


def test_shards_are_multinomial_draws(spark):
    rows = [(i, " ".join(["w"] * 100), "ab"[i % 2]) for i in range(400)]
    mix = Mixture(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_words=10, shard_slots=100)
    share = {r.s: r.n_slots for r in mix.sources.collect()}
    p = share[0] / sum(share.values())
    drawn = {(r.shard, r.s): r.drawn for r in mix._drawn(sum(share.values())).collect()}
    counts = [drawn.get((k, 0), 0) for k in range(sum(share.values()) // 100)]
    mean = sum(counts) / len(counts)
    variance = sum((c - mean) ** 2 for c in counts) / len(counts)
    assert abs(mean / 100 - p) < 0.05 and 0.4 < variance / (100 * p * (1 - p)) < 2.2


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation(spark, n):
    out = spark.range(n).select(permuted(F.col("id"), F.lit(n), F.lit("x")).alias("p"), "id").collect()
    assert sorted(r.p for r in out) == list(range(n))
    if n > 60:
        assert sum(r.p == r.id for r in out) < n / 8


def test_running_start(spark):
    rows = [(k, i, i % 7) for k in ("a", "b") for i in range(100)]
    out = running_start(spark.createDataFrame(rows, "k string, i long, v long"), "k", F.expr("i div 9"), ["i"], "v", "start").collect()
    assert all(r.start == sum(j % 7 for j in range(r.i)) for r in out)


def test_mixing_odd_tables(odd_frame, empty_frame):
    rows = Mixture(odd_frame, block_words=16).documents.collect()
    assert len(rows) == odd_frame.count()
    assert all(r.taken == 0 for r in rows if r.size == 0) and all(r.taken <= 2 * r.size for r in rows)
    none = [r for r in rows if r.source is None]
    assert len(none) == 2 and {r.source_size for r in none} == {0} and {r.target for r in none} == {0.0}
    assert Mixture(empty_frame).documents.count() == 0
