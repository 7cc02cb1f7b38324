"""SimHash, embeddings and connected components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from creditpulse.llm import embedding_dedup as E
from creditpulse.llm import simhash_dedup as H
from creditpulse.llm.components import components


def groups(n, pairs):
    """Smallest member reachable from each of ``range(n)``."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_are_minimal_roots(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(60)] + [(7, 7)]
    pairs += [(200, i) for i in range(201, 260)]  # a hub
    want = groups(300, pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {i: want[i] for i in touched}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_bit_sliced_links(radius):
    rng = np.random.default_rng(radius)
    fps = {int(f) for f in rng.integers(0, 1 << 63, 40, dtype=np.uint64)}
    for f in list(fps):
        for _ in range(12):
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                f ^= 1 << int(b)
            fps.add(f)
    fps = np.array(sorted(fps), np.uint64)
    group = np.sort(rng.integers(0, 5, len(fps)))
    a, b = H.link_groups(fps, group, radius)
    place = {int(f): i for i, f in enumerate(fps)}
    near = [(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps))
            if group[i] == group[j] and bin(int(fps[i]) ^ int(fps[j])).count("1") <= radius]
    assert groups(len(fps), near) == groups(len(fps), [(place[int(x)], place[int(y)]) for x, y in zip(a, b)])


@pytest.mark.parametrize("tile", [H.TILE_ROWS, 8])
def test_simhash_equals_brute_force(spark, frame, tile, monkeypatch):
    monkeypatch.setattr(H, "TILE_ROWS", tile)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            other = list(base)
            other[rng.randrange(len(other))] = rng.choice(words)
            texts.append(rng.choice([" ".join(base), "\n".join(base).upper(), " ".join(other)]))
    texts += ["", None, "one", "one two", "ONE  two"]
    rng.shuffle(texts)
    fps = [plain_fingerprint(t) for t in texts]
    want = groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2])
    rows = H.near_duplicates(frame(texts)).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{fps[i]:016x}", want[i]) for i in range(len(fps))}
    assert sorted(r.doc_id for r in rows if r.kept) == sorted(set(want))


def test_simhash_odd_rows(spark, odd_frame, empty_frame):
    rows = H.near_duplicates(odd_frame).collect()
    assert len(rows) == odd_frame.count()
    empty = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in empty} == {2, 3, 4} and {r.component_id for r in empty} == {2}
    assert sum(r.kept for r in rows if r.doc_id == 1) == 1  # repeated rows: one stays
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert H.near_duplicates(empty_frame).count() == 0


def clustered(rng, n, dim, groups_, spread):
    centres = rng.standard_normal((groups_, dim))
    return [(c + s * rng.standard_normal(dim)).astype(np.float32).tolist()
            for c, s in zip(centres[rng.integers(0, groups_, n)], rng.choice(spread, n))]


@pytest.mark.parametrize("dim,tile", [(64, 8192), (64, 16), (7, 20), (3, 8192)])
def test_embeddings_equal_brute_force(spark, dim, tile):
    rng = np.random.default_rng(dim + tile)
    vecs = clustered(rng, 150, dim, 30, [0.05, 0.2, 0.35])
    vecs += [vecs[0]] * 9 + [(np.array(vecs[1]) * 3).tolist()]  # copies, and a longer one
    vecs += [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1.0] * (dim + 1)]
    n, good = len(vecs), 160
    x = np.array([np.array(v, np.float32) for v in vecs[:good]], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    want = groups(n, [(i, j) for i in range(good) for j in range(i) if near[i, j]])
    links = [int(near[i].sum()) if i < good else 0 for i in range(n)]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vecs)], "vec_id long, embedding array<float>, label int")
    df = df.withColumns({c: F.lit("clash") for c in ("id", "vec", "node", "weight", "n_links")}).repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.near_vectors(df, tile_rows=tile).collect()}
    assert got == {i: (links[i], want[i], want[i] == i) for i in range(n)}


def test_embeddings_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert E.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = E.near_vectors(spark.createDataFrame([(None, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (9, None), (None, None)], schema)).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in rows) == [
        ("5", 2, 5, True), ("5", 2, 5, True), ("9", 0, 9, True), ("None", 0, None, False), ("None", 2, 5, False)]
