"""JN-1: the two-level as-of scan against a row-by-row replay of the
key-value store it models (brute force), on hand cases and random data,
including one hot order spread over many time chunks."""

import random

from pyspark.sql import functions as F

from creditpulse.operators.asof import asof_type, chunked

TTL = 5 * 86_400_000
SCHEMA = "order_id string, ts bigint, is_loan boolean, type string, rec_id string, amount bigint"


def replay(rows, ttl=TTL):
    """Store semantics: set (known type) creates/overwrites and refreshes;
    an unknown code refreshes a live entry only; loans read live entries."""
    out = {}
    by_order = {}
    for r in rows:
        by_order.setdefault(r[0], []).append(r)
    for order, evs in by_order.items():
        evs.sort(key=lambda r: (r[1], 1 if r[2] else 0, r[4]))
        typ, touch = None, None
        for o, ts, is_loan, t, rid, amt in evs:
            alive = typ is not None and ts - touch < ttl
            if is_loan:
                if alive:
                    out[rid] = typ
            elif t is not None:
                typ, touch = t, ts
            elif alive:
                touch = ts
            else:
                typ, touch = None, None
    return out


def run(spark, rows, chunk_ms, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.rec_id: r.type for r in asof_type(df, ttl_ms=TTL, chunk_ms=chunk_ms, **options).collect()}


def test_hand_cases(spark):
    d = 86_400_000
    rows = [
        ("o1", 0, False, "new", "o1a", None), ("o1", 4 * d, True, None, "o1b", 10),          # alive
        ("o1", 5 * d, True, None, "o1c", 10),                                                 # expired exactly at ttl
        ("o2", 0, False, "new", "o2a", None), ("o2", 4 * d, False, None, "o2b", None),        # refresh
        ("o2", 8 * d, True, None, "o2c", 5),                                                  # alive through refresh
        ("o3", 0, False, "new", "o3a", None), ("o3", 6 * d, False, None, "o3b", None),        # refresh after expiry: nothing
        ("o3", 7 * d, True, None, "o3c", 5),
        ("o4", 100, False, "settle.one", "o4a", None), ("o4", 100, True, None, "o4b", 1),     # same time: touch first
        ("o5", 0, True, None, "o5a", 1),                                                      # no type yet
        ("o6", 0, False, None, "o6a", None), ("o6", d, False, "new", "o6b", None), ("o6", 2 * d, True, None, "o6c", 1),
    ]
    expect = replay(rows)
    for chunk in (3_600_000, d, 7 * d):
        assert run(spark, rows, chunk) == expect
    assert expect == {"o1b": "new", "o2c": "new", "o4b": "settle.one", "o6c": "new"}


def test_random_against_replay(spark):
    rnd = random.Random(7)
    rows = []
    types = ["new", "settle.one", None]
    for i in range(1500):
        order = f"o{rnd.randint(0, 40)}"
        ts = rnd.randint(0, 60) * 43_200_000 + rnd.randint(0, 3) * 1000
        if rnd.random() < 0.5:
            rows.append((order, ts, False, rnd.choice(types), f"r{i:05d}", None))
        else:
            rows.append((order, ts, True, None, f"r{i:05d}", rnd.randint(1, 100)))
    expect = replay(rows)
    for chunk in (3_600_000, 86_400_000, 10 * 86_400_000):
        assert run(spark, rows, chunk) == expect


def test_hot_order_across_chunks(spark):
    """One order holds most rows and spans many chunks: same answer as the
    replay, whatever the chunk width."""
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        ts = i * 3_000_000 + rnd.randint(0, 1000)
        if i % 97 == 0:
            rows.append(("hot", ts, False, rnd.choice(["new", "settle.two"]), f"h{i:05d}", None))
        elif i % 13 == 0:
            rows.append(("hot", ts, False, None, f"h{i:05d}", None))
        else:
            rows.append(("hot", ts, True, None, f"h{i:05d}", 1))
    rows += [("cold", 0, False, "new", "c0", None), ("cold", 1, True, None, "c1", 2)]
    expect = replay(rows)
    assert len(expect) > 100
    assert run(spark, rows, 3_600_000) == expect


def test_hot_hours_are_cut_by_rows(spark):
    """Hours with many rows, also at one time, are cut into ranges: same answer."""
    rnd = random.Random(11)
    rows = [(f"o{i % 3}", rnd.choice([0, 500, 500, 500, 1000, TTL, 2 * TTL + 7]), rnd.random() < 0.7, None, f"r{i:05d}", i) for i in range(2000)]
    rows = [(o, ts, loan, None if loan or rnd.random() < 0.5 else rnd.choice(["new", "old"]), i, a) for o, ts, loan, _, i, a in rows]
    expect = replay(rows)
    assert len(expect) > 300
    for limit in (7, 100, 5000):
        assert run(spark, rows, 3_600_000, chunk_rows=limit) == expect


def test_a_million_rows_of_one_order_in_a_minute(spark):
    n, limit = 1_000_000, 100_000
    k = F.col("id")
    events = spark.range(n, numPartitions=4).select(
        F.lit("hot").alias("order_id"), (k * 7 % 60_000).alias("ts"), (k % 10 != 0).alias("is_loan"),
        F.when(k % 20 == 0, F.concat(F.lit("t"), (k % 7).cast("string"))).alias("type"),
        F.lpad(k.cast("string"), 9, "0").alias("rec_id"), k.alias("amount"))
    sizes = [r["count"] for r in chunked(events, chunk_rows=limit).groupBy("order_id", "chunk").count().collect()]
    assert sum(sizes) == n and max(sizes) < 2 * limit
    got = asof_type(events, chunk_rows=limit).groupBy("type").agg(F.count(F.lit(1)), F.sum("amount"), F.sum(F.xxhash64("rec_id") % 1000)).collect()
    last, want = None, {}
    ts = [(i * 7 % 60_000, i % 10 != 0, i) for i in range(n)]
    for _, loan, i in sorted(ts):
        if not loan:
            last = f"t{i % 7}" if i % 20 == 0 else last
        elif last is not None:
            c, total = want.get(last, (0, 0))
            want[last] = (c + 1, total + i)
    assert {r[0]: (r[1], r[2]) for r in got} == want
