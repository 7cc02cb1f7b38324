"""Graph export operators."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditpulse.operators import graph as G
from creditpulse.session import scratch_path
from creditpulse.sinks.csvout import file_numbers, read_csv, write_csv


def small_graph(spark):
    v = spark.createDataFrame([
        ("c:1", "customer", '{"name":"ann","seg":"A"}'), ("c:2", "customer", '{"name":"bob","seg":"B"}'),
        ("o:1", "orders", '{"st":"F"}'), ("o:2", "orders", "not json"), ("p:1", "part", '{"pn":"bolt"}'),
    ], "id string, label string, props string")
    e = spark.createDataFrame([
        ("c:1", "o:1", "placed", "{}"), ("c:2", "o:2", "placed", "{}"), ("o:1", "p:1", "contains", '{"ln":1}'),
        ("o:2", "p:1", "contains", '{"ln":2}'),
    ], "src string, dst string, label string, props string")
    return v, e


def test_match_filter_project(spark):
    v, e = small_graph(spark)
    paths = G.match(v, e, "a:customer-e1:placed->b:orders-e2:contains->c:part")
    assert paths.count() == 2
    keys = spark.createDataFrame([("c:1",), ("",)], "key string")
    kept = G.match(v, e, "a:customer-e1:placed->b:orders", start=G.filter_by_keys(v, keys, "id"))
    assert [r.b_id for r in kept.collect()] == ["o:1"]
    fields = [("a_id", "vertex"), ("a.name", "edge"), ("b.st", "edge"), ("a.seg", "edge")]
    rows, rejects = G.project_entities(paths, fields)
    assert rows.columns == ["a_id", "a_name", "a_seg", "b_st"]
    assert [tuple(r) for r in rows.collect()] == [("c:1", "ann", "A", "F")]
    assert rejects.count() == 1


def test_key_filter_without_broadcast(spark):
    v, _ = small_graph(spark)
    keys = spark.createDataFrame([("c:2",)], "key string")
    assert [r.id for r in G.filter_by_keys(v, keys, "id").collect()] == ["c:2"]


def test_fields_and_keys_on_any_alias(spark):
    v, e = small_graph(spark)
    pattern, fields = "a:customer-e1:placed->b:orders-e2:contains->c:part", [("a_id", "vertex"), ("a.name", "edge"), ("b.st", "edge"), ("e2.ln", "edge")]
    rows, rejects = G.match_fields(v, e, pattern, fields)
    assert [tuple(r) for r in rows.collect()] == [("c:1", "ann", "F", "1")] and [r.a_id for r in rejects.collect()] == ["c:2"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    joins = [i for i, x in enumerate(plan.split("\n")) if "Join" in x]
    parses = [i for i, x in enumerate(plan.split("\n")) if "from_json" in x]
    assert len(parses) == 3 and min(parses) > min(joins)  # below the joins
    keys = spark.createDataFrame([("bob",), ("c:2",), ("2",), ("p:1",), (" ",)], "key string")
    found = lambda on: sorted(r.a_id for r in G.match_fields(v, e, "a:customer-e1:placed->b:orders-e2:contains->c:part", [("a_id", "vertex")], keys, on)[0].collect())
    assert found("a.name") == found("a_id") == found(None) == found("e2.ln") == ["c:2"]
    assert found("c_id") == ["c:1", "c:2"] and found("b_id") == []


def test_deep_pages_read_their_range_only(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_000).alias("k"), F.lit("").alias("s"))
    pages = G.Pages(df, ["k"], partitions=20)
    assert pages.page(0, 1).columns == ["k", "s"] and len(pages.before) > 10
    for start, size in [(0, 4), (3, 4), (9_000, 50), (9_990, 50), (20_000, 5), (700, 2_000)]:
        assert [r.k for r in pages.page(start, size).collect()] == list(range(start, min(start + size, 10_000)))
    a, b = pages.before[pages.ranges(9_000, 1)[0]]
    assert len(pages.ranges(9_000, 1)) == 1 and b - a < 2_000
    plan = pages.page(9_000, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_range" in plan
    assert G.Pages(df.where("false"), ["k"]).page(0, 5).count() == 0


def test_any_of_several_conditions(spark):
    rows = [("c:1", "p:10", "5"), ("c:2", "p:2", "x"), ("c:3", "p:3", "17"), ("c:4", "q", None), ("c:1", "p:10", "5"), ("c:5", None, "29")]
    df = spark.createDataFrame(rows, "a string, b string, n string")
    keys = spark.createDataFrame([("c:2",), ("c:2",), (" ",), (None,)], "key string")
    prefixes = spark.createDataFrame([("p:1",), ("p:10",), ("",)], "key string")
    ranges = spark.createDataFrame([(10, 18), (15, 30), (30, 30), (40, 5)], "low int, high int")
    found = G.filter_by_any(df, [("a", "equal", keys), ("b", "prefix", prefixes), ("n", "range", ranges)], bin_width=4)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([rows[0], rows[1], rows[2], rows[4], rows[5]], key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    none = spark.createDataFrame([], "key string")
    assert G.filter_by_any(df, [("a", "equal", none), ("b", "prefix", none)]).count() == 0


def test_a_column_of_few_values_does_not_deal_out_the_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("n"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        found = G.filter_by_any(df, [("n", "range", spark.createDataFrame([(1, 3)], "low int, high int"))])
        assert found.count() == 666 and "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(key)


def test_json(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.lit("").alias("s"))
    js = df.select(G.row_json("k", "s", drop_empty=True).alias("j")).orderBy("k" if False else "j").first().j
    assert js == '{"k":0}'
    back = spark.createDataFrame([('{"k":5}',)], "j string").select(G.json_row("j", "k bigint, s string").alias("r")).first().r
    assert back.k == 5 and back.s is None


def test_csv_rolls_by_bytes_and_refuses_existing(spark):
    text = F.when(F.col("id") % 3 == 0, "x,y").when(F.col("id") % 3 == 1, 'say "é"').otherwise(F.repeat(F.lit("w"), (F.col("id") % 50).cast("int")))
    df = spark.range(3000).select(F.col("id").cast("string").alias("a"), text.alias("b c")).repartition(2)
    path, limit = scratch_path(spark, "test-csv"), 4000
    write_csv(df, path, file_mb=limit / 1024 / 1024)
    sizes = {}
    for f in glob.glob(path.replace("file:", "") + "/file=*/*.txt"):
        sizes.setdefault(f.split("file=")[1][:6], []).append(os.path.getsize(f))
    assert len(sizes) == 2 and all(len(x) > 5 for x in sizes.values())
    for own in sizes.values():  # all of a task's files but its last are full, and one line above the limit at most
        assert sum(s < limit for s in own) <= 1 and max(own) < limit + 70
    back = read_csv(spark, path, df.columns)
    assert sorted(map(tuple, back.collect())) == sorted((a, b or None) for a, b in df.collect())
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_csv(df, path)


def test_file_numbers():
    sizes = np.array([3, 3, 3, 10, 1, 1])
    whole = file_numbers(sizes, 5, 0, 0)
    assert whole[0].tolist() == [0, 0, 1, 1, 2, 2] and whole[1:] == (2, 2)
    number, used, parts = 0, 0, []
    for i in range(6):
        files, number, used = file_numbers(sizes[i:i + 1], 5, number, used)
        parts += files.tolist()
    assert parts == whole[0].tolist() and file_numbers(sizes[:0], 5, 4, 2)[1:] == (4, 2)
