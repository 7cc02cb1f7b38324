"""Counter store: idempotent batches, current values, retention, lookup."""

import datetime as dt
import os

from pyspark.sql import functions as F

from creditpulse.session import scratch_path
from creditpulse.sinks import counters as store


def deltas(spark, rows):
    return spark.createDataFrame(rows, "metric string, field string, day string, value bigint")


def test_add_deltas_is_idempotent(spark):
    root = scratch_path(spark, "test-store")
    b0 = deltas(spark, [("risk_level", "max.count", "2017-06-14", 2), ("daily_apply_count", "", "2017-06-14", 5)])
    b1 = deltas(spark, [("risk_level", "max.count", "2017-06-14", 3)])
    store.add_deltas(b0, root, 0)
    store.add_deltas(b1, root, 1)
    store.add_deltas(b1, root, 1)  # retried batch
    cur = {(r.metric, r.field): r.value for r in store.read_counters(spark, root).collect()}
    assert cur == {("risk_level", "max.count"): 5, ("daily_apply_count", ""): 5}
    fam = {r.family for r in store.read_counters(spark, root).collect()}
    assert fam == {"bamdata.RiskLevel", "generalApply_CreditLoan.totalOneDay"}


def test_expire_boundary(spark):
    as_of = dt.datetime(2017, 7, 20, 12, 0, 0)
    limit = as_of - dt.timedelta(days=32)
    rows = [("d1", "f1", limit), ("d2", "f2", limit + dt.timedelta(seconds=1)), ("d3", "f3", limit - dt.timedelta(seconds=1))]
    df = spark.createDataFrame(
        [("", "m", fam, "", day, 1, w) for day, fam, w in rows],
        "namespace string, metric string, family string, field string, day string, value bigint, written_at timestamp_ntz")
    kept = sorted(r.day for r in store.expire(df, as_of.strftime("%Y-%m-%d %H:%M:%S")).collect())
    assert kept == ["d2"]


def test_lookup_map(spark):
    df = spark.createDataFrame([("bamdata.RiskLevel", "d", "max.count", 2), ("bamdata.RiskLevel", "d", "min.count", 1),
                                ("bamdata.system", "d", "pass.count", 9)], "family string, day string, field string, value bigint")
    m = store.lookup_map(df, "bamdata.RiskLevel").first()
    assert m.day == "d" and dict(m.fields) == {"max.count": 2, "min.count": 1}


def current(spark, root):
    return {(r.metric, r.day): r.value for r in store.read_counters(spark, root).collect()}


def folders(root, writer="counts"):
    path = os.path.join(root.removeprefix("file:"), f"writer={writer}")
    return sorted(d.removeprefix("since=") for d in os.listdir(path) if d.startswith("since="))


def test_folding_keeps_values_and_bounds_the_store(spark):
    root = scratch_path(spark, "test-fold")
    a, b, c = "2017-06-14", "2017-06-15", "2017-06-16"
    for i in range(4):
        store.add_deltas(deltas(spark, [("risk_level", "max.count", a, i), ("daily_apply_count", "", b, 1)]), root, i)
    store.add_deltas(deltas(spark, [("daily_apply_count", "", b, 50)]), root, 0, writer="types")  # another writer's batch 0
    store.add_deltas(deltas(spark, [("daily_apply_count", "", c, 7)]), root, 3)
    want = {("risk_level", a): 6, ("daily_apply_count", b): 54, ("daily_apply_count", c): 7}
    assert current(spark, root) == want
    for _ in range(2):  # batch 4 is run twice: what came before it is folded, it counts once
        store.fold(spark, root, 4)
        store.add_deltas(deltas(spark, [("risk_level", "max.count", a, 10)]), root, 4)
        assert current(spark, root) == want | {("risk_level", a): 16}
    rows = store.increments(spark, root).where("writer = 'counts'")
    assert rows.where(F.col("day") == b).count() == 1 and rows.where((F.col("day") == a) & (F.col("batch") < 4)).count() == 1
    assert store.read_counters(spark, scratch_path(spark, "nothing-yet")).count() == 0


def test_running_totals_replace_each_other(spark):
    root = scratch_path(spark, "test-running")
    store.add_deltas(deltas(spark, [("risk_level", "max.count", "d", 2)]), root, 9)
    for i, v in enumerate((3, 5, 4)):
        for _ in range(2):  # a batch that is run again finds its first rows, which a fold drops
            if i == 2:
                store.fold(spark, root, 2, writer="totals")
            store.write_totals(deltas(spark, [("sub_apply_count", "120000", "d", v)]), root, i)
    assert current(spark, root) == {("sub_apply_count", "d"): 4, ("risk_level", "d"): 2}


def test_expired_days_are_gone(spark):
    root = scratch_path(spark, "test-expiry")
    rows = spark.createDataFrame([("daily_apply_count", "", "2017-01-01", 1, 1483228800000), ("daily_apply_count", "", "2017-06-14", 2, 1497398400000),
                                  ("city_apply_count", "x", "2017-06-14", 2, 1483228800000)],
                                 "metric string, field string, day string, value bigint, at bigint")
    store.add_deltas(rows, root, 0, clock_ms="at")
    assert folders(root) == ["2017-01-01", "2017-06-14"]
    assert store.remove_expired(spark, root, "2017-06-20 00:00:00") == ["2017-01-01"]
    assert folders(root) == ["2017-06-14"]
    assert len(current(spark, root)) == 2  # a counter that is past its time on a day that lives is left out when read:
    assert [r.metric for r in store.expire(store.read_counters(spark, root), "2017-06-20 00:00:00").collect()] == ["daily_apply_count"]
    wide = scratch_path(spark, "test-expiry-wide")
    store.add_deltas(rows, wide, 0, clock_ms="at", period_days=32)
    assert len(folders(wide)) == 2 and len(store.remove_expired(spark, wide, "2017-06-20 00:00:00")) == 1


def test_lookup_of_a_day_reads_its_partition(spark):
    for days in (1, 32):
        root = scratch_path(spark, "test-day")
        rows = [("risk_level", "max.count", f"2017-{m:02d}-14", m) for m in range(1, 13)]
        store.add_deltas(deltas(spark, rows), root, 0, period_days=days)
        found = store.lookup(store.read_counters(spark, root), "bamdata.RiskLevel", "2017-06-14", days)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(since" in plan
        assert [tuple(r) for r in found.collect()] == [("2017-06-14", "max.count", 6)]


def test_lookup_filter_reaches_the_scan(spark):
    root = scratch_path(spark, "test-lookup")
    store.add_deltas(deltas(spark, [("risk_level", "max.count", "d", 2), ("risk_k_score", "0", "d", 1)]), root, 0)
    found = store.lookup(store.read_counters(spark, root), "bamdata.RiskLevel")
    assert "PushedFilters: [IsNotNull(metric), EqualTo(metric,risk_level)" in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("d", "max.count", 2)]


def test_restatement(spark):
    for period_days in (1, 32):
        root = scratch_path(spark, "test-restate")
        rows = [("daily_apply_count", "", d, 5) for d in ("2017-06-13", "2017-06-14", "2017-06-15")] + [("city_apply_count", "x", "2017-06-14", 2)]
        store.add_deltas(deltas(spark, rows), root, 0, period_days=period_days)
        store.add_deltas(deltas(spark, [("RISK_CUSTOMER_DISTRIBUTION", "new.amount", "2017-06-14", 8)]), root, 0, writer="types", period_days=period_days)
        new = deltas(spark, [("daily_apply_count", "", "2017-06-14", 9), ("daily_apply_count", "", "2017-06-15", 1)])
        for _ in range(2):
            store.restate_store(new, root, "2017-06-14", ["daily_apply_count", "city_apply_count"], period_days=period_days)
            assert current(spark, root) == {("daily_apply_count", "2017-06-14"): 9, ("daily_apply_count", "2017-06-15"): 5,
                                            ("RISK_CUSTOMER_DISTRIBUTION", "2017-06-14"): 8}
    one_day = scratch_path(spark, "test-restate-day")
    store.add_deltas(deltas(spark, rows[:3]), one_day, 0)
    store.restate_store(new.where("false"), one_day, "2017-06-14", ["daily_apply_count"])
    assert folders(one_day) == ["2017-06-15"]  # nothing is left of the two days


def test_pointers_are_set_once(spark):
    at = scratch_path(spark, "test-pointers")
    put = lambda *rows: store.put_pointers(spark.createDataFrame(rows, "source string, cutover_ms bigint"), at)
    put(("a", 5), ("c", 1))
    put(("a", 3), ("b", 7), ("b", 6))  # a's is kept
    put(("a", 9))
    assert {(r.source, r.cutover_ms) for r in store.read_pointers(spark, at).collect()} == {("a", 5), ("b", 6), ("c", 1)}
    many = scratch_path(spark, "test-many-pointers")
    for _ in range(2):
        store.put_pointers(spark.range(5000).select(F.concat(F.lit("type"), "id").alias("source"), F.col("id").alias("cutover_ms")), many)
    assert store.read_pointers(spark, many).count() == 5000


def test_counters_are_read_without_sorting_them(spark):
    root = scratch_path(spark, "test-hash")
    store.add_deltas(deltas(spark, [("risk_level", "max.count", "2017-06-14", 2), ("other", "", "2017-06-14", 1)]), root, 0)
    counters = store.read_counters(spark, root)
    assert "SortAggregate" not in counters._jdf.queryExecution().executedPlan().toString()
    assert {(r.metric, r.family) for r in counters.collect()} == {("risk_level", "bamdata.RiskLevel"), ("other", None)}
