"""Plan-shape guards: one JSON parse per record, pushdown into detail scans,
no data-sized broadcast."""

from pyspark.sql import functions as F

from creditpulse.operators import catalogue as cat
from creditpulse.operators.rules import split_errors
from creditpulse.plans import backfill as bf
from creditpulse.plans import live, queries
from creditpulse.session import scratch_path
from creditpulse.sources import fixtures as fx
from creditpulse.sources.detail import read_parquet


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_parse_even_with_time_and_error_filters(spark, sf_small):
    logs = fx.logs(spark, sf_small)
    good, bad = split_errors(live.output_rows(logs))
    late = good.where(F.col("collect_ms") >= 10).where(F.col("kind") == "loan")
    for df in (live.metric_totals(logs, with_types=False), late, bad):
        # One parse; the second, without payload, is under a condition: for texts that the first cannot read.
        assert optimized(df).count("from_json(") == 2


def test_events_of_one_row_group_are_dealt_out(spark, tmp_path):
    rows = spark.createDataFrame([(i % 7 or None, i, "purchase", 1.5) for i in range(60)] * 2, "event_id bigint, i int, event_type string, value double")
    rows = rows.withColumn("ts", F.expr("timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(i)")).drop("i")
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # so few rows would be one partition
    spark.conf.set(key, "false")
    try:
        logs = fx.fund_logs(spark, str(tmp_path))
        assert logs.where(F.col("key").isNotNull()).select(F.spark_partition_id()).distinct().count() > 1
        assert logs.count() == 120
    finally:
        spark.conf.unset(key)


def test_detail_range_and_columns_reach_the_scan(spark, sf_small):
    path = scratch_path(spark, "detail") + "/apply"
    fx.detail_apply(spark, sf_small).write.parquet(path)
    detail = read_parquet(spark, path, ["applyamt", "collecttimefmt", "belongprovince", "belongcity"])
    rows = bf.apply_rows(detail, "1995-01-01 00:00:00", "1996-01-01 00:00:00")
    key = "spark.sql.maxMetadataStringLength"  # show the whole filter list
    spark.conf.set(key, "1000")
    try:
        plan = executed(bf.daily_totals(rows, "daily_apply_count", "daily_apply_amount"))
    finally:
        spark.conf.unset(key)
    assert "PushedFilters: [IsNotNull(collecttimefmt), GreaterThanOrEqual(collecttimefmt,1995-01-01 00:00:00)" in plan
    assert "LessThan(collecttimefmt,1996-01-01 00:00:00)" in plan
    assert "ReadSchema: struct<applyamt:string,collecttimefmt:string>" in plan


def test_only_fixed_size_broadcast(spark, sf_small):
    names = live.metric_totals(fx.logs(spark, sf_small, ["wealth"]), kinds=["wealth"]).join(
        F.broadcast(cat.catalogue_df(spark)), "metric")
    assert "BroadcastExchange" in executed(names)


def test_run_batch_one_parse_two_outputs(spark, sf_small):
    from creditpulse.sinks import counters as store

    logs = fx.logs(spark, sf_small)
    root, dead = scratch_path(spark, "batch-counters"), scratch_path(spark, "batch-dead")
    live.run_batch(logs, root, dead, batch_id=0)
    live.run_batch(logs, root, dead, batch_id=0)  # a rerun of the same batch changes nothing
    got = {(r.metric, r.field, r.day): r.value for r in store.read_counters(spark, root).collect()}
    want = {(r.metric, r.field, r.day): r.value for r in live.metric_totals(logs).collect()}
    assert got == want
    _, bad = split_errors(live.output_rows(logs))
    assert spark.read.parquet(dead).count() == bad.count() > 0


def test_backfill_reads_each_table_once(spark, sf_small):
    path = scratch_path(spark, "details")
    details = {"apply": fx.detail_apply, "loan": fx.detail_loan, "fund": fx.detail_fund, "wealth": fx.detail_wealth}
    for name, make in details.items():
        make(spark, sf_small).write.parquet(f"{path}/{name}")
    total = bf.backfill(*(spark.read.parquet(f"{path}/{n}") for n in details), start="1995-01-01 00:00:00", end="1996-01-01 00:00:00")
    assert executed(total).count("FileScan parquet") == 4


def test_loan_metrics_parses_once(spark, sf_small):
    assert "from_json(" not in optimized(queries.loan_metrics(spark, sf_small))  # the records are read back
