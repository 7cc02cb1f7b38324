"""Named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each one reads the driver tables (or data Spark derives from them) in
full; the only fixed values are the business parameters below (a cut-over
time, a restate day, a retention clock, a page), which are what the
operators under test take as arguments.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditpulse.functions.envelope import parse_envelope, payload
from creditpulse.functions.text import is_blank
from creditpulse.functions.timefn import ms_to_text
from creditpulse.operators import catalogue as cat
from creditpulse.operators.asof import asof_type
from creditpulse.operators.graph import Pages, filter_by_any, json_row, row_json
from creditpulse.operators.rollup import row_counts, sum_deltas, union_all
from creditpulse.operators.rules import CUSTOMER_LABELS, explode_deltas, generate_where, outputs, split_errors
from creditpulse.plans import backfill as bf
from creditpulse.plans import export as ex
from creditpulse.plans import live
from creditpulse.sinks import counters as store
from creditpulse.sinks.csvout import read_csv, write_csv
from creditpulse.sinks.deadletters import write_dead_letters
from creditpulse.session import materialised, scratch_path
from creditpulse.sources import fixtures as fx
from creditpulse.sources.keys import read_keys

TZ = "UTC"
# Business parameters of the registered queries.
CUTOVER_TEXT = "1996-06-01 00:00:00"
DETAIL_RANGE = ("1994-01-01 00:00:00", "1997-01-01 00:00:00")
RESTATE_DAY = "1996-06-01"
RETENTION_AS_OF = "1998-06-01 00:00:00"
PAGE_START, PAGE_SIZE = 1000, 500
NAMESPACE_TEST = "_test"
TTL_MS = 5 * 86_400_000
#: The fixtures' history of seven years goes into the store at once.
PERIOD_DAYS = 32


def _ms(text: str) -> int:
    t = dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=dt.timezone.utc)
    return int(t.timestamp() * 1000)


CUTOVER_MS = _ms(CUTOVER_TEXT)


# --- live metrics ------------------------------------------------------------


def _totals(kinds, metrics, with_types=False):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        logs = fx.logs(spark, sf_dir, kinds)
        return live.metric_totals(logs, TZ, kinds=kinds, metrics=metrics, with_types=with_types)

    return q


def all_metrics(spark, sf_dir):
    """Flagship: every fixture, every family, customer types included."""
    return live.metric_totals(fx.logs(spark, sf_dir), TZ)


def loan_metrics(spark, sf_dir):
    logs = fx.logs(spark, sf_dir, ["loan", "risk"])
    recs = live.slim(live.classified(logs, TZ, kinds=["loan", "risk"]))
    is_loan = F.col("kind") == "loan"
    recs = materialised(recs.withColumn("out", F.when(is_loan, F.col("out"))), "records")  # of a risk record its touch only
    good, _ = split_errors(outputs(recs.where(is_loan)))
    typed = live.typed_deltas(asof_type(live.type_rows(recs)))
    return sum_deltas(explode_deltas(good).unionByName(typed.drop("collect_ms")))


def route_counts(spark, sf_dir):
    """FL-2 + AG-7: records per kind and status."""
    recs = live.classified(fx.logs(spark, sf_dir), TZ)
    rows = generate_where(recs, F.lit(True), [
        F.col("kind").alias("kind"),
        F.when(F.col("err").isNull(), "good").otherwise("bad").alias("status"),
    ])
    return row_counts(rows, "kind", "status")


def good_bad_split(spark, sf_dir):
    """FL-1 / FM-9: bad records per kind and reason."""
    _, bad = split_errors(live.output_rows(fx.logs(spark, sf_dir), TZ))
    return row_counts(bad, "kind", F.col("err").alias("reason"))


def dead_letters(spark, sf_dir):
    """SNK-3: bad records written as dead letters and read back (without the
    write time): task, reason, record key, and fields of the stored raw text."""
    path = scratch_path(spark, "dead-letters")
    recs = live.slim(live.classified(fx.logs(spark, sf_dir), TZ))
    write_dead_letters(live.dead_rows(recs), path, batch_id=0)
    return letter_fields(spark.read.parquet(path))


def letter_fields(letters: DataFrame) -> DataFrame:
    """Stored dead letters with two fields of their raw text, null if it is no JSON."""
    raw = F.from_json("json", "logNo STRING, collectTime STRING, _corrupt_record STRING", {"columnNameOfCorruptRecord": "_corrupt_record"})
    return letters.withColumn("raw", raw).withColumn("sound", F.col("raw._corrupt_record").isNull()).select(
        "task_name", "exception_info", "record_key", F.when(F.col("sound"), F.col("raw.logNo")).alias("log_no"),
        F.when(F.col("sound"), F.col("raw.collectTime")).alias("time_text"))


APPLY_FIELDS = ["lbsProvince", "belongProvince", "lbsCity", "belongCity", "applyamt", "channelcode", "channelsource"]


def blank_fields(spark, sf_dir):
    """SC-1 over the apply payload: blank values per field."""
    parsed = parse_envelope(fx.logs(spark, sf_dir, ["apply"]), tz=TZ)
    arr = F.array(*[F.struct(F.lit(f).alias("field"), is_blank(payload(f)).cast("int").alias("b")) for f in APPLY_FIELDS])
    return parsed.select(F.inline(arr)).groupBy("field").agg(F.sum("b").cast("bigint").alias("blanks"))


def payload_fields(spark, sf_dir):
    """SC-2/SC-3: audit payload fields read back out of the JSON envelope."""
    parsed = parse_envelope(fx.logs(spark, sf_dir, ["audit"]), tz=TZ)
    return parsed.select(
        F.col("key").alias("record_key"), F.col("log_no").alias("log_no"), "collect_ms", "day",
        payload("APPROVE_TYPE").alias("approve_type"), payload("A_RESULT").alias("a_result"),
        payload("A_REJECT_CODE").alias("a_reject_code"),
    )


# --- JN-1 --------------------------------------------------------------------


def type_events_fixture(spark, sf_dir) -> DataFrame:
    """FX-TYPE-EVENTS: type touches and loans of every order."""
    b = fx.base_orders(spark, sf_dir)
    risk = fx.risk_flat(b)
    code = F.col("Z_RESERVED_CHAR5")
    order = F.col("ORDER_ID")
    label = F.create_map(*[x for c, lb in CUSTOMER_LABELS for x in (F.lit(c), F.lit(lb))])
    ms0 = F.col("ms") - 60000
    k = F.col("k")
    touches = union_all([
        risk.where(~is_blank(code) & ~is_blank(order)).select(
            order.alias("order_id"), F.col("ms").alias("ts"), label[code].alias("type"), (k * 10).alias("id")),
        risk.where((k % 4 == 0) & (k % 19 != 0)).select(
            order.alias("order_id"), (ms0 + 4 * fx.DAY_MS).alias("ts"), label[F.lit("X9")].alias("type"), (k * 10 + 1).alias("id")),
        risk.where((k % 6 == 0) & (k % 19 != 0)).select(
            order.alias("order_id"), (ms0 + 3 * fx.DAY_MS).alias("ts"), F.lit("new").alias("type"), (k * 10 + 2).alias("id")),
    ]).select("order_id", "ts", F.lit(False).alias("is_loan"), "type", "id", F.lit(None).cast("bigint").alias("amount"))
    loans = fx.loan_flat(b).where(F.col("orderId").isNotNull() & F.col("capitalAmount").isNotNull()).select(
        F.col("orderId").alias("order_id"), F.col("ms").alias("ts"), F.lit(True).alias("is_loan"),
        F.lit(None).cast("string").alias("type"), (k * 10 + 3).alias("id"), F.col("capitalAmount").cast("bigint").alias("amount"),
    )
    return touches.unionByName(loans)


def loan_type_asof(spark, sf_dir):
    """JN-1 batch form on FX-TYPE-EVENTS: loans and amount per live type."""
    ev = type_events_fixture(spark, sf_dir).withColumn("rec_id", F.lpad(F.col("id").cast("string"), 20, "0"))
    typed = asof_type(ev.drop("id"), ttl_ms=TTL_MS)
    return typed.groupBy("type").agg(F.count(F.lit(1)).alias("loans"), F.sum("amount").cast("bigint").alias("amount"))


# --- backfill ------------------------------------------------------------------


def _details(spark, sf_dir):
    return (fx.detail_apply(spark, sf_dir, TZ), fx.detail_loan(spark, sf_dir, TZ),
            fx.detail_fund(spark, sf_dir, TZ), fx.detail_wealth(spark, sf_dir, TZ))


def detail_time_range(spark, sf_dir):
    """SRC-3 + FL-3: apply detail rows in a half-open range, normalised."""
    rows = bf.apply_rows(fx.detail_apply(spark, sf_dir, TZ), *DETAIL_RANGE)
    return rows.select("amount", "ts_text", "province", "city", "err")


def backfill_apply_daily(spark, sf_dir):
    return bf.daily_totals(bf.apply_rows(fx.detail_apply(spark, sf_dir, TZ)), "daily_apply_count", "daily_apply_amount")


def backfill_loan_daily(spark, sf_dir):
    return bf.daily_totals(bf.loan_rows(fx.detail_loan(spark, sf_dir, TZ)), "daily_loan_count", "daily_loan_amount")


def backfill_two_minute(spark, sf_dir):
    a = bf.apply_rows(fx.detail_apply(spark, sf_dir, TZ))
    ln = bf.loan_rows(fx.detail_loan(spark, sf_dir, TZ))
    return bf.bucket_totals(a, "sub_apply_count", "sub_apply_amount", TZ).unionByName(
        bf.bucket_totals(ln, "sub_loan_count", "sub_loan_amount", TZ))


def backfill_area(spark, sf_dir):
    return bf.area_totals(bf.apply_rows(fx.detail_apply(spark, sf_dir, TZ)))


def backfill_fund_daily(spark, sf_dir):
    return bf.fund_totals(fx.detail_fund(spark, sf_dir, TZ))


def backfill_wealth_daily(spark, sf_dir):
    return bf.wealth_totals(fx.detail_wealth(spark, sf_dir, TZ))


def backfill_total_daily(spark, sf_dir):
    return bf.combined_totals(bf.fund_totals(fx.detail_fund(spark, sf_dir, TZ)),
                              bf.wealth_totals(fx.detail_wealth(spark, sf_dir, TZ)))


def lambda_merge(spark, sf_dir):
    """ST-1: backfill before the cut-over + live deltas from it on."""
    hist = bf.backfill(*_details(spark, sf_dir), start=None, end=CUTOVER_TEXT, tz=TZ)
    kinds = ["apply", "loan", "fund", "wealth"]
    good, _ = split_errors(live.output_rows(fx.logs(spark, sf_dir, kinds), TZ, kinds=kinds))
    recent = good.where(F.col("collect_ms") >= F.lit(CUTOVER_MS)).where(F.col("metric").isin(cat.BACKFILL_METRICS))
    return bf.merge_live(hist, recent)


def _pointers(spark, sf_dir) -> DataFrame:
    """SM-7 + ST-3: each record type's first time put as its pointer, and then its
    last time, which changes nothing."""
    root = scratch_path(spark, "pointers")
    parsed = parse_envelope(fx.logs(spark, sf_dir), tz=TZ).where(F.col("collect_ms").isNotNull())
    times = materialised(parsed.groupBy(F.col("log_no").alias("source")).agg(
        F.min("collect_ms").alias("first"), F.max("collect_ms").alias("last")), "times")
    for ms in ("first", "last"):
        store.put_pointers(times.select("source", F.col(ms).alias("cutover_ms")), root)
    return store.read_pointers(spark, root)


def cutover_points(spark, sf_dir):
    """SM-7 + ST-3: the set of stored pointers."""
    return _pointers(spark, sf_dir)


def cutover_min(spark, sf_dir):
    """AG-6: the earliest stored pointer is the cut-over."""
    m = bf.min_cutover(_pointers(spark, sf_dir))
    return m.select("cutover_ms", ms_to_text(F.col("cutover_ms"), TZ).alias("cutover_text"))


def restate_days(spark, sf_dir):
    """SM-8 + SC-12: in the counter store, the clean families of a day and the
    day before replaced by their recomputation from detail tables."""
    root = scratch_path(spark, "restated")
    store.add_deltas(live.all_deltas(fx.logs(spark, sf_dir), TZ), root, 0, period_days=PERIOD_DAYS)
    start, end = bf.restate_range(RESTATE_DAY)
    hist = bf.backfill(*_details(spark, sf_dir), start=start, end=end, tz=TZ)
    store.restate_store(hist, root, RESTATE_DAY, cat.CLEAN_METRICS, period_days=PERIOD_DAYS)
    return store.read_counters(spark, root).select("metric", "field", "day", "value")


# --- counter store -------------------------------------------------------------


def _store(spark, sf_dir, cuts=(CUTOVER_MS,), period_days: int = PERIOD_DAYS) -> str:
    """All deltas added to a fresh store, a batch for the records before each of
    ``cuts`` and one for the rest. ``written_at`` is the event time of the newest
    record of the key (the store's clock in a replay)."""
    root = scratch_path(spark, "counters")
    deltas = live.all_deltas(fx.logs(spark, sf_dir), TZ)
    at = F.col("collect_ms")
    for batch_id, (a, b) in enumerate(zip([None, *cuts], [*cuts, None])):
        rows = deltas.where((at >= a) if a is not None else F.lit(True)).where((at < b) if b is not None else F.lit(True))
        store.add_deltas(rows, root, batch_id, clock_ms="collect_ms", period_days=period_days)
    return root


def counters_current(spark, sf_dir):
    """SNK-1/2 + FL-6: current counters with family names."""
    return store.read_counters(spark, _store(spark, sf_dir)).select("family", "field", "day", "value")


def counters_retained(spark, sf_dir):
    """SNK-5, a partition a day: the folders of expired days removed; of the days
    left, the counters still alive 32 days after their last write."""
    root = _store(spark, sf_dir, cuts=(), period_days=1)
    store.remove_expired(spark, root, RETENTION_AS_OF)
    c = store.expire(store.read_counters(spark, root), RETENTION_AS_OF)
    return c.select("family", "field", "day", "value")


def lookup_hash(spark, sf_dir):
    """SNK-6: all fields of the risk-level hash, every day."""
    hashes = store.lookup_map(store.read_counters(spark, _store(spark, sf_dir)), f"{cat.INFIX_BAM}.RiskLevel")
    return hashes.select("day", F.explode("fields").alias("field", "value"))


def lookup_day(spark, sf_dir):
    """SNK-6: one day's high-risk provinces; only that day's folder is read."""
    found = store.lookup(store.read_counters(spark, _store(spark, sf_dir)), f"{cat.INFIX_BAM}.HighRiskArea.province",
                         RESTATE_DAY, PERIOD_DAYS)
    return found.select("field", "value")


def counter_names(spark, sf_dir):
    """SC-22 + SM-10: counter names in the test namespace."""
    totals = live.metric_totals(fx.logs(spark, sf_dir), TZ)
    c = cat.catalogue_df(spark)
    named = totals.join(F.broadcast(c), "metric")
    return named.select(
        cat.counter_name(F.col("grp"), F.col("day"), F.col("suffix"), NAMESPACE_TEST).alias("counter_name"),
        "kind", "field", "value")


# --- graph export --------------------------------------------------------------


def _two_hop_rows(spark, sf_dir, keys=None):
    v, e = ex.graph_tables(spark, sf_dir)
    rows, _ = ex.export(v, e, ex.TWO_HOP, ex.TWO_HOP_FIELDS, keys=keys)
    return rows


def graph_pattern(spark, sf_dir):
    """JN-3, one hop: customer -placed-> order."""
    v, e = ex.graph_tables(spark, sf_dir)
    rows, _ = ex.export(v, e, ex.ONE_HOP, [("a_id", "vertex"), ("a.c_name", "edge"), ("b_id", "vertex"),
                                           ("b.o_orderstatus", "edge"), ("b.o_orderpriority", "edge")])
    return rows


def graph_two_hop(spark, sf_dir):
    """JN-3, two hops: customer -placed-> order -contains-> part."""
    return _two_hop_rows(spark, sf_dir)


def _key_file(spark, sf_dir) -> str:
    """FX-KEYS: ids of customers with a positive balance, with blank lines."""
    path = scratch_path(spark, "keys")
    cust = fx.table(spark, sf_dir, "customer")
    lines = cust.where(F.col("c_acctbal") > 0).select(
        F.inline(F.array(
            F.struct(F.concat(F.lit("c:"), F.col("c_custkey").cast("string")).alias("value")),
            F.struct(F.when(F.col("c_custkey") % 7 == 0, F.lit("  ")).otherwise(F.lit("")).alias("value")),
        )))
    lines.write.mode("overwrite").text(path)
    return path


def key_list_scan(spark, sf_dir):
    """SRC-6: the key file read back, blank lines skipped."""
    return read_keys(spark, _key_file(spark, sf_dir))


def graph_key_filter(spark, sf_dir):
    """JN-2 + FL-5: two-hop paths whose customer is in the key list."""
    return _two_hop_rows(spark, sf_dir, keys=read_keys(spark, _key_file(spark, sf_dir)))


def entity_projection(spark, sf_dir):
    """SC-20: order fields projected out of the vertex JSON."""
    v, _ = ex.graph_tables(spark, sf_dir)
    orders = v.where(F.col("label") == "orders").select(F.col("id").alias("b_id"), F.col("props").alias("b_props"))
    from creditpulse.operators.graph import project_entities
    rows, _ = project_entities(orders, [("b_id", "vertex"), ("b.o_custkey", "edge"), ("b.o_orderstatus", "edge"),
                                        ("b.o_orderpriority", "edge")])
    return rows


def graph_any_key(spark, sf_dir):
    """FL-5, repeated predicate: two-hop paths whose customer is in the key list,
    or whose part's id begins with a key, or whose line number lies in a range."""
    rows = _two_hop_rows(spark, sf_dir)
    prefixes = fx.table(spark, sf_dir, "region").select(F.concat(F.lit("p:1"), F.col("r_regionkey").cast("string")).alias("key"))
    lines = fx.table(spark, sf_dir, "region").select((F.col("r_regionkey") + 6).alias("low"), (F.col("r_regionkey") + 8).alias("high"))
    return filter_by_any(rows, [("a_id", "equal", read_keys(spark, _key_file(spark, sf_dir))), ("c_id", "prefix", prefixes),
                                ("e2_l_linenumber", "range", lines)], bin_width=4)


def csv_round_trip(spark, sf_dir):
    """SNK-4: two-hop export written as size-rolled CSV and read back."""
    rows = _two_hop_rows(spark, sf_dir)
    path = scratch_path(spark, "export") + "/csv"
    write_csv(rows, path, file_mb=1)
    return read_csv(spark, path, rows.columns)


def export_page(spark, sf_dir):
    """SO-1: one page of the two-hop export in path order."""
    return Pages(_two_hop_rows(spark, sf_dir), ["a_id", "b_id", "c_id", "e2_l_linenumber"]).page(PAGE_START, PAGE_SIZE)


def row_to_json(spark, sf_dir):
    """SC-21: customer rows to JSON (empty members dropped) and back."""
    cust = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    js = cust.select(row_json("c_custkey", "c_name", "c_mktsegment", "c_nationkey", drop_empty=True).alias("j"))
    back = js.select(json_row("j", "c_custkey BIGINT, c_name STRING, c_mktsegment STRING, c_nationkey INT").alias("r"))
    return back.select("r.*")


def _registry():
    a, r, au = ["apply"], ["risk"], ["audit"]
    q = {
        "apply_by_province": _totals(a, ["province_apply_count"]),
        "apply_by_city": _totals(a, ["city_apply_count"]),
        "apply_by_channel": _totals(a, ["risk_channel"]),
        "apply_daily": _totals(a, ["daily_apply_count", "daily_apply_amount"]),
        "apply_two_minute": _totals(a, ["sub_apply_count", "sub_apply_amount"]),
        "apply_amounts": _totals(a, ["daily_apply_amount"]),
        "apply_metrics": _totals(a, cat.APPLY_METRICS),
        "loan_metrics": loan_metrics,
        "fund_metrics": _totals(["fund"], cat.FUND_METRICS),
        "wealth_metrics": _totals(["wealth"], cat.WEALTH_METRICS),
        "audit_metrics": _totals(au, cat.AUDIT_METRICS),
        "audit_decisions": _totals(au, ["risk_system_approve", "risk_manual_approve"]),
        "audit_reject_codes": _totals(au, ["risk_reject_code"]),
        "risk_metrics": _totals(r, cat.RISK_METRICS),
        "risk_rule_hits": _totals(r, ["RISK_REJECT_REASON"]),
        "risk_level": _totals(r, ["risk_level"]),
        "risk_area": _totals(r, ["risk_province_count", "risk_city_count"]),
        "risk_decision": _totals(r, ["risk_decision_result"]),
        "risk_score_band": _totals(r, ["risk_credit_score"]),
        "risk_k_score": _totals(r, ["risk_k_score"]),
        "risk_customer_type": _totals(r, ["risk_customer_type_count"]),
        "risk_customer_mix": _totals(r, ["RISK_CUSTOMER_DISTRIBUTION"]),
        "all_metrics": all_metrics,
        "route_counts": route_counts,
        "good_bad_split": good_bad_split,
        "dead_letters": dead_letters,
        "blank_fields": blank_fields,
        "payload_fields": payload_fields,
        "loan_type_asof": loan_type_asof,
        "detail_time_range": detail_time_range,
        "backfill_apply_daily": backfill_apply_daily,
        "backfill_loan_daily": backfill_loan_daily,
        "backfill_two_minute": backfill_two_minute,
        "backfill_area": backfill_area,
        "backfill_fund_daily": backfill_fund_daily,
        "backfill_wealth_daily": backfill_wealth_daily,
        "backfill_total_daily": backfill_total_daily,
        "lambda_merge": lambda_merge,
        "cutover_points": cutover_points,
        "cutover_min": cutover_min,
        "restate_days": restate_days,
        "counters_current": counters_current,
        "counters_retained": counters_retained,
        "lookup_hash": lookup_hash,
        "lookup_day": lookup_day,
        "counter_names": counter_names,
        "graph_pattern": graph_pattern,
        "graph_two_hop": graph_two_hop,
        "graph_key_filter": graph_key_filter,
        "graph_any_key": graph_any_key,
        "key_list_scan": key_list_scan,
        "entity_projection": entity_projection,
        "csv_round_trip": csv_round_trip,
        "export_page": export_page,
        "row_to_json": row_to_json,
    }
    return q


QUERIES = _registry()  # the batch queries; registry.py has all
