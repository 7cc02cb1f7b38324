"""Inputs derived from the driver tables (FIXTURES.md), with Spark only.

The driver tables are TPC-H style; the business logs this engine consumes
are JSON envelopes. Each builder here is a deterministic projection of a
driver table, so the work grows with the tables: every order yields an
apply, a loan, a risk and an audit record, and the
``events`` table yields fund, wealth, unknown and broken records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditpulse.functions.timefn import ms_of_ntz, ms_to_text
from creditpulse.operators import catalogue as cat

DAY_MS = 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def base_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders ⋈ customer ⋈ nation`` with the short names of FIXTURES.md."""
    # The driver's tables are single-row-group files: the narrow rows, not the
    # JSON made of them, are dealt out by key, alike on every cluster.
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority")
    o = o.repartition("o_orderkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    b = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("o_orderkey")
    return b.select(
        k.alias("k"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("st"),
        F.substring("o_orderpriority", 1, 1).alias("pr"),
        F.col("c_custkey").alias("ck"),
        F.col("c_mktsegment").alias("seg"),
        F.col("n_name").alias("nn"),
        (ms_of_ntz(F.col("o_orderdate")) + (k * 37 % 86400) * 1000).alias("ms"),
    )


def _envelope(key: Column, log_no, ms: Column, payload: Column | None) -> DataFrame:
    fields = [F.lit(log_no).alias("logNo") if isinstance(log_no, str) else log_no.alias("logNo"), ms.alias("collectTime")]
    if payload is not None:
        fields.append(payload.alias("flatMap"))
    return F.to_json(F.struct(*fields))


def _floor_price(c: str = "price") -> Column:
    return F.floor(F.col(c)).cast("bigint")


def apply_flat(b: DataFrame) -> DataFrame:
    """FX-APPLY payload columns, one row per order."""
    k, ck = F.col("k"), F.col("ck")
    return b.select(
        "k", "ms",
        F.when(k % 5 == 0, "").otherwise(F.col("nn")).alias("lbsProvince"),
        F.when(k % 10 == 0, None).otherwise(F.col("nn")).alias("belongProvince"),
        F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("C"), _s(ck % 50), F.lit("市"))).alias("lbsCity"),
        F.when(k % 8 == 0, None).otherwise(F.concat(F.lit("B"), _s(ck % 20), F.lit("市"))).alias("belongCity"),
        F.when(k % 101 == 0, None).when(k % 97 == 0, "abc").when(k % 89 == 0, " ")
        .when(k % 83 == 0, " \u0085").when(k % 79 == 0, "\n")
        .otherwise(_s(_floor_price())).alias("applyamt"),
        F.when(k % 3 == 0, F.concat(F.lit(" "), F.col("seg"), F.lit(" "))).alias("channelcode"),
        F.when(k % 3 == 1, "A").otherwise("B").alias("channelsource"),
    )


def loan_flat(b: DataFrame) -> DataFrame:
    """FX-LOAN: a loan per order, ``k % 9`` days after it."""
    k = F.col("k")
    return b.select(
        "k",
        (F.col("ms") + (k % 9) * DAY_MS).alias("ms"),
        F.when(k % 17 == 0, None).otherwise(_s(k)).alias("orderId"),
        F.when(k % 103 == 0, None).otherwise(_s(_floor_price())).alias("capitalAmount"),
    )


def risk_flat(b: DataFrame) -> DataFrame:
    """FX-RISK: one risk decision per order, a minute after it."""
    k, ck, nn, pr = F.col("k"), F.col("ck"), F.col("nn"), F.col("pr")
    reject = (
        F.when(k % 5 == 0, "Y66|X69|").when(k % 5 == 1, "|Y7").when(k % 10 == 7, "||\n").when(k % 5 == 2, "||").when(k % 5 == 3, None)
        .otherwise(F.concat(F.lit("R"), _s(k % 11)))
    )
    area = (
        F.when(k % 3 == 0, F.concat(nn, F.lit("省|C"), _s(ck % 50), F.lit("市|D")))
        .when(k % 3 == 1, F.concat(nn, F.lit("省|C1市|")))
        .when(k % 6 == 5, F.concat(nn, F.lit("省|C2市|D|\u2028")))
        .otherwise(F.concat(nn, F.lit("省|C2市|D|")))
    )
    return b.select(
        "k",
        (F.col("ms") + 60000).alias("ms"),
        F.when(k % 19 == 0, None).otherwise(_s(k)).alias("ORDER_ID"),
        F.when(k % 13 == 0, "").when(pr == "1", "N").when(pr == "2", "J1").when(pr == "3", "J2")
        .when(pr == "4", "Z1").otherwise("Z2").alias("Z_RESERVED_CHAR5"),
        F.when(k % 7 == 0, None).otherwise(_floor_price()).alias("Z_PERMIT_LMT"),
        reject.alias("Z_REJECT_CODE"),
        F.when(k % 107 == 0, "bad").when(k % 23 == 0, None).otherwise(F.concat(_s(k % 7), F.lit(".0"))).alias("Z_RESULT_VAR104"),
        F.when(F.col("st") == "F", "AD").when(F.col("st") == "O", " AP ").otherwise("RR").alias("Z_RESULT_VAR014"),
        _s(k % 801).alias("Z_RESULT_VAR030"),
        area.alias("A_APCR_NAMES"),
        (k % 3).alias("C_HISAPPLY_VAR011"),
        (k % 120 - 10).alias("K_FINAL_SCORE"),
        F.when(k % 4 == 0, "Y").otherwise("N").alias("I_IS_TNH_TARUSER"),
        F.when(k % 6 == 0, "Y").otherwise("N").alias("I_IS_YFQ_TARUSER"),
        F.lit("N").alias("I_IS_POS_TARUSER"),
    )


def audit_flat(b: DataFrame) -> DataFrame:
    """FX-AUDIT: one approval result per order."""
    k, st = F.col("k"), F.col("st")
    return b.select(
        "k", "ms",
        F.when(k % 3 == 0, "SA").when(k % 3 == 1, "MA").otherwise("").alias("APPROVE_TYPE"),
        F.when(st == "F", "AD").when(st == "O", "AP").otherwise("RR").alias("A_RESULT"),
        F.when(k % 113 == 0, ",").when(k % 4 == 0, "A1,B2").when(k % 4 == 1, F.concat(F.lit("C"), _s(k % 6)))
        .alias("A_REJECT_CODE"),
    )


def events_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with epoch millis and the fund/wealth amount."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    e = e.repartition("event_id", "ts")  # dealt out like the orders: a file of one row group is one task
    amount = F.when(F.col("event_id") % 53 == 0, None).otherwise(F.floor(F.col("value") * 100).cast("bigint"))
    return e.select(
        "event_id", "event_type",
        ms_of_ntz(F.col("ts")).alias("ms"),
        amount.alias("amount"),
        F.when(F.col("event_type") == "purchase", "1G2").otherwise("9Z9").alias("busid"),
    )


def _payload(df: DataFrame, exclude=("k", "ms")) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c not in exclude])


def _logs(flat: DataFrame, prefix: str, log_no: str, id_col: str = "k") -> DataFrame:
    key = F.concat(F.lit(prefix + ":"), _s(F.col(id_col)))
    return flat.select(
        key.alias("key"),
        _envelope(None, log_no, F.col("ms"), _payload(flat, exclude=(id_col, "ms"))).alias("value"),
        F.col("ms"),
    )


def apply_logs(spark, sf_dir) -> DataFrame:
    return _logs(apply_flat(base_orders(spark, sf_dir)), "apply", cat.LOG_APPLY)


def loan_logs(spark, sf_dir) -> DataFrame:
    return _logs(loan_flat(base_orders(spark, sf_dir)), "loan", cat.LOG_LOAN)


def risk_logs(spark, sf_dir) -> DataFrame:
    return _logs(risk_flat(base_orders(spark, sf_dir)), "risk", cat.LOG_RISK)


def audit_logs(spark, sf_dir) -> DataFrame:
    return _logs(audit_flat(base_orders(spark, sf_dir)), "audit", cat.LOG_AUDIT)


def fund_logs(spark, sf_dir) -> DataFrame:
    e = events_flat(spark, sf_dir).where(F.col("event_type").isin("purchase", "signup"))
    return _logs(e.select("event_id", "ms", "busid", "amount"), "fund", cat.LOG_FUND, "event_id")


def wealth_logs(spark, sf_dir) -> DataFrame:
    """FX-WEALTH; in every fifth record with an amount, the key is there twice
    and the first value is wrong."""
    e = events_flat(spark, sf_dir).where(F.col("event_type") == "view")
    logs = _logs(e.select("event_id", "ms", "amount"), "wealth", cat.LOG_WEALTH, "event_id")
    twice = F.regexp_replace("value", '"flatMap":\\{"amount":', '"flatMap":{"amount":"1","amount":')
    return logs.withColumn("value", F.when(F.col("key").endswith("5") | F.col("key").endswith("0"), twice).otherwise(F.col("value")))


def unknown_logs(spark, sf_dir) -> DataFrame:
    """FX-UNKNOWN; in every third record ``flatMap`` is a text instead of an object."""
    e = events_flat(spark, sf_dir).where(F.col("event_type") == "click")
    value = F.when(F.col("event_id") % 3 == 0, _envelope(None, "Other", F.col("ms"), F.lit("no object"))).otherwise(
        _envelope(None, "Other", F.col("ms"), None))
    return e.select(F.concat(F.lit("other:"), _s(F.col("event_id"))).alias("key"), value.alias("value"), F.col("ms"))


def bad_logs(spark, sf_dir) -> DataFrame:
    """FX-BAD: cut JSON; times in nanoseconds or at the end of the range;
    history counts whose sum is out of range."""
    e = events_flat(spark, sf_dir).where(F.col("event_type") == "error")
    case = F.col("event_id") % 4
    longest = F.lit(2**63 - 1)
    history = F.struct(longest.alias("C_HISAPPLY_VAR011"), F.lit(1).cast("bigint").alias("C_HISAPPLY_VAR001"))
    none = F.lit(None).cast(history_type := "struct<C_HISAPPLY_VAR011:bigint,C_HISAPPLY_VAR001:bigint>")
    value = F.when(case == 0, F.concat(F.lit('{"logNo":'), _s(F.col("event_id")))).otherwise(F.to_json(F.struct(
        F.lit(cat.LOG_RISK).alias("logNo"),
        F.when(case == 1, F.col("ms") * 1_000_000).when(case == 2, longest).otherwise(F.col("ms")).alias("collectTime"),
        F.when(case == 3, history.cast(history_type)).otherwise(none).alias("flatMap"))))
    return e.select(F.concat(F.lit("bad:"), _s(F.col("event_id"))).alias("key"), value.alias("value"), F.col("ms"))


LOG_BUILDERS = {
    "apply": apply_logs,
    "loan": loan_logs,
    "risk": risk_logs,
    "audit": audit_logs,
    "fund": fund_logs,
    "wealth": wealth_logs,
    "unknown": unknown_logs,
    "bad": bad_logs,
}


def logs(spark: SparkSession, sf_dir: str, kinds=None, with_ms: bool = False) -> DataFrame:
    """Envelopes ``key STRING, value STRING`` of the chosen fixture kinds
    (plus the event time ``ms`` when ``with_ms``, to order stream files)."""
    kinds = list(LOG_BUILDERS) if kinds is None else list(kinds)
    cols = ["key", "value", "ms"] if with_ms else ["key", "value"]
    parts = [LOG_BUILDERS[k](spark, sf_dir).select(*cols) for k in kinds]
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- FX-DETAIL: flat detail tables for the backfill ------------------------


def detail_apply(spark, sf_dir, tz: str = "UTC") -> DataFrame:
    a = apply_flat(base_orders(spark, sf_dir))
    return a.select(
        F.col("applyamt"),
        ms_to_text(F.col("ms"), tz).alias("collecttimefmt"),
        F.col("belongProvince").alias("belongprovince"),
        F.col("belongCity").alias("belongcity"),
    )


def detail_loan(spark, sf_dir, tz: str = "UTC") -> DataFrame:
    ln = loan_flat(base_orders(spark, sf_dir))
    return ln.select(F.col("capitalAmount").alias("capitalamount"), ms_to_text(F.col("ms"), tz).alias("collecttime"))


def detail_fund(spark, sf_dir, tz: str = "UTC") -> DataFrame:
    e = events_flat(spark, sf_dir).where(F.col("event_type").isin("purchase", "signup"))
    return e.select("busid", "amount", ms_to_text(F.col("ms"), tz).alias("collecttime"))


def detail_wealth(spark, sf_dir, tz: str = "UTC") -> DataFrame:
    e = events_flat(spark, sf_dir).where(F.col("event_type") == "view")
    return e.select("amount", ms_to_text(F.col("ms"), tz).alias("collecttime"))
