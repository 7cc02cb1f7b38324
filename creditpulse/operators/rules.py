"""Metric rules: one parsed record -> a list of metric deltas (FM-1..FM-9).

Every rule is a native expression. For each record the plan builds one array
of ``struct(metric, field, value)`` (null entries removed) and ``inline`` turns
it into rows, so the whole fan-out is a single projection inside codegen, and
the aggregation that follows combines map-side before its shuffle.

Errors are decided per record before the fan-out: a record with an error
emits no delta at all and goes to the dead letters with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditpulse.functions.envelope import payload
from creditpulse.functions.numbers import (
    opt_double,
    opt_error,
    opt_float,
    opt_int,
    opt_long,
    strict_long,
    strict_long_error,
)
from creditpulse.functions.text import (
    area_parts,
    first_non_blank,
    first_part,
    is_blank,
    java_trim,
    split_is_empty,
    strip_token,
)
from creditpulse.operators import catalogue as cat

# Record kinds by log type.
KINDS = {
    cat.LOG_APPLY: "apply",
    cat.LOG_LOAN: "loan",
    cat.LOG_FUND: "fund",
    cat.LOG_WEALTH: "wealth",
    cat.LOG_RISK: "risk",
    cat.LOG_AUDIT: "audit",
}

# The payload fields that the rules and the as-of join read.
PAYLOAD_FIELDS = [
    "lbsProvince", "belongProvince", "lbsCity", "belongCity", "applyamt", "channelcode", "channelsource",
    "orderId", "capitalAmount", "busid", "amount", "APPROVE_TYPE", "A_RESULT", "A_REJECT_CODE",
    "ORDER_ID", "Z_RESERVED_CHAR5", "Z_PERMIT_LMT", "Z_REJECT_CODE", "Z_RESULT_VAR104", "Z_RESULT_VAR014",
    "Z_RESULT_VAR030", "A_APCR_NAMES", "C_HISAPPLY_VAR011", "C_HISAPPLY_VAR001", "K_FINAL_SCORE",
    "I_IS_TNH_TARUSER", "I_IS_YFQ_TARUSER", "I_IS_POS_TARUSER",
]

# Code -> label mappings of the risk and audit records.
DECISION_LABELS = [("AD", "refuse"), ("RR", "manual"), ("AP", "pass")]
APPROVER_METRICS = [("SA", "risk_system_approve"), ("MA", "risk_manual_approve")]
APPROVAL_LABELS = [("AD", "refuse.count"), ("AP", "pass.count")]
CUSTOMER_LABELS = [("N", "new"), ("J1", "settle.one"), ("J2", "settle.two"), ("Z1", "transit.one"), ("Z2", "transit.two")]
LEVEL_LABELS = [(1.0, "max"), (2.0, "high"), (3.0, "mid"), (4.0, "low"), (5.0, "min")]
# (label, lower bound inclusive, upper bound, upper bound inclusive)
CREDIT_BANDS = [("0to300", 0, 300, False), ("300to500", 300, 500, False), ("500to600", 500, 600, False), ("600to750", 600, 750, True)]
FUND_BUSID = "1G2"
APP_CHANNEL = "app"
PROVINCE_TOKEN = "省"
CITY_TOKEN = "市"

DELTA_TYPE = "struct<metric:string,field:string,value:bigint,err:string>"


def _lookup(c: Column, pairs) -> Column:
    out = None
    for code, label in pairs:
        code = code if isinstance(code, Column) else F.lit(code)
        out = F.when(c == code, F.lit(label)) if out is None else out.when(c == code, F.lit(label))
    return out


def customer_label(code: Column) -> Column:
    """SC-15 customer type code -> label, null when unlisted."""
    return _lookup(code, CUSTOMER_LABELS)


def kind_of(log_no: Column) -> Column:
    """FL-2: route on ``logNo``; anything else is ``unknown``."""
    return F.coalesce(_lookup(log_no, list(KINDS.items())), F.lit("unknown"))


def _d(metric, field, value, cond: Column | None = None) -> Column:
    metric = F.lit(metric) if isinstance(metric, str) else metric
    field = F.lit(field) if isinstance(field, str) else field
    value = F.lit(value) if isinstance(value, int) else value
    s = F.struct(
        metric.alias("metric"), field.alias("field"), value.cast("bigint").alias("value"),
        F.lit(None).cast("string").alias("err"),
    )
    return s if cond is None else F.when(cond, s)


def _pack(entries) -> Column:
    """The record's deltas; entries whose condition failed are null and are
    dropped after ``inline_outer`` (a ``filter`` lambda here would take the
    whole rule tree out of code generation)."""
    return F.array(*entries)


# --- per-kind rules -------------------------------------------------------
#
# Each kind has (1) typed fields, computed once per record into columns
# (prefixed by the kind), and (2) small delta entries and an error test that
# only reference those columns. Keeping the two apart keeps the generated
# code of the rules stage small enough for whole-stage codegen.


def channel(code: Column, source: Column, app_label: str = APP_CHANNEL) -> Column:
    """SC-19: trimmed channel code, else the app label for source ``A``."""
    return F.when(~is_blank(code), java_trim(code)).when(source == F.lit("A"), F.lit(app_label))


def apply_province(p: str = "p") -> Column:
    return first_non_blank(payload("lbsProvince", p), payload("belongProvince", p))


def apply_city(p: str = "p") -> Column:
    city = F.coalesce(
        F.when(~is_blank(payload("lbsCity", p)), payload("lbsCity", p)),
        F.when(~is_blank(payload("belongCity", p)), payload("belongCity", p)),
    )
    return F.coalesce(strip_token(city, CITY_TOKEN), F.lit("default"))


def loan_amount(p: str = "p") -> Column:
    return strict_long(payload("capitalAmount", p))


def _c(name: str) -> Column:
    return F.col(name)


def _apply_fields(app_label: str = APP_CHANNEL):
    raw = payload("applyamt")
    return {
        "a_raw_null": raw.isNull(),
        "a_bad_amount": strict_long_error(raw),
        "a_amount": strict_long(raw),
        "a_province": apply_province(),
        "a_city": apply_city(),
        "a_channel": channel(payload("channelcode"), payload("channelsource"), app_label),
    }


def _apply_rules():
    b = F.col("bucket").cast("string")
    amount = _c("a_amount")
    deltas = _pack([
        _d("daily_apply_count", "", 1),
        _d("daily_apply_amount", "", amount),
        _d("sub_apply_count", b, 1),
        _d("sub_apply_amount", b, amount),
        _d("province_apply_count", _c("a_province"), 1),
        _d("city_apply_count", _c("a_city"), 1),
        _d("risk_channel", _c("a_channel"), 1, _c("a_channel").isNotNull()),
    ])
    err = (
        F.when(F.col("p").isNull(), F.lit("apply: missing flatMap"))
        .when(_c("a_raw_null"), F.lit("apply: missing applyamt"))
        .when(_c("a_bad_amount"), F.lit("apply: applyamt is not an integer"))
    )
    return deltas, err


def _loan_fields():
    raw = payload("capitalAmount")
    return {"l_raw_null": raw.isNull(), "l_bad_amount": strict_long_error(raw), "l_amount": strict_long(raw)}


def _loan_rules():
    """FM-2 without the customer-type part (that one needs JN-1)."""
    b = F.col("bucket").cast("string")
    amount = _c("l_amount")
    deltas = _pack([
        _d("daily_loan_count", "", 1),
        _d("daily_loan_amount", "", amount),
        _d("sub_loan_count", b, 1),
        _d("sub_loan_amount", b, amount),
    ])
    err = (
        F.when(F.col("p").isNull(), F.lit("loan: missing flatMap"))
        .when(_c("l_raw_null"), F.lit("loan: missing capitalAmount"))
        .when(_c("l_bad_amount"), F.lit("loan: capitalAmount is not an integer"))
    )
    return deltas, err


def _money_fields(prefix: str):
    raw = payload("amount")
    parsed = opt_long(raw)
    return {
        f"{prefix}_missing": is_blank(raw),
        f"{prefix}_bad": opt_error(raw, parsed),
        f"{prefix}_amount": F.coalesce(parsed, F.lit(0).cast("bigint")),
    }


def _money_error(kind: str, prefix: str) -> Column:
    # The amount is read into a primitive: missing is an error as well.
    return (
        F.when(F.col("p").isNull(), F.lit(f"{kind}: missing flatMap"))
        .when(_c(f"{prefix}_missing"), F.lit(f"{kind}: missing amount"))
        .when(_c(f"{prefix}_bad"), F.lit(f"{kind}: amount is not a number"))
    )


def _fund_fields():
    f = _money_fields("f")
    f["f_is_fund"] = F.coalesce(  # FL-4: fund subscription only
        payload("busid") == F.lit(FUND_BUSID), F.lit(False))
    return f


def _fund_rules():
    """FM-3: fund subscriptions; other business ids only touch the total."""
    amount, is_fund = _c("f_amount"), _c("f_is_fund")
    deltas = _pack([
        _d("fund_count", "", 1, is_fund),
        _d("fund_amount", "", amount, is_fund),
        _d("fund_finacing_total_count", "", F.when(is_fund, 1).otherwise(0)),
        _d("fund_finacing_total_amount", "", amount, is_fund),
    ])
    return deltas, _money_error("fund", "f")


def _wealth_fields():
    return _money_fields("w")


def _wealth_rules():
    """FM-4: wealth-product subscriptions."""
    amount = _c("w_amount")
    deltas = _pack([
        _d("Finacing_count", "", 1),
        _d("Finacing_amount", "", amount),
        _d("fund_finacing_total_count", "", 1),
        _d("fund_finacing_total_amount", "", amount),
    ])
    return deltas, _money_error("wealth", "w")


def _audit_fields():
    approver = payload("APPROVE_TYPE")
    code = payload("A_REJECT_CODE")
    metric = _lookup(approver, APPROVER_METRICS)
    label = _lookup(payload("A_RESULT"), APPROVAL_LABELS)
    return {
        "au_metric": F.when(~is_blank(approver) & label.isNotNull(), metric),
        "au_label": label,
        "au_code": F.when(~is_blank(code), first_part(code, ",")),
        "au_code_bad": ~is_blank(code) & split_is_empty(code, ","),
    }


def _audit_rules():
    """FM-5: approver x result, and the first reject code (any approver)."""
    deltas = _pack([
        _d(_c("au_metric"), _c("au_label"), 1, _c("au_metric").isNotNull()),
        _d("risk_reject_code", _c("au_code"), 1, _c("au_code").isNotNull()),
    ])
    err = (
        F.when(F.col("p").isNull(), F.lit("audit: missing flatMap"))
        .when(_c("au_code_bad"), F.lit("audit: reject code has no part"))
    )
    return deltas, err


def risk_area(p: str = "p") -> tuple[Column, Column, Column]:
    """FM-8: (has three parts, province, city) of the home address."""
    names = payload("A_APCR_NAMES", p)
    parts = area_parts(names, "|")
    ok = ~is_blank(names) & (F.size(parts) == 3)
    province = strip_token(F.get(parts, 0), PROVINCE_TOKEN)
    city = strip_token(F.get(parts, 1), CITY_TOKEN)
    return ok, province, city


def _risk_fields():
    amount_raw = payload("Z_PERMIT_LMT")
    amount = opt_long(amount_raw)
    level = opt_float(payload("Z_RESULT_VAR104"))
    score = opt_double(payload("Z_RESULT_VAR030"))
    hist1 = opt_long(payload("C_HISAPPLY_VAR011"))
    hist2 = opt_long(payload("C_HISAPPLY_VAR001"))
    ks = opt_int(payload("K_FINAL_SCORE"))
    history = F.try_add(F.coalesce(hist1, F.lit(0)), F.coalesce(hist2, F.lit(0)))
    rule = payload("Z_REJECT_CODE")
    area_ok, province, city = risk_area()
    band = None  # SC-16 credit score band (level and third-party score bands below)
    for label, lo, hi, hi_incl in CREDIT_BANDS:
        upper = score <= F.lit(hi) if hi_incl else score < F.lit(hi)
        cond = (score >= F.lit(lo)) & upper
        band = F.when(cond, F.lit(label)) if band is None else band.when(cond, F.lit(label))
    yes = F.lit(False)  # SC-17 any of three flags is Y
    for flag in ("I_IS_TNH_TARUSER", "I_IS_YFQ_TARUSER", "I_IS_POS_TARUSER"):
        yes = yes | F.coalesce(payload(flag) == F.lit("Y"), F.lit(False))
    code = payload("Z_RESERVED_CHAR5")
    ctype = customer_label(code)
    return {
        "r_err": (
            F.when(opt_error(amount_raw, amount), F.lit("risk: Z_PERMIT_LMT is not a number"))
            .when(opt_error(payload("Z_RESULT_VAR104"), level), F.lit("risk: Z_RESULT_VAR104 is not a number"))
            .when(opt_error(payload("Z_RESULT_VAR030"), score), F.lit("risk: Z_RESULT_VAR030 is not a number"))
            .when(opt_error(payload("C_HISAPPLY_VAR011"), hist1), F.lit("risk: C_HISAPPLY_VAR011 is not a number"))
            .when(opt_error(payload("C_HISAPPLY_VAR001"), hist2), F.lit("risk: C_HISAPPLY_VAR001 is not a number"))
            .when(history.isNull(), F.lit("risk: history counts out of range"))
            .when(opt_error(payload("K_FINAL_SCORE"), ks), F.lit("risk: K_FINAL_SCORE is not a number"))
        ),
        "r_amount": F.coalesce(amount, F.lit(0).cast("bigint")),
        "r_rule": F.when(~is_blank(rule), first_part(rule, "|")),
        "r_level": _lookup(level, [(F.lit(v).cast("float"), lb) for v, lb in LEVEL_LABELS]),
        "r_area": F.when(area_ok & level.isin(1.0, 2.0), F.struct(province.alias("province"), city.alias("city"))),
        "r_decision": _lookup(java_trim(payload("Z_RESULT_VAR014")), DECISION_LABELS),
        "r_band": band,
        "r_mix": F.when(~is_blank(code) & ~is_blank(payload("ORDER_ID")), ctype),
        "r_target": F.when(yes, "targetCustomer").otherwise("unTargetCustomer"),
        # SC-18: either history count above zero
        "r_history": F.when(history > 0, "historyCustomer")
        .otherwise("newCustomer"),
        "r_kband": F.when(ks == 0, "0").when((ks > 0) & (ks < 50), "0to50").when(ks >= 50, "50+"),
    }


def _risk_rules():
    """FM-6 (with FM-8): rule hit, level, decision, score band, customer
    mix, target and history flags, third-party score."""
    amount = _c("r_amount")
    entries = [_d("RISK_REJECT_REASON", _c("r_rule"), 1, _c("r_rule").isNotNull())]
    for col, metric in (("r_level", "risk_level"), ("r_decision", "risk_decision_result"), ("r_band", "risk_credit_score")):
        hit = _c(col).isNotNull()
        entries.append(_d(metric, F.concat(_c(col), F.lit(".count")), 1, hit))
        entries.append(_d(metric, F.concat(_c(col), F.lit(".amount")), amount, hit))
    area = _c("r_area")
    entries.append(_d("risk_province_count", area.getField("province"), 1, area.isNotNull()))
    entries.append(_d("risk_city_count", area.getField("city"), 1, area.isNotNull()))
    entries.append(_d("RISK_CUSTOMER_DISTRIBUTION", F.concat(_c("r_mix"), F.lit(".count")), 1, _c("r_mix").isNotNull()))
    entries.append(_d("risk_customer_type_count", _c("r_target"), 1))
    entries.append(_d("risk_customer_type_count", _c("r_history"), 1))
    entries.append(_d("risk_k_score", _c("r_kband"), 1, _c("r_kband").isNotNull()))
    err = F.when(F.col("p").isNull(), F.lit("risk: missing flatMap")).otherwise(_c("r_err"))
    return _pack(entries), err


def unknown_rules(log_no: str = "log_no") -> tuple[Column, Column]:
    """FM-7: one zero delta named after the log type (dropped by FL-6)."""
    return _pack([_d(F.col(log_no), "", 0)]), F.lit(None).cast("string")


_RULES = {
    "apply": (_apply_fields, _apply_rules),
    "loan": (_loan_fields, _loan_rules),
    "fund": (_fund_fields, _fund_rules),
    "wealth": (_wealth_fields, _wealth_rules),
    "risk": (_risk_fields, _risk_rules),
    "audit": (_audit_fields, _audit_rules),
}

OUT_TYPE = f"array<{DELTA_TYPE}>"


def classify(parsed: DataFrame, kinds=None, app_label: str = APP_CHANNEL) -> DataFrame:
    """Add ``kind``, ``err`` (FM-9 reason or null) and ``out``.

    ``out`` holds the record's deltas, or -- for a bad record -- exactly one
    entry whose ``err`` is the reason (FM-9: an error replaces all deltas).
    ``kinds`` limits which rule sets are compiled into the projection;
    ``app_label`` is the channel name of applications from the own app (SC-19).
    """
    kinds = list(_RULES) if kinds is None else list(kinds)
    kind = F.col("kind")
    staged = parsed.withColumn("kind", kind_of(F.col("log_no")))
    # Typed fields are computed for every record, not under a ``CASE kind``:
    # a conditional wrapper defeats subexpression elimination (each field
    # would re-read and re-parse the same payload values), and on records
    # of another kind the payload lookups are null and short-circuit.
    typed = []
    for k in kinds:
        for name, expr in (_RULES[k][0](app_label) if k == "apply" else _RULES[k][0]()).items():
            typed.append(expr.alias(name))
    staged = staged.select("*", *typed)
    deltas_expr = None
    err_expr = None
    for k in kinds:
        d, e = _RULES[k][1]()
        cond = kind == F.lit(k)
        deltas_expr = F.when(cond, d) if deltas_expr is None else deltas_expr.when(cond, d)
        err_expr = F.when(cond, e) if err_expr is None else err_expr.when(cond, e)
    ud, _ = unknown_rules()
    unknown = kind == F.lit("unknown")
    deltas_expr = F.when(unknown, ud) if deltas_expr is None else deltas_expr.when(unknown, ud)
    deltas_expr = deltas_expr.otherwise(F.array().cast(OUT_TYPE))
    err_col = F.col("env_err") if err_expr is None else F.coalesce(F.col("env_err"), err_expr)
    bad = F.array(
        F.struct(
            F.lit(None).cast("string").alias("metric"), F.lit(None).cast("string").alias("field"),
            F.lit(None).cast("bigint").alias("value"), F.col("err").alias("err"),
        )
    )
    out = F.when(F.col("err").isNull(), deltas_expr.cast(OUT_TYPE)).otherwise(bad.cast(OUT_TYPE))
    return staged.withColumn("err", err_col).withColumn("out", out)


def outputs(classified: DataFrame) -> DataFrame:
    """One row per delta of a good record, one per bad record:
    ``key, json, kind, day, collect_ms, metric, field, value, err``.

    ``inline_outer``: a plain ``inline`` makes Catalyst infer
    ``size(out) > 0`` and push that test below, copying the rule tree.
    """
    rows = classified.select(
        "key", F.col("value").alias("json"), "kind", "day", "collect_ms", F.inline_outer("out")
    )
    return rows.where(F.col("metric").isNotNull() | F.col("err").isNotNull())


def split_errors(out_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FL-1: delta rows of good records, and the bad records."""
    return out_rows.where(F.col("err").isNull()), out_rows.where(F.col("err").isNotNull())


def explode_deltas(good_rows: DataFrame) -> DataFrame:
    """Good output rows -> ``metric, field, day, value``."""
    return good_rows.select("metric", "field", "day", "value")


def generate_where(df: DataFrame, cond: Column, cols) -> DataFrame:
    """Rows of ``df`` where ``cond`` holds, projected to ``cols``.

    Written as a generator over a one-element array instead of a ``where``
    so that the condition is evaluated in the same projection as the parse
    and never copied below it.
    """
    marked = list(cols) + [F.lit(True).alias("_hit")]
    out = df.select(F.inline_outer(F.when(cond, F.array(F.struct(*marked)))))
    return out.where(F.col("_hit")).drop("_hit")
