"""Envelope parsing, routing, fan-out rules and per-record errors."""

import json

from pyspark.sql import functions as F

from creditpulse.operators import catalogue as cat
from creditpulse.plans import live

T0 = 1497404411776  # 2017-06-14 01:40:11 UTC


def env(log_no, payload, ms=T0, **extra):
    d = {"logNo": log_no, "collectTime": ms}
    if payload is not None:
        d["flatMap"] = payload
    d.update(extra)
    return json.dumps(d)


def run(spark, values):
    logs = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(values)], "key string, value string")
    rows = live.output_rows(logs).collect()
    good = sorted((r.key, r.metric, r.field, r.value) for r in rows if r.err is None)
    bad = sorted((r.key, r.err) for r in rows if r.err is not None)
    return good, bad


def test_envelope_errors(spark):
    vals = [None, "", "bad", "[]", "5", "null", json.dumps({"logNo": "x"}),
            json.dumps({"logNo": cat.LOG_APPLY, "collectTime": T0, "flatMap": "str"}), '{"logNo":"Other","collectTime":5} tail']
    good, bad = run(spark, vals)
    reasons = dict(bad)
    assert reasons["k0"] == "empty record"
    for k in ("k2", "k3", "k4", "k5", "k7"):
        assert reasons[k] == "malformed json"
    assert reasons["k1"] == "missing or bad collectTime"
    assert reasons["k6"] == "missing or bad collectTime"
    assert "k8" not in reasons and [g for g in good if g[0] == "k8"] == [("k8", "Other", "", 0)]


def test_apply_rules(spark):
    p = {"lbsProvince": " ", "belongProvince": "Zhejiang", "lbsCity": "", "belongCity": "Hangzhou市",
         "applyamt": " 120 ", "channelcode": "\tweb ", "channelsource": "A"}
    good, bad = run(spark, [env(cat.LOG_APPLY, p), env(cat.LOG_APPLY, {"applyamt": "1.5"}), env(cat.LOG_APPLY, {"x": "1"}),
                            env(cat.LOG_APPLY, {"applyamt": "", "channelsource": "A"})])
    assert dict(bad) == {"k1": "apply: applyamt is not an integer", "k2": "apply: missing applyamt"}
    k0 = {(m, f): v for k, m, f, v in good if k == "k0"}
    assert k0[("daily_apply_count", "")] == 1 and k0[("daily_apply_amount", "")] == 120
    assert k0[("sub_apply_count", "1497404520000")] == 1
    assert k0[("province_apply_count", "Zhejiang")] == 1 and k0[("city_apply_count", "Hangzhou")] == 1
    assert k0[("risk_channel", "web")] == 1
    k3 = {(m, f): v for k, m, f, v in good if k == "k3"}
    assert k3[("daily_apply_amount", "")] == 0 and k3[("risk_channel", "app")] == 1
    assert k3[("province_apply_count", "default")] == 1 and k3[("city_apply_count", "default")] == 1


def test_fund_wealth_rules(spark):
    good, bad = run(spark, [env(cat.LOG_FUND, {"busid": "1G2", "amount": 300}), env(cat.LOG_FUND, {"busid": "X", "amount": 5}),
                            env(cat.LOG_FUND, {"busid": "1G2"}), env(cat.LOG_WEALTH, {"amount": "7.9"})])
    assert dict(bad) == {"k2": "fund: missing amount"}
    k1 = [(m, v) for k, m, f, v in good if k == "k1"]
    assert k1 == [("fund_finacing_total_count", 0)]
    k3 = {m: v for k, m, f, v in good if k == "k3"}
    assert k3 == {"Finacing_count": 1, "Finacing_amount": 7, "fund_finacing_total_count": 1, "fund_finacing_total_amount": 7}


def test_audit_rules(spark):
    good, bad = run(spark, [env(cat.LOG_AUDIT, {"APPROVE_TYPE": "SA", "A_RESULT": "AD", "A_REJECT_CODE": "A1,B2"}),
                            env(cat.LOG_AUDIT, {"APPROVE_TYPE": "MA", "A_RESULT": " AP", "A_REJECT_CODE": ",B"}),
                            env(cat.LOG_AUDIT, {"APPROVE_TYPE": "MA", "A_REJECT_CODE": ",,"})])
    assert dict(bad) == {"k2": "audit: reject code has no part"}
    assert [(m, f) for k, m, f, v in good if k == "k0"] == [("risk_reject_code", "A1"), ("risk_system_approve", "refuse.count")]
    assert [(m, f) for k, m, f, v in good if k == "k1"] == [("risk_reject_code", "")]


def test_risk_bands_and_levels(spark):
    scores = [-1, 0, 299.9, 300, 500, 599.9, 600, 750, 750.1]
    kscores = [-1, 0, 1, 49, 50]
    vals = [env(cat.LOG_RISK, {"Z_RESULT_VAR030": str(s)}) for s in scores]
    vals += [env(cat.LOG_RISK, {"K_FINAL_SCORE": k}) for k in kscores]
    vals += [env(cat.LOG_RISK, {"Z_RESULT_VAR104": f"{lv}.0", "Z_PERMIT_LMT": 10, "A_APCR_NAMES": "P省|C市|D"}) for lv in range(7)]
    good, bad = run(spark, vals)
    assert bad == []
    band = {k: f for k, m, f, v in good if m == "risk_credit_score" and f.endswith(".count")}
    assert [band.get(f"k{i}") for i in range(9)] == [None, "0to300.count", "0to300.count", "300to500.count",
                                                     "500to600.count", "500to600.count", "600to750.count", "600to750.count", None]
    kb = {k: f for k, m, f, v in good if m == "risk_k_score"}
    assert [kb.get(f"k{9 + i}") for i in range(5)] == [None, "0", "0to50", "0to50", "50+"]
    lv = {k: f for k, m, f, v in good if m == "risk_level" and f.endswith(".amount")}
    assert [lv.get(f"k{14 + i}") for i in range(7)] == [None, "max.amount", "high.amount", "mid.amount", "low.amount", "min.amount", None]
    area = sorted((k, m, f) for k, m, f, v in good if m in ("risk_province_count", "risk_city_count"))
    assert area == [("k15", "risk_city_count", "C"), ("k15", "risk_province_count", "P"),
                    ("k16", "risk_city_count", "C"), ("k16", "risk_province_count", "P")]


def test_risk_errors_and_flags(spark):
    good, bad = run(spark, [
        env(cat.LOG_RISK, {"Z_PERMIT_LMT": "x"}),
        env(cat.LOG_RISK, {"K_FINAL_SCORE": "1.5e"}),
        env(cat.LOG_RISK, {"I_IS_POS_TARUSER": "Y", "C_HISAPPLY_VAR001": 2, "Z_RESERVED_CHAR5": "J2", "ORDER_ID": "9",
                           "Z_REJECT_CODE": "Y66|X69|", "Z_RESULT_VAR014": " RR "}),
        env(cat.LOG_RISK, {"Z_RESERVED_CHAR5": "N", "ORDER_ID": " ", "Z_REJECT_CODE": "||"}),
    ])
    assert dict(bad) == {"k0": "risk: Z_PERMIT_LMT is not a number", "k1": "risk: K_FINAL_SCORE is not a number"}
    k2 = sorted((m, f, v) for k, m, f, v in good if k == "k2")
    assert ("risk_customer_type_count", "targetCustomer", 1) in k2
    assert ("risk_customer_type_count", "historyCustomer", 1) in k2
    assert ("RISK_CUSTOMER_DISTRIBUTION", "settle.two.count", 1) in k2
    assert ("RISK_REJECT_REASON", "Y66", 1) in k2
    assert ("risk_decision_result", "manual.amount", 0) in k2
    k3 = sorted((m, f) for k, m, f, v in good if k == "k3")
    assert k3 == [("risk_customer_type_count", "newCustomer"), ("risk_customer_type_count", "unTargetCustomer")]


def test_known_only_drops_unknown(spark):
    logs = spark.createDataFrame([("a", env("Other", {"x": 1})), ("b", env(cat.LOG_WEALTH, {"amount": 2}))], "key string, value string")
    totals = live.metric_totals(logs, with_types=False).collect()
    assert sorted(r.metric for r in totals) == ["Finacing_amount", "Finacing_count", "fund_finacing_total_amount", "fund_finacing_total_count"]
