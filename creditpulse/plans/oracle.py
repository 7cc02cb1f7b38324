"""Independent DuckDB SQL for each registered query.

The SQL works on the driver tables directly -- no JSON -- so it checks the
envelope encoding, the parse and the rules end to end. Shared pieces are
CTE texts assembled per query.
"""

from __future__ import annotations

import datetime as _dt

from creditpulse.operators import catalogue as cat
from creditpulse.plans import queries as Q

TTL = Q.TTL_MS
LATENESS_DAYS = 10_400  # of the stream with a bound


def blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '[\\x00-\\x20]*'))"


def nb(x: str) -> str:
    return f"(NOT {blank(x)})"


def day(ms: str) -> str:
    return f"strftime(epoch_ms({ms}), '%Y-%m-%d')"


def bucket(ms: str) -> str:
    return f"CAST(({ms} // 120000) * 120000 + 120000 AS VARCHAR)"


def is_int(x: str) -> str:
    return f"regexp_full_match(trim({x}), '[+-]?[0-9]+')"


CTE = {}
CTE["b"] = """b AS (
  SELECT o.o_orderkey AS k, o.o_totalprice AS price, o.o_orderstatus AS st, substr(o.o_orderpriority, 1, 1) AS pr,
         c.c_custkey AS ck, c.c_mktsegment AS seg, n.n_name AS nn,
         epoch_ms(o.o_orderdate) + (o.o_orderkey * 37 % 86400) * 1000 AS ms
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
CTE["fx_apply"] = """fx_apply AS (
  SELECT k, ms,
    CASE WHEN k % 5 = 0 THEN '' ELSE nn END AS lbsProvince,
    CASE WHEN k % 10 = 0 THEN NULL ELSE nn END AS belongProvince,
    CASE WHEN k % 4 = 0 THEN '' ELSE concat('C', CAST(ck % 50 AS VARCHAR), '市') END AS lbsCity,
    CASE WHEN k % 8 = 0 THEN NULL ELSE concat('B', CAST(ck % 20 AS VARCHAR), '市') END AS belongCity,
    CASE WHEN k % 101 = 0 THEN NULL WHEN k % 97 = 0 THEN 'abc' WHEN k % 89 = 0 THEN ' '
         WHEN k % 83 = 0 THEN concat(' ', chr(133)) WHEN k % 79 = 0 THEN chr(10)
         ELSE CAST(CAST(floor(price) AS BIGINT) AS VARCHAR) END AS applyamt,
    CASE WHEN k % 3 = 0 THEN concat(' ', seg, ' ') END AS channelcode,
    CASE WHEN k % 3 = 1 THEN 'A' ELSE 'B' END AS channelsource
  FROM b)"""
CTE["apply_ok"] = f"""apply_ok AS (
  SELECT *, {day('ms')} AS day, {bucket('ms')} AS bucket,
    CASE WHEN {blank('applyamt')} THEN 0 ELSE TRY_CAST(trim(applyamt) AS BIGINT) END AS amount,
    CASE WHEN {nb('lbsProvince')} THEN lbsProvince WHEN {nb('belongProvince')} THEN belongProvince ELSE 'default' END AS province,
    CASE WHEN {nb('lbsCity')} THEN replace(lbsCity, '市', '') WHEN {nb('belongCity')} THEN replace(belongCity, '市', '')
         ELSE 'default' END AS city,
    CASE WHEN {nb('channelcode')} THEN trim(channelcode) WHEN channelsource = 'A' THEN 'app' END AS channel
  FROM fx_apply
  WHERE applyamt IS NOT NULL AND ({blank('applyamt')} OR {is_int('applyamt')}))"""
def apply_d(src="apply_ok", name="apply_d"):
    return f"""{name} AS (
  SELECT 'daily_apply_count' AS metric, '' AS field, day, 1 AS value, ms FROM {src}
  UNION ALL SELECT 'daily_apply_amount', '', day, amount, ms FROM {src}
  UNION ALL SELECT 'sub_apply_count', bucket, day, 1, ms FROM {src}
  UNION ALL SELECT 'sub_apply_amount', bucket, day, amount, ms FROM {src}
  UNION ALL SELECT 'province_apply_count', province, day, 1, ms FROM {src}
  UNION ALL SELECT 'city_apply_count', city, day, 1, ms FROM {src}
  UNION ALL SELECT 'risk_channel', channel, day, 1, ms FROM {src} WHERE channel IS NOT NULL)"""


CTE["apply_d"] = apply_d()
CTE["fx_loan"] = """fx_loan AS (
  SELECT k, ms + (k % 9) * 86400000 AS ms,
    CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS orderId,
    CASE WHEN k % 103 = 0 THEN NULL ELSE CAST(CAST(floor(price) AS BIGINT) AS VARCHAR) END AS capitalAmount
  FROM b)"""
CTE["loan_ok"] = f"""loan_ok AS (
  SELECT *, {day('ms')} AS day, {bucket('ms')} AS bucket,
    CASE WHEN {blank('capitalAmount')} THEN 0 ELSE TRY_CAST(trim(capitalAmount) AS BIGINT) END AS amount
  FROM fx_loan WHERE capitalAmount IS NOT NULL AND ({blank('capitalAmount')} OR {is_int('capitalAmount')}))"""
def loan_d(src="loan_ok", name="loan_d"):
    return f"""{name} AS (
  SELECT 'daily_loan_count' AS metric, '' AS field, day, 1 AS value, ms FROM {src}
  UNION ALL SELECT 'daily_loan_amount', '', day, amount, ms FROM {src}
  UNION ALL SELECT 'sub_loan_count', bucket, day, 1, ms FROM {src}
  UNION ALL SELECT 'sub_loan_amount', bucket, day, amount, ms FROM {src})"""


CTE["loan_d"] = loan_d()
CTE["fx_risk"] = """fx_risk AS (
  SELECT k, ms + 60000 AS ms,
    CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS ORDER_ID,
    CASE WHEN k % 13 = 0 THEN '' WHEN pr = '1' THEN 'N' WHEN pr = '2' THEN 'J1' WHEN pr = '3' THEN 'J2'
         WHEN pr = '4' THEN 'Z1' ELSE 'Z2' END AS Z_RESERVED_CHAR5,
    CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(floor(price) AS BIGINT) END AS Z_PERMIT_LMT,
    CASE WHEN k % 5 = 0 THEN 'Y66|X69|' WHEN k % 5 = 1 THEN '|Y7' WHEN k % 10 = 7 THEN concat('||', chr(10)) WHEN k % 5 = 2 THEN '||'
         WHEN k % 5 = 3 THEN NULL ELSE concat('R', CAST(k % 11 AS VARCHAR)) END AS Z_REJECT_CODE,
    CASE WHEN k % 107 = 0 THEN 'bad' WHEN k % 23 = 0 THEN NULL ELSE concat(CAST(k % 7 AS VARCHAR), '.0') END AS Z_RESULT_VAR104,
    CASE st WHEN 'F' THEN 'AD' WHEN 'O' THEN ' AP ' ELSE 'RR' END AS Z_RESULT_VAR014,
    CAST(k % 801 AS VARCHAR) AS Z_RESULT_VAR030,
    CASE k % 3 WHEN 0 THEN concat(nn, '省|C', CAST(ck % 50 AS VARCHAR), '市|D') WHEN 1 THEN concat(nn, '省|C1市|')
         ELSE concat(nn, '省|C2市|D|', CASE WHEN k % 6 = 5 THEN chr(8232) ELSE '' END) END AS A_APCR_NAMES,
    k % 3 AS C_HISAPPLY_VAR011,
    k % 120 - 10 AS K_FINAL_SCORE,
    CASE WHEN k % 4 = 0 THEN 'Y' ELSE 'N' END AS I_IS_TNH_TARUSER,
    CASE WHEN k % 6 = 0 THEN 'Y' ELSE 'N' END AS I_IS_YFQ_TARUSER,
    'N' AS I_IS_POS_TARUSER
  FROM b)"""
CTE["risk_ok"] = f"""risk_ok AS (
  SELECT *, {day('ms')} AS day,
    coalesce(Z_PERMIT_LMT, 0) AS amount,
    TRY_CAST(Z_RESULT_VAR104 AS FLOAT) AS lvl,
    TRY_CAST(Z_RESULT_VAR030 AS DOUBLE) AS score,
    CASE WHEN {nb('Z_REJECT_CODE')} AND rtrim(Z_REJECT_CODE, '|') <> '' THEN split_part(rtrim(Z_REJECT_CODE, '|'), '|', 1) END AS rule,
    string_split(rtrim(A_APCR_NAMES, '|'), '|') AS parts,
    CASE trim(Z_RESULT_VAR014) WHEN 'AD' THEN 'refuse' WHEN 'RR' THEN 'manual' WHEN 'AP' THEN 'pass' END AS decision,
    CASE Z_RESERVED_CHAR5 WHEN 'N' THEN 'new' WHEN 'J1' THEN 'settle.one' WHEN 'J2' THEN 'settle.two'
         WHEN 'Z1' THEN 'transit.one' WHEN 'Z2' THEN 'transit.two' END AS ctype
  FROM fx_risk
  WHERE NOT ({nb('Z_RESULT_VAR104')} AND TRY_CAST(Z_RESULT_VAR104 AS FLOAT) IS NULL)
    AND NOT ({nb('Z_RESULT_VAR030')} AND TRY_CAST(Z_RESULT_VAR030 AS DOUBLE) IS NULL))"""
CTE["risk_l"] = """risk_l AS (
  SELECT *, CASE lvl WHEN 1 THEN 'max' WHEN 2 THEN 'high' WHEN 3 THEN 'mid' WHEN 4 THEN 'low' WHEN 5 THEN 'min' END AS lvl_label,
    CASE WHEN score >= 0 AND score < 300 THEN '0to300' WHEN score >= 300 AND score < 500 THEN '300to500'
         WHEN score >= 500 AND score < 600 THEN '500to600' WHEN score >= 600 AND score <= 750 THEN '600to750' END AS band,
    CASE WHEN K_FINAL_SCORE = 0 THEN '0' WHEN K_FINAL_SCORE > 0 AND K_FINAL_SCORE < 50 THEN '0to50'
         WHEN K_FINAL_SCORE >= 50 THEN '50+' END AS kband
  FROM risk_ok)"""
CTE["risk_d"] = f"""risk_d AS (
  SELECT 'RISK_REJECT_REASON' AS metric, rule AS field, day, 1 AS value, ms FROM risk_l WHERE rule IS NOT NULL
  UNION ALL SELECT 'risk_level', lvl_label || '.count', day, 1, ms FROM risk_l WHERE lvl_label IS NOT NULL
  UNION ALL SELECT 'risk_level', lvl_label || '.amount', day, amount, ms FROM risk_l WHERE lvl_label IS NOT NULL
  UNION ALL SELECT 'risk_province_count', replace(parts[1], '省', ''), day, 1, ms FROM risk_l
    WHERE lvl IN (1, 2) AND {nb('A_APCR_NAMES')} AND len(parts) = 3
  UNION ALL SELECT 'risk_city_count', replace(parts[2], '市', ''), day, 1, ms FROM risk_l
    WHERE lvl IN (1, 2) AND {nb('A_APCR_NAMES')} AND len(parts) = 3
  UNION ALL SELECT 'risk_decision_result', decision || '.count', day, 1, ms FROM risk_l WHERE decision IS NOT NULL
  UNION ALL SELECT 'risk_decision_result', decision || '.amount', day, amount, ms FROM risk_l WHERE decision IS NOT NULL
  UNION ALL SELECT 'risk_credit_score', band || '.count', day, 1, ms FROM risk_l WHERE band IS NOT NULL
  UNION ALL SELECT 'risk_credit_score', band || '.amount', day, amount, ms FROM risk_l WHERE band IS NOT NULL
  UNION ALL SELECT 'RISK_CUSTOMER_DISTRIBUTION', ctype || '.count', day, 1, ms FROM risk_l
    WHERE {nb('Z_RESERVED_CHAR5')} AND {nb('ORDER_ID')} AND ctype IS NOT NULL
  UNION ALL SELECT 'risk_customer_type_count',
    CASE WHEN I_IS_TNH_TARUSER = 'Y' OR I_IS_YFQ_TARUSER = 'Y' OR I_IS_POS_TARUSER = 'Y' THEN 'targetCustomer'
         ELSE 'unTargetCustomer' END, day, 1, ms FROM risk_l
  UNION ALL SELECT 'risk_customer_type_count',
    CASE WHEN coalesce(C_HISAPPLY_VAR011, 0) > 0 THEN 'historyCustomer' ELSE 'newCustomer' END, day, 1, ms FROM risk_l
  UNION ALL SELECT 'risk_k_score', kband, day, 1, ms FROM risk_l WHERE kband IS NOT NULL)"""
CTE["fx_audit"] = """fx_audit AS (
  SELECT k, ms,
    CASE k % 3 WHEN 0 THEN 'SA' WHEN 1 THEN 'MA' ELSE '' END AS APPROVE_TYPE,
    CASE st WHEN 'F' THEN 'AD' WHEN 'O' THEN 'AP' ELSE 'RR' END AS A_RESULT,
    CASE WHEN k % 113 = 0 THEN ',' WHEN k % 4 = 0 THEN 'A1,B2' WHEN k % 4 = 1 THEN concat('C', CAST(k % 6 AS VARCHAR)) END
      AS A_REJECT_CODE
  FROM b)"""
CTE["audit_ok"] = f"""audit_ok AS (
  SELECT *, {day('ms')} AS day FROM fx_audit
  WHERE NOT ({nb('A_REJECT_CODE')} AND rtrim(A_REJECT_CODE, ',') = ''))"""
CTE["audit_d"] = f"""audit_d AS (
  SELECT CASE APPROVE_TYPE WHEN 'SA' THEN 'risk_system_approve' WHEN 'MA' THEN 'risk_manual_approve' END AS metric,
         CASE A_RESULT WHEN 'AD' THEN 'refuse.count' WHEN 'AP' THEN 'pass.count' END AS field, day, 1 AS value, ms
  FROM audit_ok WHERE APPROVE_TYPE IN ('SA', 'MA') AND A_RESULT IN ('AD', 'AP')
  UNION ALL SELECT 'risk_reject_code', split_part(rtrim(A_REJECT_CODE, ','), ',', 1), day, 1, ms FROM audit_ok
  WHERE {nb('A_REJECT_CODE')})"""
CTE["ev"] = """ev AS (
  SELECT event_id, event_type, epoch_us(ts) // 1000 AS ms,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(floor(value * 100) AS BIGINT) END AS amount,
    CASE WHEN event_type = 'purchase' THEN '1G2' ELSE '9Z9' END AS busid
  FROM events)"""
CTE["fund_d"] = f"""fund_d AS (
  SELECT 'fund_count' AS metric, '' AS field, {day('ms')} AS day, 1 AS value, ms FROM ev
    WHERE event_type IN ('purchase', 'signup') AND amount IS NOT NULL AND busid = '1G2'
  UNION ALL SELECT 'fund_amount', '', {day('ms')}, amount, ms FROM ev
    WHERE event_type IN ('purchase', 'signup') AND amount IS NOT NULL AND busid = '1G2'
  UNION ALL SELECT 'fund_finacing_total_count', '', {day('ms')}, CASE WHEN busid = '1G2' THEN 1 ELSE 0 END, ms FROM ev
    WHERE event_type IN ('purchase', 'signup') AND amount IS NOT NULL
  UNION ALL SELECT 'fund_finacing_total_amount', '', {day('ms')}, amount, ms FROM ev
    WHERE event_type IN ('purchase', 'signup') AND amount IS NOT NULL AND busid = '1G2')"""
CTE["wealth_d"] = f"""wealth_d AS (
  SELECT 'Finacing_count' AS metric, '' AS field, {day('ms')} AS day, 1 AS value, ms FROM ev
    WHERE event_type = 'view' AND amount IS NOT NULL
  UNION ALL SELECT 'Finacing_amount', '', {day('ms')}, amount, ms FROM ev WHERE event_type = 'view' AND amount IS NOT NULL
  UNION ALL SELECT 'fund_finacing_total_count', '', {day('ms')}, 1, ms FROM ev WHERE event_type = 'view' AND amount IS NOT NULL
  UNION ALL SELECT 'fund_finacing_total_amount', '', {day('ms')}, amount, ms FROM ev WHERE event_type = 'view' AND amount IS NOT NULL)"""
# JN-1 on the envelopes: touches from good risk records, loans from good loan records.
CTE["te"] = f"""te AS (
  SELECT ORDER_ID AS order_id, ms AS ts, 0 AS r, concat('risk:', CAST(k AS VARCHAR)) AS rec_id, ctype AS type,
         day, NULL::BIGINT AS amount
  FROM risk_ok WHERE {nb('Z_RESERVED_CHAR5')} AND {nb('ORDER_ID')}
  UNION ALL
  SELECT orderId, ms, 1, concat('loan:', CAST(k AS VARCHAR)), NULL, day, amount FROM loan_ok WHERE {nb('orderId')})"""


def asof_ctes(src: str) -> dict:
    """JN-1 by row numbers per order (a different method from the Spark
    two-level scan): rows ``order_id, ts, r (0 touch, 1 loan), rec_id, type``."""
    return {
        "s1": f"""s1 AS (
  SELECT *, row_number() OVER w AS rn,
    max(CASE WHEN r = 0 THEN ts END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_touch
  FROM {src} WINDOW w AS (PARTITION BY order_id ORDER BY ts, r, rec_id))""",
        "s2": f"""s2 AS (
  SELECT *,
    max(CASE WHEN r = 0 AND (prev_touch IS NULL OR ts - prev_touch >= {TTL}) THEN rn END)
      OVER (PARTITION BY order_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_break,
    max(CASE WHEN r = 0 AND type IS NOT NULL THEN rn END)
      OVER (PARTITION BY order_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_set_rn,
    last_value(CASE WHEN r = 0 THEN type END IGNORE NULLS)
      OVER (PARTITION BY order_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_type
  FROM s1)""",
        "typed": f"""typed AS (
  SELECT * FROM s2
  WHERE r = 1 AND prev_touch IS NOT NULL AND ts - prev_touch < {TTL} AND last_set_rn IS NOT NULL
    AND last_set_rn >= coalesce(last_break, 0))""",
    }


CTE.update(asof_ctes("te"))
CTE["type_d"] = """type_d AS (
  SELECT 'RISK_CUSTOMER_DISTRIBUTION' AS metric, last_type || '.amount' AS field, day, amount AS value, ts AS ms FROM typed)"""

CTE["late_d"] = f"""late_d AS (
  SELECT 'RISK_CUSTOMER_DISTRIBUTION' AS metric, t.type || '.amount' AS field, l.day, l.amount AS value, l.ts AS ms
  FROM te l JOIN te t ON t.order_id = l.order_id AND t.r = 0 AND l.r = 1
  WHERE t.type IS NOT NULL AND l.ts - t.ts < {TTL})"""

DEPS = {
    "late_d": ["te"],
    "apply_ok": ["b", "fx_apply"], "apply_d": ["apply_ok"], "loan_ok": ["b", "fx_loan"], "loan_d": ["loan_ok"],
    "risk_ok": ["b", "fx_risk"], "risk_l": ["risk_ok"], "risk_d": ["risk_l"], "audit_ok": ["b", "fx_audit"],
    "audit_d": ["audit_ok"], "fund_d": ["ev"], "wealth_d": ["ev"], "te": ["risk_ok", "loan_ok"], "s1": ["te"],
    "s2": ["s1"], "typed": ["s2"], "type_d": ["typed"], "fx_apply": ["b"], "fx_loan": ["b"], "fx_risk": ["b"],
    "fx_audit": ["b"],
}


def _order(names):
    out = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(names, body: str, extra: dict | None = None) -> str:
    parts = [CTE[n] for n in _order(names)]
    if extra:
        parts += list(extra.values())
    return "WITH " + ",\n".join(parts) + "\n" + body


def _in(metrics) -> str:
    return "(" + ", ".join(f"'{m}'" for m in metrics) + ")"


def totals_sql(sources, metrics=None) -> str:
    union = " UNION ALL ".join(f"SELECT metric, field, day, value FROM {s}" for s in sources)
    where = f"WHERE metric IN {_in(metrics)}" if metrics else f"WHERE metric IN {_in(cat.METRICS)}"
    body = f"""SELECT metric, field, day, CAST(sum(value) AS BIGINT) AS value FROM ({union}) d {where}
GROUP BY metric, field, day"""
    return with_ctes(sources, body)


ALL_SOURCES = ["apply_d", "loan_d", "risk_d", "audit_d", "fund_d", "wealth_d", "type_d"]


def _oracles() -> dict:
    o = {
        "apply_by_province": totals_sql(["apply_d"], ["province_apply_count"]),
        "apply_by_city": totals_sql(["apply_d"], ["city_apply_count"]),
        "apply_by_channel": totals_sql(["apply_d"], ["risk_channel"]),
        "apply_daily": totals_sql(["apply_d"], ["daily_apply_count", "daily_apply_amount"]),
        "apply_two_minute": totals_sql(["apply_d"], ["sub_apply_count", "sub_apply_amount"]),
        "apply_amounts": totals_sql(["apply_d"], ["daily_apply_amount"]),
        "apply_metrics": totals_sql(["apply_d"], cat.APPLY_METRICS),
        "loan_metrics": totals_sql(["loan_d", "type_d"]),
        "fund_metrics": totals_sql(["fund_d"], cat.FUND_METRICS),
        "wealth_metrics": totals_sql(["wealth_d"], cat.WEALTH_METRICS),
        "audit_metrics": totals_sql(["audit_d"], cat.AUDIT_METRICS),
        "audit_decisions": totals_sql(["audit_d"], ["risk_system_approve", "risk_manual_approve"]),
        "audit_reject_codes": totals_sql(["audit_d"], ["risk_reject_code"]),
        "risk_metrics": totals_sql(["risk_d"], cat.RISK_METRICS),
        "risk_rule_hits": totals_sql(["risk_d"], ["RISK_REJECT_REASON"]),
        "risk_level": totals_sql(["risk_d"], ["risk_level"]),
        "risk_area": totals_sql(["risk_d"], ["risk_province_count", "risk_city_count"]),
        "risk_decision": totals_sql(["risk_d"], ["risk_decision_result"]),
        "risk_score_band": totals_sql(["risk_d"], ["risk_credit_score"]),
        "risk_k_score": totals_sql(["risk_d"], ["risk_k_score"]),
        "risk_customer_type": totals_sql(["risk_d"], ["risk_customer_type_count"]),
        "risk_customer_mix": totals_sql(["risk_d"], ["RISK_CUSTOMER_DISTRIBUTION"]),
        "all_metrics": totals_sql(ALL_SOURCES),
    }
    return o



def _ms_sql(text: str) -> str:
    return f"epoch_ms(TIMESTAMP '{text}')"


CTE["fx_bad"] = """fx_bad AS (SELECT event_id FROM events WHERE event_type = 'error')"""
CTE["recs"] = f"""recs AS (
  SELECT 'apply' AS kind, concat('apply:', CAST(k AS VARCHAR)) AS record_key,
    CASE WHEN applyamt IS NULL THEN 'apply: missing applyamt'
         WHEN NOT ({blank('applyamt')} OR {is_int('applyamt')}) THEN 'apply: applyamt is not an integer' END AS reason,
    'generalApply_CreditLoan' AS log_no, CAST(ms AS VARCHAR) AS time_text
  FROM fx_apply
  UNION ALL SELECT 'loan', concat('loan:', CAST(k AS VARCHAR)),
    CASE WHEN capitalAmount IS NULL THEN 'loan: missing capitalAmount'
         WHEN NOT ({blank('capitalAmount')} OR {is_int('capitalAmount')}) THEN 'loan: capitalAmount is not an integer' END,
    'CreditLoan_WorkFlow_LoanAmount', CAST(ms AS VARCHAR)
  FROM fx_loan
  UNION ALL SELECT 'risk', concat('risk:', CAST(k AS VARCHAR)),
    CASE WHEN {nb('Z_RESULT_VAR104')} AND TRY_CAST(Z_RESULT_VAR104 AS FLOAT) IS NULL THEN 'risk: Z_RESULT_VAR104 is not a number'
         WHEN {nb('Z_RESULT_VAR030')} AND TRY_CAST(Z_RESULT_VAR030 AS DOUBLE) IS NULL THEN 'risk: Z_RESULT_VAR030 is not a number' END,
    'RiskControl_SP_Result', CAST(ms AS VARCHAR)
  FROM fx_risk
  UNION ALL SELECT 'audit', concat('audit:', CAST(k AS VARCHAR)),
    CASE WHEN {nb('A_REJECT_CODE')} AND rtrim(A_REJECT_CODE, ',') = '' THEN 'audit: reject code has no part' END,
    'CreditLoan_WorkFlow_AuditResult', CAST(ms AS VARCHAR)
  FROM fx_audit
  UNION ALL SELECT 'fund', concat('fund:', CAST(event_id AS VARCHAR)), CASE WHEN amount IS NULL THEN 'fund: missing amount' END,
    'Fund_Market_Subscribe', CAST(ms AS VARCHAR)
  FROM ev WHERE event_type IN ('purchase', 'signup')
  UNION ALL SELECT 'wealth', concat('wealth:', CAST(event_id AS VARCHAR)), CASE WHEN amount IS NULL THEN 'wealth: missing amount' END,
    'Finacing_Transaction_Subscribe', CAST(ms AS VARCHAR)
  FROM ev WHERE event_type = 'view'
  UNION ALL SELECT 'unknown', concat('other:', CAST(event_id AS VARCHAR)), NULL, 'Other', CAST(ms AS VARCHAR) FROM ev WHERE event_type = 'click'
  UNION ALL SELECT CASE WHEN event_id % 4 = 0 THEN 'unknown' ELSE 'risk' END, concat('bad:', CAST(event_id AS VARCHAR)),
    CASE event_id % 4 WHEN 0 THEN 'malformed json' WHEN 3 THEN 'risk: history counts out of range'
    ELSE 'collectTime out of range' END, CASE WHEN event_id % 4 <> 0 THEN 'RiskControl_SP_Result' END,
    CASE event_id % 4 WHEN 1 THEN CAST(ms * 1000000 AS VARCHAR) WHEN 2 THEN '9223372036854775807' WHEN 3 THEN CAST(ms AS VARCHAR) END FROM ev WHERE event_type = 'error')"""
DEPS["recs"] = ["fx_apply", "fx_loan", "fx_risk", "fx_audit", "ev"]

# FX-DETAIL and the backfill rules.
CTE["dapply"] = f"""dapply AS (
  SELECT ms, strftime(epoch_ms(ms), '%Y-%m-%d %H:%M:%S') AS ts_text,
    CASE WHEN {blank('applyamt')} THEN 0 ELSE TRY_CAST(trim(applyamt) AS BIGINT) END AS amount,
    CASE WHEN {nb('belongProvince')} THEN belongProvince ELSE 'default' END AS province,
    CASE WHEN {nb('belongCity')} THEN replace(belongCity, '市', '') ELSE 'default' END AS city
  FROM fx_apply)"""
CTE["dloan"] = f"""dloan AS (
  SELECT ms, strftime(epoch_ms(ms), '%Y-%m-%d %H:%M:%S') AS ts_text,
    CASE WHEN {blank('capitalAmount')} THEN 0 ELSE TRY_CAST(trim(capitalAmount) AS BIGINT) END AS amount
  FROM fx_loan)"""
CTE["dev"] = """dev AS (SELECT *, strftime(epoch_ms(ms), '%Y-%m-%d %H:%M:%S') AS ts_text FROM ev)"""
DEPS.update({"dapply": ["fx_apply"], "dloan": ["fx_loan"], "dev": ["ev"]})


def backfill_d(where: str = "TRUE", name: str = "bf_d") -> str:
    """The sixteen backfill families from detail rows whose text time passes ``where``."""
    return f"""{name} AS (
  SELECT 'daily_apply_count' AS metric, '' AS field, substr(ts_text, 1, 10) AS day, 1 AS value FROM dapply
    WHERE amount IS NOT NULL AND {where}
  UNION ALL SELECT 'daily_apply_amount', '', substr(ts_text, 1, 10), amount FROM dapply WHERE amount IS NOT NULL AND {where}
  UNION ALL SELECT 'sub_apply_count', {bucket('ms')}, substr(ts_text, 1, 10), 1 FROM dapply WHERE amount IS NOT NULL AND {where}
  UNION ALL SELECT 'sub_apply_amount', {bucket('ms')}, substr(ts_text, 1, 10), amount FROM dapply WHERE amount IS NOT NULL AND {where}
  UNION ALL SELECT 'province_apply_count', province, substr(ts_text, 1, 10), 1 FROM dapply WHERE amount IS NOT NULL AND {where}
  UNION ALL SELECT 'city_apply_count', city, substr(ts_text, 1, 10), 1 FROM dapply WHERE amount IS NOT NULL AND {where}
  UNION ALL SELECT 'daily_loan_count', '', substr(ts_text, 1, 10), 1 FROM dloan WHERE amount IS NOT NULL AND {where}
  UNION ALL SELECT 'daily_loan_amount', '', substr(ts_text, 1, 10), amount FROM dloan WHERE amount IS NOT NULL AND {where}
  UNION ALL SELECT 'sub_loan_count', {bucket('ms')}, substr(ts_text, 1, 10), 1 FROM dloan WHERE amount IS NOT NULL AND {where}
  UNION ALL SELECT 'sub_loan_amount', {bucket('ms')}, substr(ts_text, 1, 10), amount FROM dloan WHERE amount IS NOT NULL AND {where}
  UNION ALL SELECT m.metric, '', substr(ts_text, 1, 10), CASE WHEN m.c THEN 1 ELSE amount END
    FROM dev, (VALUES ('fund_count', TRUE), ('fund_amount', FALSE), ('fund_finacing_total_count', TRUE),
                      ('fund_finacing_total_amount', FALSE)) m(metric, c)
    WHERE event_type IN ('purchase', 'signup') AND busid = '1G2' AND {where}
  UNION ALL SELECT m.metric, '', substr(ts_text, 1, 10), CASE WHEN m.c THEN 1 ELSE amount END
    FROM dev, (VALUES ('Finacing_count', TRUE), ('Finacing_amount', FALSE), ('fund_finacing_total_count', TRUE),
                      ('fund_finacing_total_amount', FALSE)) m(metric, c)
    WHERE event_type = 'view' AND {where})"""


def _sum_of(src: str, metrics=None) -> str:
    where = f"WHERE metric IN {_in(metrics)}" if metrics else ""
    return f"SELECT metric, field, day, CAST(sum(value) AS BIGINT) AS value FROM {src} {where} GROUP BY metric, field, day"


BF_DEPS = ["dapply", "dloan", "dev"]


def _bf(metrics, where="TRUE") -> str:
    return with_ctes(BF_DEPS, _sum_of("bf_d", metrics), {"bf_d": backfill_d(where)})


CAT_VALUES = "cat_t(metric, grp, suffix, kind) AS (VALUES " + ", ".join(
    f"('{m}', '{g}', '{sfx}', '{k}')" for m, g, sfx, k in cat.CATALOGUE) + ")"


def _all_totals_cte(name="tot", sources=None) -> str:
    union = " UNION ALL ".join(f"SELECT metric, field, day, value, ms FROM {s}" for s in sources or ALL_SOURCES)
    return f"""{name} AS (SELECT metric, field, day, CAST(sum(value) AS BIGINT) AS value, max(ms) AS last_ms
  FROM ({union}) d WHERE metric IN {_in(cat.METRICS)} GROUP BY metric, field, day)"""


def _graph_two_hop(where: str = "TRUE") -> str:
    return f"""SELECT 'c:' || c.c_custkey AS a_id, c.c_name AS a_c_name, c.c_mktsegment AS a_c_mktsegment,
  'o:' || o.o_orderkey AS b_id, o.o_orderstatus AS b_o_orderstatus, 'p:' || p.p_partkey AS c_id, p.p_name AS c_p_name,
  CAST(l.l_linenumber AS VARCHAR) AS e2_l_linenumber
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey WHERE {where}"""


def _more() -> dict:
    o = {}
    o["route_counts"] = with_ctes(["recs"], """SELECT kind, CASE WHEN reason IS NULL THEN 'good' ELSE 'bad' END AS status,
  count(*) AS records FROM recs GROUP BY 1, 2""")
    o["good_bad_split"] = with_ctes(["recs"], "SELECT kind, reason, count(*) AS records FROM recs WHERE reason IS NOT NULL GROUP BY 1, 2")
    o["dead_letters"] = with_ctes(["recs"], f"""SELECT '{cat.TASK_NAME}' AS task_name, reason AS exception_info,
  record_key, log_no, time_text FROM recs WHERE reason IS NOT NULL""")
    fields = ["lbsProvince", "belongProvince", "lbsCity", "belongCity", "applyamt", "channelcode", "channelsource"]
    o["blank_fields"] = with_ctes(["fx_apply"], " UNION ALL ".join(
        f"SELECT '{f}' AS field, CAST(sum(CASE WHEN {blank(f)} THEN 1 ELSE 0 END) AS BIGINT) AS blanks FROM fx_apply" for f in fields))
    o["payload_fields"] = with_ctes(["fx_audit"], f"""SELECT concat('audit:', CAST(k AS VARCHAR)) AS record_key,
  'CreditLoan_WorkFlow_AuditResult' AS log_no, ms AS collect_ms, {day('ms')} AS day, APPROVE_TYPE AS approve_type,
  A_RESULT AS a_result, A_REJECT_CODE AS a_reject_code FROM fx_audit""")
    te2 = f"""te2 AS (
  SELECT ORDER_ID AS order_id, ms AS ts, 0 AS r, k * 10 AS rec_id, ctype AS type, NULL::BIGINT AS amount
  FROM risk_ok2 WHERE {nb('Z_RESERVED_CHAR5')} AND {nb('ORDER_ID')}
  UNION ALL SELECT ORDER_ID, ms - 60000 + 4 * 86400000, 0, k * 10 + 1, NULL, NULL FROM risk_ok2 WHERE k % 4 = 0 AND k % 19 <> 0
  UNION ALL SELECT ORDER_ID, ms - 60000 + 3 * 86400000, 0, k * 10 + 2, 'new', NULL FROM risk_ok2 WHERE k % 6 = 0 AND k % 19 <> 0
  UNION ALL SELECT orderId, ms, 1, k * 10 + 3, NULL, CAST(capitalAmount AS BIGINT) FROM fx_loan
    WHERE orderId IS NOT NULL AND capitalAmount IS NOT NULL)"""
    risk2 = """risk_ok2 AS (SELECT *, CASE Z_RESERVED_CHAR5 WHEN 'N' THEN 'new' WHEN 'J1' THEN 'settle.one'
  WHEN 'J2' THEN 'settle.two' WHEN 'Z1' THEN 'transit.one' WHEN 'Z2' THEN 'transit.two' END AS ctype FROM fx_risk)"""
    a2 = asof_ctes("te2")
    o["loan_type_asof"] = with_ctes(["fx_risk", "fx_loan"], """SELECT last_type AS type, count(*) AS loans,
  CAST(sum(amount) AS BIGINT) AS amount FROM typed GROUP BY 1""", {"risk_ok2": risk2, "te2": te2, **a2})
    lo, hi = Q.DETAIL_RANGE
    o["detail_time_range"] = with_ctes(["dapply"], f"""SELECT amount, ts_text, province, city,
  CASE WHEN amount IS NULL THEN 'backfill: amount is not an integer' END AS err
  FROM dapply WHERE ts_text >= '{lo}' AND ts_text < '{hi}'""")
    o["backfill_apply_daily"] = _bf(["daily_apply_count", "daily_apply_amount"])
    o["backfill_loan_daily"] = _bf(["daily_loan_count", "daily_loan_amount"])
    o["backfill_two_minute"] = _bf(["sub_apply_count", "sub_apply_amount", "sub_loan_count", "sub_loan_amount"])
    o["backfill_area"] = _bf(["province_apply_count", "city_apply_count"])
    o["backfill_fund_daily"] = _bf(["fund_count", "fund_amount"])
    o["backfill_wealth_daily"] = _bf(["Finacing_count", "Finacing_amount"])
    o["backfill_total_daily"] = _bf(["fund_finacing_total_count", "fund_finacing_total_amount"])
    cut = Q.CUTOVER_TEXT
    live_union = " UNION ALL ".join(
        f"SELECT metric, field, day, value FROM {s} WHERE ms >= {_ms_sql(cut)}" for s in ["apply_d", "loan_d", "fund_d", "wealth_d"])
    o["lambda_merge"] = with_ctes(BF_DEPS + ["apply_d", "loan_d", "fund_d", "wealth_d"], f"""SELECT metric, field, day,
  CAST(sum(value) AS BIGINT) AS value FROM (SELECT metric, field, day, value FROM bf_d UNION ALL {live_union}) u
  WHERE metric IN {_in(cat.BACKFILL_METRICS)} GROUP BY metric, field, day""", {"bf_d": backfill_d(f"ts_text < '{cut}'")})
    o["cutover_min"] = with_ctes(["fx_apply", "fx_loan", "fx_risk", "fx_audit", "ev"], """SELECT min(ms) AS cutover_ms,
  strftime(epoch_ms(min(ms)), '%Y-%m-%d %H:%M:%S') AS cutover_text FROM (SELECT ms FROM fx_apply UNION ALL SELECT ms FROM fx_loan
  UNION ALL SELECT ms FROM fx_risk UNION ALL SELECT ms FROM fx_audit UNION ALL SELECT ms FROM ev WHERE event_type <> 'error') t""")
    o["cutover_points"] = with_ctes(["fx_apply", "fx_loan", "fx_risk", "fx_audit", "ev"], f"""SELECT source, min(ms) AS cutover_ms FROM (
  SELECT '{cat.LOG_APPLY}' AS source, ms FROM fx_apply UNION ALL SELECT '{cat.LOG_LOAN}', ms FROM fx_loan
  UNION ALL SELECT '{cat.LOG_RISK}', ms FROM fx_risk UNION ALL SELECT '{cat.LOG_AUDIT}', ms FROM fx_audit
  UNION ALL SELECT CASE event_type WHEN 'view' THEN '{cat.LOG_WEALTH}' WHEN 'click' THEN 'Other' WHEN 'error' THEN '{cat.LOG_RISK}'
    ELSE '{cat.LOG_FUND}' END, ms FROM ev WHERE event_type <> 'error' OR event_id % 4 = 3) t GROUP BY 1""")
    d = Q.RESTATE_DAY
    d_prev = (_dt.date.fromisoformat(d) - _dt.timedelta(days=1)).isoformat()
    clean = _in(cat.CLEAN_METRICS)
    o["restate_days"] = with_ctes(BF_DEPS + ALL_SOURCES, f"""SELECT metric, field, day, value FROM tot
  WHERE NOT (day IN ('{d}', '{d_prev}') AND metric IN {clean})
UNION ALL SELECT metric, field, day, CAST(sum(value) AS BIGINT) FROM bf_d
  WHERE day IN ('{d}', '{d_prev}') AND metric IN {clean} GROUP BY metric, field, day""",
        {"tot": _all_totals_cte(), "bf_d": backfill_d(f"ts_text >= '{d_prev} 00:00:00'")})
    fam = {"cat_t": CAT_VALUES, "tot": _all_totals_cte()}
    o["counters_current"] = with_ctes(ALL_SOURCES, """SELECT grp || '.' || suffix AS family, field, day, value
  FROM tot JOIN cat_t USING (metric)""", fam)
    as_of = _dt.datetime.strptime(Q.RETENTION_AS_OF, "%Y-%m-%d %H:%M:%S") - _dt.timedelta(days=32)
    o["counters_retained"] = with_ctes(ALL_SOURCES, f"""SELECT grp || '.' || suffix AS family, field, day, value
  FROM (SELECT *, max(last_ms) OVER (PARTITION BY day, metric) AS grp_last FROM tot) t JOIN cat_t USING (metric)
  WHERE grp_last > {_ms_sql(as_of.strftime('%Y-%m-%d %H:%M:%S'))}""", fam)
    o["lookup_hash"] = with_ctes(["risk_d"], "SELECT day, field, CAST(sum(value) AS BIGINT) AS value FROM risk_d "
                                             "WHERE metric = 'risk_level' GROUP BY day, field")
    o["lookup_day"] = with_ctes(["risk_d"], "SELECT field, CAST(sum(value) AS BIGINT) AS value FROM risk_d "
                                            f"WHERE metric = 'risk_province_count' AND day = '{Q.RESTATE_DAY}' GROUP BY field")
    o["counter_names"] = with_ctes(ALL_SOURCES, f"""SELECT 'dataPlatform.' || grp || '.' || day || '.' || suffix || '{Q.NAMESPACE_TEST}'
  AS counter_name, kind, field, value FROM tot JOIN cat_t USING (metric)""", fam)
    o["graph_pattern"] = """SELECT 'c:' || c.c_custkey AS a_id, c.c_name AS a_c_name, 'o:' || o.o_orderkey AS b_id,
  o.o_orderstatus AS b_o_orderstatus, o.o_orderpriority AS b_o_orderpriority
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""
    o["graph_two_hop"] = _graph_two_hop()
    o["graph_key_filter"] = _graph_two_hop("c.c_acctbal > 0")
    o["graph_any_key"] = _graph_two_hop("""c.c_acctbal > 0 OR regexp_matches('p:' || p.p_partkey, '^p:1[0-4]')
  OR l.l_linenumber BETWEEN 6 AND 11""")
    o["key_list_scan"] = "SELECT 'c:' || c_custkey AS key FROM customer WHERE c_acctbal > 0"
    o["entity_projection"] = """SELECT 'o:' || o_orderkey AS b_id, CAST(o_custkey AS VARCHAR) AS b_o_custkey,
  o_orderstatus AS b_o_orderstatus, o_orderpriority AS b_o_orderpriority FROM orders"""
    o["csv_round_trip"] = _graph_two_hop()
    o["export_page"] = (f"SELECT * FROM ({_graph_two_hop()}) t ORDER BY a_id, b_id, c_id, e2_l_linenumber "
                        f"LIMIT {Q.PAGE_SIZE} OFFSET {Q.PAGE_START}")
    o["row_to_json"] = """SELECT c_custkey, NULLIF(c_name, '') AS c_name, NULLIF(c_mktsegment, '') AS c_mktsegment, c_nationkey
FROM customer"""
    return o


ORACLES = _oracles()
ORACLES.update(_more())


def _stream_oracles() -> dict:
    o = {}
    o["stream_counters"] = o["stream_replay"] = totals_sql(ALL_SOURCES)
    # Loans after everything else: an order's only touch, if the loan is less than the TTL after it.
    o["stream_late_loans"] = totals_sql(["apply_d", "loan_d", "risk_d", "audit_d", "fund_d", "wealth_d", "late_d"])
    o["stream_resume"] = o["stream_counters"]
    # The loans of days that had ended LATENESS_DAYS before the newest other record are lost.
    union = " UNION ALL ".join(f"SELECT metric, field, day, value, ms FROM {x}" for x in ALL_SOURCES[:-1] if x != "loan_d")
    closed = f"((ms // 86400000 + 1) * 86400000 <= (SELECT max(ms) FROM others) - {LATENESS_DAYS * 86400000})"
    o["stream_bounded"] = with_ctes(ALL_SOURCES[:-1], f"""SELECT metric, field, day, CAST(sum(value) AS BIGINT) AS value FROM (
  SELECT metric, field, day, value FROM others UNION ALL SELECT metric, field, day, value FROM loan_d WHERE NOT {closed}) t
WHERE metric IN {_in(cat.METRICS)} GROUP BY metric, field, day
UNION ALL SELECT 'lost', '', '', count(*) FROM loan_d WHERE {closed}""",
        {"others": f"others AS (SELECT * FROM ({union}) x WHERE metric IN {_in(cat.METRICS)})"})
    as_of = _dt.datetime.strptime(Q.RETENTION_AS_OF, "%Y-%m-%d %H:%M:%S") - _dt.timedelta(days=32)
    o["stream_housekeeping"] = with_ctes(ALL_SOURCES[:-1], f"""SELECT grp || '.' || suffix AS family, field, day, value
  FROM (SELECT *, max(last_ms) OVER (PARTITION BY day, metric) AS grp_last FROM tot) t JOIN cat_t USING (metric)
  WHERE grp_last > {_ms_sql(as_of.strftime('%Y-%m-%d %H:%M:%S'))}""", {"cat_t": CAT_VALUES, "tot": _all_totals_cte(sources=ALL_SOURCES[:-1])})
    o["stream_two_minute"] = totals_sql(["apply_d", "loan_d"], ["sub_apply_count", "sub_apply_amount", "sub_loan_count", "sub_loan_amount"])
    o["stream_dead_letters"] = ORACLES["dead_letters"]
    o["stream_loan_type"] = ORACLES["loan_type_asof"]
    return o


ORACLES.update(_stream_oracles())
