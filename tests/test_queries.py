"""Registered queries against their DuckDB oracles on sf0.001, and the
stream = batch and replay checks."""

import hashlib

import duckdb
import pytest

from creditpulse.plans.oracle import ORACLES
from creditpulse.plans.registry import QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()
FAST = [
    "apply_metrics", "loan_metrics", "fund_metrics", "wealth_metrics", "audit_metrics", "risk_metrics",
    "route_counts", "good_bad_split", "blank_fields", "loan_type_asof", "backfill_two_minute", "backfill_area",
    "backfill_total_daily", "lambda_merge", "cutover_min", "counter_names", "graph_key_filter", "entity_projection",
    "export_page", "row_to_json", "csv_round_trip", "restate_days", "lookup_day", "cutover_points",
]


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(r[i] for i in order)) for r in rows)
    return sorted(cols), hashlib.md5("\n".join(lines).encode()).hexdigest(), len(lines)


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(ORACLES)
    assert not missing, missing


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    got = digest([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(ORACLES[name])
    want = digest(res.fetchall(), [d[0] for d in res.description])
    assert got == want


@pytest.mark.parametrize("name", ["stream_replay", "stream_housekeeping", "stream_bounded", "stream_resume"])
def test_stream_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    res = duck.execute(ORACLES[name])
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(res.fetchall(), [d[0] for d in res.description])


def test_stream_order_type(spark, duck, sf_small):
    from creditpulse.plans import stream_queries as S

    df = S.stream_loan_type(spark, sf_small)
    res = duck.execute(ORACLES["stream_loan_type"])
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(res.fetchall(), [d[0] for d in res.description])


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["metric", "field", "day", "value"]
    assert df.count() > 0
