"""Backfill job: counters recomputed from detail tables and merged with the
live ones at a cut-over time (lambda style).

Reference quirks fixed here: a blank amount counts as 0 and a blank place
as ``default`` (instead of the previous row's value); a second run does not
double count, because the merge recomputes totals instead of adding; the
cut-over is compared in milliseconds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditpulse.functions.text import is_blank, java_trim, strip_token, first_non_blank
from creditpulse.functions.timefn import (
    TWO_MINUTES_MS,
    bucket_end,
    date_prefix,
    drop_fraction,
    text_to_ms,
)
from creditpulse.operators.rollup import sum_deltas, union_all
from creditpulse.sources.detail import read_daily_totals, read_detail

CITY_TOKEN = "市"


def _amount(raw: Column) -> Column:
    return F.when(is_blank(raw), F.lit(0).cast("bigint")).otherwise(java_trim(raw).try_cast("bigint"))


def apply_rows(detail: DataFrame, start=None, end=None) -> DataFrame:
    """Apply detail -> ``amount, ts_text, province, city, err``."""
    d = read_detail(detail, "collecttimefmt", start, end)
    amount = _amount(F.col("applyamt"))
    return d.select(
        amount.alias("amount"),
        drop_fraction(F.col("collecttimefmt")).alias("ts_text"),
        first_non_blank(F.col("belongprovince")).alias("province"),
        F.coalesce(
            strip_token(F.when(~is_blank(F.col("belongcity")), F.col("belongcity")), CITY_TOKEN), F.lit("default")
        ).alias("city"),
        F.when(amount.isNull(), F.lit("backfill: amount is not an integer")).alias("err"),
    )


def loan_rows(detail: DataFrame, start=None, end=None) -> DataFrame:
    """Loan detail -> ``amount, ts_text, err``."""
    d = read_detail(detail, "collecttime", start, end)
    amount = _amount(F.col("capitalamount"))
    return d.select(
        amount.alias("amount"),
        drop_fraction(F.col("collecttime")).alias("ts_text"),
        F.when(amount.isNull(), F.lit("backfill: amount is not an integer")).alias("err"),
    )


def _metrics(df: DataFrame, day: Column, items) -> DataFrame:
    """Unpivot aggregate columns into ``metric, field, day, value`` rows."""
    arr = F.array(*[
        F.struct(F.lit(m).alias("metric"), f.alias("field"), day.alias("day"), v.cast("bigint").alias("value"))
        for m, f, v in items
    ])
    return df.select(F.inline(arr))


def daily_totals(rows: DataFrame, count_metric: str, amount_metric: str) -> DataFrame:
    """AG-2: count and amount by day."""
    good = rows.where(F.col("err").isNull())
    agg = good.groupBy(date_prefix(F.col("ts_text")).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )
    return _metrics(agg, F.col("day"), [(count_metric, F.lit(""), F.col("n")), (amount_metric, F.lit(""), F.col("amount"))])


def bucket_totals(rows: DataFrame, count_metric: str, amount_metric: str, tz: str = "UTC",
                  width_ms: int = TWO_MINUTES_MS) -> DataFrame:
    """AG-3: count and amount by (bucket end, day)."""
    good = rows.where(F.col("err").isNull())
    agg = good.groupBy(
        bucket_end(text_to_ms(F.col("ts_text"), tz), width_ms).cast("string").alias("bucket"),
        date_prefix(F.col("ts_text")).alias("day"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    return _metrics(agg, F.col("day"), [(count_metric, F.col("bucket"), F.col("n")), (amount_metric, F.col("bucket"), F.col("amount"))])


def area_totals(rows: DataFrame) -> DataFrame:
    """AG-4: apply count by (province, day) and by (city, day), one pass
    with grouping sets."""
    good = rows.where(F.col("err").isNull()).select("province", "city", date_prefix(F.col("ts_text")).alias("day"))
    agg = good.groupingSets([["province", "day"], ["city", "day"]], "province", "city", "day").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("city").alias("by_province")
    )
    return agg.select(
        F.when(F.col("by_province") == 1, F.lit("province_apply_count")).otherwise(F.lit("city_apply_count")).alias("metric"),
        F.when(F.col("by_province") == 1, F.col("province")).otherwise(F.col("city")).alias("field"),
        "day",
        F.col("n").cast("bigint").alias("value"),
    )


def fund_totals(fund_detail: DataFrame, start=None, end=None) -> DataFrame:
    """AG-5 fund: ``busid = '1G2'``, count and amount by date prefix."""
    d = read_detail(fund_detail, "collecttime", start, end)
    agg = read_daily_totals(d, "collecttime", "amount", where=F.col("busid") == F.lit("1G2"))
    return _metrics(agg, F.col("day"), [("fund_count", F.lit(""), F.col("count")), ("fund_amount", F.lit(""), F.col("amount"))])


def wealth_totals(wealth_detail: DataFrame, start=None, end=None) -> DataFrame:
    d = read_detail(wealth_detail, "collecttime", start, end)
    agg = read_daily_totals(d, "collecttime", "amount")
    return _metrics(agg, F.col("day"), [("Finacing_count", F.lit(""), F.col("count")), ("Finacing_amount", F.lit(""), F.col("amount"))])


def combined_totals(fund: DataFrame, wealth: DataFrame) -> DataFrame:
    """ST-2: fund ∪ wealth into the total families."""
    rename = {"fund_count": "fund_finacing_total_count", "Finacing_count": "fund_finacing_total_count",
              "fund_amount": "fund_finacing_total_amount", "Finacing_amount": "fund_finacing_total_amount"}
    mapping = F.create_map(*[x for k, v in rename.items() for x in (F.lit(k), F.lit(v))])
    both = fund.unionByName(wealth).withColumn("metric", mapping[F.col("metric")])
    return sum_deltas(both)


def _fan_out(rows: DataFrame, items) -> DataFrame:
    """Every row's own deltas; one read of the rows serves all families."""
    return _metrics(rows, F.col("_day"), items)


def apply_deltas(rows: DataFrame, tz: str = "UTC") -> DataFrame:
    """The six apply families of each good detail row (AG-2, AG-3, AG-4)."""
    good = rows.where(F.col("err").isNull()).withColumn("_day", date_prefix(F.col("ts_text")))
    none, one, bucket = F.lit(""), F.lit(1), bucket_end(text_to_ms(F.col("ts_text"), tz)).cast("string")
    return _fan_out(good, [
        ("daily_apply_count", none, one), ("daily_apply_amount", none, F.col("amount")),
        ("sub_apply_count", bucket, one), ("sub_apply_amount", bucket, F.col("amount")),
        ("province_apply_count", F.col("province"), one), ("city_apply_count", F.col("city"), one)])


def loan_deltas(rows: DataFrame, tz: str = "UTC") -> DataFrame:
    good = rows.where(F.col("err").isNull()).withColumn("_day", date_prefix(F.col("ts_text")))
    none, one, bucket = F.lit(""), F.lit(1), bucket_end(text_to_ms(F.col("ts_text"), tz)).cast("string")
    return _fan_out(good, [
        ("daily_loan_count", none, one), ("daily_loan_amount", none, F.col("amount")),
        ("sub_loan_count", bucket, one), ("sub_loan_amount", bucket, F.col("amount"))])


def money_deltas(detail: DataFrame, count_metric: str, amount_metric: str) -> DataFrame:
    """AG-5 + ST-2: a subscription's own families and the combined ones."""
    none, one, amount = F.lit(""), F.lit(1), F.col("amount").cast("bigint")
    return _fan_out(detail.withColumn("_day", date_prefix(F.col("collecttime"))), [
        (count_metric, none, one), (amount_metric, none, amount),
        ("fund_finacing_total_count", none, one), ("fund_finacing_total_amount", none, amount)])


def backfill(apply_detail, loan_detail, fund_detail, wealth_detail, start=None, end=None, tz: str = "UTC") -> DataFrame:
    """All sixteen backfill families for ``[start, end)``: every detail table is
    read once, its rows fan out into deltas, and one aggregation sums them."""
    fund = read_detail(fund_detail, "collecttime", start, end).where(F.col("busid") == F.lit("1G2"))
    wealth = read_detail(wealth_detail, "collecttime", start, end)
    return sum_deltas(union_all([
        apply_deltas(apply_rows(apply_detail, start, end), tz),
        loan_deltas(loan_rows(loan_detail, start, end), tz),
        money_deltas(fund, "fund_count", "fund_amount"),
        money_deltas(wealth, "Finacing_count", "Finacing_amount"),
    ]))


def merge_live(backfilled: DataFrame, live_deltas: DataFrame) -> DataFrame:
    """ST-1: history before the cut-over plus live counts after it.

    Both inputs are already cut at the cut-over; the result is recomputed,
    so running the merge twice gives the same totals.
    """
    return sum_deltas(backfilled.unionByName(live_deltas.select("metric", "field", "day", "value")))


def min_cutover(points: DataFrame) -> DataFrame:
    """AG-6: the earliest pointer."""
    return points.agg(F.min("cutover_ms").alias("cutover_ms"))


def _shift(day: str, days: int) -> str:
    return (dt.date.fromisoformat(day) + dt.timedelta(days=days)).isoformat()


def restate_range(day: str) -> tuple[str, str]:
    """Half-open time range of the two days that a restatement recomputes."""
    return f"{_shift(day, -1)} 00:00:00", f"{_shift(day, 1)} 00:00:00"
