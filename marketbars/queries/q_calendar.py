"""Calendar queries: the orders' date span, rebased onto the holiday calendar's
year, split into trading days and skipped (weekend / holiday) days."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketbars.operators.calendar import classify_days, date_span, holidays, TRADING
from marketbars.queries import query, table
from marketbars.schemas import HOLIDAYS_2026

REBASE_MONTHS = 372   # 31 years: the orders' span lands on the 2026 calendar


def calendar_days(spark, sf):
    o = table(spark, sf, "orders")
    span = o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    dates = span.select(F.explode(date_span(F.add_months(F.to_date("lo"), REBASE_MONTHS),
                                            F.add_months(F.to_date("hi"), REBASE_MONTHS))).alias("date"))
    return classify_days(dates, holidays(spark))


_HOL = ", ".join(f"(DATE '{d}', '{n}')" for d, n in HOLIDAYS_2026)
CAL_SQL = f"""
WITH span AS (SELECT CAST(CAST(min(o_orderdate) AS DATE) + INTERVAL 31 YEAR AS DATE) AS lo,
                     CAST(CAST(max(o_orderdate) AS DATE) + INTERVAL 31 YEAR AS DATE) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
h AS (SELECT * FROM (VALUES {_HOL}) t(date, holiday_name)),
c AS (SELECT d.date, h.holiday_name, CAST(isodow(d.date) - 1 AS INTEGER) AS weekday,
        CASE WHEN isodow(d.date) >= 6 THEN 'weekend' WHEN h.holiday_name IS NOT NULL THEN 'holiday'
             ELSE 'trading' END AS status
      FROM d LEFT JOIN h ON d.date = h.date)"""


@query("trading_days", CAL_SQL + " SELECT date, weekday FROM c WHERE status = 'trading'")
def q_trading_days(spark, sf):
    return calendar_days(spark, sf).where(F.col("status") == TRADING).select("date", "weekday")


@query("skipped_days", CAL_SQL + " SELECT date, weekday, status, holiday_name FROM c WHERE status <> 'trading'")
def q_skipped_days(spark, sf):
    return (calendar_days(spark, sf).where(F.col("status") != TRADING)
            .select("date", "weekday", "status", "holiday_name"))
