"""Quality, duplicate and routing queries over hourly bars built from events.

The bars carry the 13 options columns. Faults are injected deterministically
from each bar's own volume so that every check has something to find: missing
Open, swapped High/Low, invalid and missing OptionType, duplicated keys,
non-positive strikes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketbars.operators.quality import duplicate_count, ohlc_violation, quality_report
from marketbars.operators.routing import exchange_dim, exchange_split_counts, route_exchange
from marketbars.functions.timefmt import hour_start
from marketbars.queries import query, table
from marketbars.schemas import OPTIONS_COLUMNS

# event type -> index used for the bars (error maps to an unconfigured index)
TYPE_INDEX = {"click": "NIFTY", "view": "NIFTY", "purchase": "BANKNIFTY",
              "signup": "SENSEX", "error": "FINNIFTY"}


def event_bars(spark, sf):
    ev = table(spark, sf, "events")
    hour = hour_start(F.col("ts"))
    b = ev.groupBy("event_type", hour.alias("hour")).agg(
        F.min_by("value", "ts").alias("o"), F.max("value").alias("hi"),
        F.min("value").alias("lo"), F.max_by("value", "ts").alias("c"),
        F.count(F.lit(1)).alias("v"), F.sum("user_id").alias("oi"))
    v = F.col("v")
    swap = v % 7 == 0
    idx = F.create_map(*[x for k, i in TYPE_INDEX.items() for x in (F.lit(k), F.lit(i))])
    return b.select(
        F.concat(F.lit("EV:"), F.upper("event_type")).alias("Ticker"),
        F.to_date("hour").alias("Date"),
        F.when(v % 5 == 0, F.lit("00:00:00")).otherwise(F.date_format("hour", "HH:mm:ss")).alias("Time"),
        F.when(v % 17 != 0, F.col("o")).alias("Open"),
        F.when(swap, F.col("lo")).otherwise(F.col("hi")).alias("High"),
        F.when(swap, F.col("hi")).otherwise(F.col("lo")).alias("Low"),
        F.col("c").alias("Close"), v.cast("bigint").alias("Volume"),
        F.col("oi").cast("bigint").alias("OpenInterest"),
        F.try_element_at(idx, F.col("event_type")).alias("Underlying"),
        F.date_add(F.to_date("hour"), 3).alias("Expiry"),
        ((F.hour("hour") - 2) * 50).cast("int").alias("Strike"),
        F.when(v % 11 == 0, F.lit("XX")).when(v % 13 == 0, F.lit(None))
         .when(v % 2 == 0, F.lit("CE")).otherwise(F.lit("PE")).alias("OptionType"))


BARS_SQL = """
b AS (
  SELECT event_type, date_trunc('hour', ts) AS hour, arg_min(value, ts) AS o, max(value) AS hi,
         min(value) AS lo, arg_max(value, ts) AS c, count(*) AS v, sum(user_id) AS oi
  FROM events GROUP BY 1, 2),
bars AS (
  SELECT 'EV:' || upper(event_type) AS Ticker, CAST(hour AS DATE) AS Date,
    CASE WHEN v % 5 = 0 THEN '00:00:00' ELSE strftime(hour, '%H:%M:%S') END AS Time,
    CASE WHEN v % 17 = 0 THEN NULL ELSE o END AS Open,
    CASE WHEN v % 7 = 0 THEN lo ELSE hi END AS High,
    CASE WHEN v % 7 = 0 THEN hi ELSE lo END AS Low,
    c AS Close, CAST(v AS BIGINT) AS Volume, CAST(oi AS BIGINT) AS OpenInterest,
    CASE event_type WHEN 'click' THEN 'NIFTY' WHEN 'view' THEN 'NIFTY' WHEN 'purchase' THEN 'BANKNIFTY'
                    WHEN 'signup' THEN 'SENSEX' WHEN 'error' THEN 'FINNIFTY' END AS Underlying,
    CAST(CAST(hour AS DATE) + 3 AS DATE) AS Expiry,
    CAST((hour(hour) - 2) * 50 AS INTEGER) AS Strike,
    CASE WHEN v % 11 = 0 THEN 'XX' WHEN v % 13 = 0 THEN NULL WHEN v % 2 = 0 THEN 'CE' ELSE 'PE' END AS OptionType
  FROM b)"""

_DOUBLES = {"Open", "High", "Low", "Close"}


def _missing_sql(c):
    cond = f"{c} IS NULL OR isnan({c})" if c in _DOUBLES else f"{c} IS NULL"
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS missing_{c}"


def _report_sql(group: str | None, source: str) -> str:
    g = f"{group}, " if group else ""
    missing = ",\n  ".join(_missing_sql(c) for c in OPTIONS_COLUMNS)
    msgs = ", ".join(f"CASE WHEN missing_{c} > 0 THEN 'Missing values in {c}.' END" for c in OPTIONS_COLUMNS)
    return f"""
, agg AS (
  SELECT {g}CAST(count(*) AS BIGINT) AS rows,
  {missing},
  list_sort(list_distinct(list(OptionType) FILTER (WHERE OptionType NOT IN ('CE', 'PE')))) AS bad,
  CAST(count(*) - count(DISTINCT (Ticker, Date, Time)) AS BIGINT) AS duplicate_rows,
  CAST(count(*) FILTER (WHERE High < Low OR High < Open OR High < Close OR Low > Open OR Low > Close) AS BIGINT)
    AS ohlc_violations,
  CAST(count(*) FILTER (WHERE Strike <= 0) AS BIGINT) AS nonpositive_strikes
  FROM {source} {"GROUP BY " + group if group else ""})
SELECT * EXCLUDE (bad, errors_list), coalesce(array_to_string(bad, ','), '') AS invalid_types,
       CAST(coalesce(len(bad), 0) AS BIGINT) AS invalid_values,
       errors_list AS errors, errors_list = '' AS ok
FROM (SELECT *, concat_ws('; ', {msgs},
  CASE WHEN len(coalesce(bad, [])) > 0 THEN 'Invalid OptionType: {{' ||
       array_to_string(list_transform(bad, lambda x: '''' || x || ''''), ', ') || '}}' END,
  CASE WHEN duplicate_rows > 0 THEN 'Duplicate rows: ' || duplicate_rows END,
  CASE WHEN ohlc_violations > 0 THEN 'Invalid OHLC rows: ' || ohlc_violations END,
  CASE WHEN nonpositive_strikes > 0 THEN 'Non-positive strike price.' END) AS errors_list FROM agg)
"""


def _flatten(rep):
    return (rep.withColumn("invalid_types", F.array_join("invalid_types", ","))
               .withColumn("errors", F.array_join("errors", "; ")))


@query("quality_report", "WITH " + BARS_SQL + _report_sql(None, "bars"))
def q_quality_report(spark, sf):
    return _flatten(quality_report(event_bars(spark, sf)))


EXCHANGE_SQL = """,
ex AS (SELECT * FROM (VALUES ('NIFTY', 'NSE'), ('BANKNIFTY', 'NSE'), ('SENSEX', 'BSE')) t(Underlying, exchange)),
routed AS (SELECT bars.*, ex.exchange FROM bars JOIN ex USING (Underlying))"""


@query("quality_by_exchange", "WITH " + BARS_SQL + EXCHANGE_SQL + _report_sql("exchange", "routed"))
def q_quality_by_exchange(spark, sf):
    routed = route_exchange(event_bars(spark, sf), exchange_dim(spark))
    return _flatten(quality_report(routed.select(*OPTIONS_COLUMNS, "exchange"), group_by=["exchange"]))


@query("exchange_split", "WITH " + BARS_SQL + EXCHANGE_SQL + """
SELECT exchange, Date, CAST(count(*) AS BIGINT) AS rows,
       CASE exchange WHEN 'NSE' THEN 'options_nse.parquet' WHEN 'BSE' THEN 'options_bse.parquet' END AS file_name
FROM routed GROUP BY exchange, Date
""")
def q_exchange_split(spark, sf):
    routed = route_exchange(event_bars(spark, sf), exchange_dim(spark))
    return exchange_split_counts(routed, "Date")


@query("ohlc_violations", "WITH " + BARS_SQL + """
SELECT Ticker, CAST(count(*) AS BIGINT) AS bars,
  CAST(count(*) FILTER (WHERE High < Low OR High < Open OR High < Close OR Low > Open OR Low > Close) AS BIGINT)
    AS ohlc_violations
FROM bars GROUP BY Ticker
""")
def q_ohlc_violations(spark, sf):
    bars = event_bars(spark, sf)
    return bars.groupBy("Ticker").agg(F.count(F.lit(1)).alias("bars"),
                                      F.count_if(ohlc_violation(bars)).alias("ohlc_violations"))


@query("duplicate_rows", """
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(DISTINCT (l_orderkey, nullif(l_linenumber, 7))) AS BIGINT) AS distinct_keys,
  CAST(count(*) - count(DISTINCT (l_orderkey, nullif(l_linenumber, 7))) AS BIGINT) AS duplicate_rows
FROM lineitem GROUP BY l_returnflag
""")
def q_duplicate_rows(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_linenumber", F.expr("nullif(l_linenumber, 7)"))
    return duplicate_count(li, ["l_orderkey", "l_linenumber"], ["l_returnflag"])
