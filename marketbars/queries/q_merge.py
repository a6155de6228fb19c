"""Merge / de-duplication queries on events, documents and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketbars.operators.merge import keep_first, merge_first_wins, merge_stats
from marketbars.queries import query, table

# history = events before Jan 16; new day(s) = events from Jan 15 on, re-delivered
# with changed values: the overlapping day must keep the history rows.
HIST_END = "2024-01-16"
NEW_START = "2024-01-15"
EVENT_COLS = "event_id, ts, user_id, event_type, value, props"


def _event_slices(spark, sf):
    ev = table(spark, sf, "events")
    hist = ev.where(F.col("ts") < F.lit(HIST_END).cast("timestamp_ntz"))
    new = (ev.where(F.col("ts") >= F.lit(NEW_START).cast("timestamp_ntz"))
             .withColumn("value", F.col("value") + 1000))
    return hist, new


def merged_events(spark, sf):
    hist, new = _event_slices(spark, sf)
    # key (ts) determines the date -> only the overlapping history dates shuffle
    return hist, new, merge_first_wins(hist, new, ["ts"], date_of=F.to_date("ts"), raw_date_col="ts")


_MERGE_SRC = f"""
  SELECT 0 AS _src, {EVENT_COLS} FROM events WHERE ts < TIMESTAMP '{HIST_END}'
  UNION ALL
  SELECT 1 AS _src, event_id, ts, user_id, event_type, value + 1000 AS value, props
  FROM events WHERE ts >= TIMESTAMP '{NEW_START}'
"""

MERGE_SQL = f"""
WITH src AS ({_MERGE_SRC}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY _src) AS rn FROM src)
SELECT {EVENT_COLS} FROM ranked WHERE rn = 1
"""


@query("merge_first_wins", MERGE_SQL)
def q_merge_first_wins(spark, sf):
    return merged_events(spark, sf)[2]


@query("merge_stats", f"""
WITH src AS ({_MERGE_SRC}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY _src) AS rn FROM src),
c AS (SELECT count(*) FILTER (WHERE _src = 0) AS before,
             count(*) FILTER (WHERE _src = 1) AS new_rows,
             count(*) FILTER (WHERE rn = 1) AS after FROM ranked)
SELECT CAST(before AS BIGINT) AS before, CAST(new_rows AS BIGINT) AS new_rows,
       CAST(after AS BIGINT) AS after, CAST(after - before AS BIGINT) AS added,
       after <= before + new_rows AS within_bound
FROM c
""")
def q_merge_stats(spark, sf):
    hist, new, merged = merged_events(spark, sf)
    return merge_stats(hist, new, merged)


@query("merge_key_fallback", """
SELECT DISTINCT text, lang, source FROM (
  SELECT text, lang, source FROM documents WHERE n_chars < 5000
  UNION ALL
  SELECT text, lang, source FROM documents WHERE n_chars >= 1000)
""")
def q_merge_key_fallback(spark, sf):
    docs = table(spark, sf, "documents")
    hist = docs.where(F.col("n_chars") < 5000).select("text", "lang", "source")
    new = docs.where(F.col("n_chars") >= 1000).select("text", "lang", "source")
    # the feed's key (doc_id) is absent from the slices -> the whole row is the key
    return merge_first_wins(hist, new, ["doc_id"])


LINE_REST = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LINE_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in LINE_REST)
_LINE_COLS = "l_orderkey, " + ", ".join(LINE_REST)


@query("merge_partial_keys", f"""
WITH src AS (
  SELECT 0 AS _src, {_LINE_COLS} FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
  UNION ALL
  SELECT 1 AS _src, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 100 AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY _src, {_LINE_ORDER}) AS rn FROM src)
SELECT {_LINE_COLS} FROM ranked WHERE rn = 1
""")
def q_merge_partial_keys(spark, sf):
    li = table(spark, sf, "lineitem")
    hist = li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    new = (li.where(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
             .withColumn("l_quantity", F.col("l_quantity") + 100))
    # of the two wanted keys only l_orderkey exists -> it alone is the key
    return merge_first_wins(hist, new, ["l_orderkey", "Ticker"])


@query("merge_schema_conform", f"""
WITH src AS (
  SELECT 0 AS _src, {EVENT_COLS} FROM events WHERE ts < TIMESTAMP '{HIST_END}'
  UNION ALL BY NAME
  SELECT 1 AS _src, event_id, ts, user_id, event_type, value + 1000 AS value
  FROM events WHERE ts >= TIMESTAMP '{NEW_START}'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY _src) AS rn FROM src)
SELECT {EVENT_COLS} FROM ranked WHERE rn = 1
""")
def q_merge_schema_conform(spark, sf):
    hist, new = _event_slices(spark, sf)
    new = new.drop("props")      # the new day lacks a column: NULL-filled by name
    return merge_first_wins(hist, new, ["ts"], date_of=F.to_date("ts"), raw_date_col="ts")


@query("dedup_keep_first", f"""
SELECT {_LINE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1
""")
def q_dedup_keep_first(spark, sf):
    li = table(spark, sf, "lineitem")
    return keep_first(li, ["l_orderkey", "l_linenumber"])
