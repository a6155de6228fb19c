"""Report queries: feed presence, invalid values, dimension lookups, day
summaries, per-index counts, ambiguous targets, year targets, rows per date."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketbars.functions.text import ledger_name, spot_stem_from_name
from marketbars.operators.bars import rows_per_index
from marketbars.operators.calendar import date_span
from marketbars.operators.report import duplicate_targets, feed_presence, file_summary
from marketbars.operators.quality import with_invalid_types
from marketbars.operators.routing import known_selected, rows_per_date, spot_target, year_target_of
from marketbars.queries import query, table
from marketbars.queries.q_quality import TYPE_INDEX
from marketbars.schemas import SPOT_FILENAME_PATTERN, SPOT_FILES, SPOT_STEMS

ALLOWED_TYPES = ["click", "view", "purchase"]
SELECTED_REGIONS = ["AMERICA", "ASIA", "EUROPE"]


@query("feed_presence", """
WITH p AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS date FROM events),
span AS (SELECT user_id, min(date) AS lo, max(date) AS hi FROM p GROUP BY user_id),
e AS (SELECT user_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
f AS (SELECT e.user_id, p.user_id IS NOT NULL AS present FROM e LEFT JOIN p USING (user_id, date))
SELECT user_id, CAST(count(*) AS BIGINT) AS expected, CAST(count(*) FILTER (WHERE present) AS BIGINT) AS present,
       bool_and(present) AS complete,
       CAST(count(*) - count(*) FILTER (WHERE present) AS BIGINT) AS missing
FROM f GROUP BY user_id
""")
def q_feed_presence(spark, sf):
    ev = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("date"))
    present = ev.distinct()
    span = present.groupBy("user_id").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    expected = span.select("user_id", F.explode(date_span(F.col("lo"), F.col("hi"))).alias("date"))
    out = feed_presence(expected, present, ["user_id", "date"], ["user_id"])
    return out.withColumn("missing", F.col("expected") - F.col("present"))


_ALLOWED_SQL = ", ".join(f"'{t}'" for t in ALLOWED_TYPES)


@query("invalid_types", f"""
SELECT CAST(ts AS DATE) AS date,
  coalesce(array_to_string(list_sort(list_distinct(list(event_type) FILTER (WHERE event_type NOT IN ({_ALLOWED_SQL})))), ','), '')
    AS invalid_types,
  CAST(count(*) FILTER (WHERE event_type NOT IN ({_ALLOWED_SQL})) AS BIGINT) AS invalid_rows
FROM events GROUP BY CAST(ts AS DATE)
""")
def q_invalid_types(spark, sf):
    """Every day, those without invalid values too, with all its invalid values and rows."""
    ev = table(spark, sf, "events").select(F.to_date("ts").alias("date"), "event_type")
    rows = ev.groupBy("date").agg(
        F.count_if(~F.col("event_type").isin(*ALLOWED_TYPES)).alias("invalid_rows"))
    out = with_invalid_types(rows, ev, ["date"], "event_type", ALLOWED_TYPES, listed=None)
    return out.select("date", F.array_join("invalid_types", ",").alias("invalid_types"),
                      "invalid_rows")


_SEL_SQL = ", ".join(f"'{r}'" for r in SELECTED_REGIONS)


@query("index_lookup", f"""
SELECT s_suppkey, s_name, n_name, r_name, n_name IS NOT NULL AND r_name IS NOT NULL AS known,
       coalesce(r_name IN ({_SEL_SQL}), false) AS selected
FROM supplier LEFT JOIN nation ON CASE WHEN s_suppkey % 7 = 0 THEN 99 ELSE s_nationkey END = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
""")
def q_index_lookup(spark, sf):
    sup = table(spark, sf, "supplier")
    nat = table(spark, sf, "nation")
    reg = table(spark, sf, "region")
    # every seventh supplier has a key that the dimension does not know
    sup = sup.withColumn("key", F.when(F.col("s_suppkey") % 7 == 0, 99).otherwise(F.col("s_nationkey")))
    out = known_selected(sup, [(nat, "key", "n_nationkey"), (reg, "n_regionkey", "r_regionkey")],
                         ["n_name", "r_name"], "r_name", SELECTED_REGIONS)
    return out.select("s_suppkey", "s_name", "n_name", "r_name", "known", "selected")


@query("day_summary", """
SELECT CAST(ts AS DATE) AS date, CAST(count(*) AS BIGINT) AS rows,
  array_to_string(list_sort(list_distinct(list(event_type))), ', ') AS indexes,
  CAST(count(DISTINCT user_id) AS BIGINT) AS contracts,
  format('{:,}', count(*)) || ' rows | indexes: ' || array_to_string(list_sort(list_distinct(list(event_type))), ', ')
    || ' | ' || count(DISTINCT user_id) || ' contracts' AS summary
FROM events GROUP BY CAST(ts AS DATE)
""")
def q_day_summary(spark, sf):
    ev = table(spark, sf, "events").select(
        F.to_date("ts").alias("date"), F.col("event_type").alias("Underlying"),
        F.col("user_id").cast("string").alias("Ticker"))
    return file_summary(ev, ["date"])


@query("rows_per_index", """
SELECT upper(event_type) AS "Index", CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY event_type
""")
def q_rows_per_index(spark, sf):
    return rows_per_index(table(spark, sf, "events"), F.upper("event_type"))


@query("ambiguous_targets", """
SELECT text AS target, CAST(count(*) AS BIGINT) AS copies FROM documents GROUP BY text HAVING count(*) > 1
""")
def q_ambiguous_targets(spark, sf):
    return duplicate_targets(table(spark, sf, "documents").select(F.col("text").alias("target")))


@query("year_targets", """
WITH o AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'NSE_INDEX_OPTIONS_' WHEN 'O' THEN 'BSE_INDEX_OPTIONS_'
                  WHEN 'P' THEN 'INDEX_FUTURES_' END || CAST(year(o_orderdate) AS VARCHAR) || '.parquet' AS target
           FROM orders)
SELECT target, '.' || target || '.dates.json' AS ledger_name, CAST(count(*) AS BIGINT) AS rows
FROM o GROUP BY target
""")
def q_year_targets(spark, sf):
    o = table(spark, sf, "orders")
    kind = (F.when(F.col("o_orderstatus") == "F", F.lit("options_nse"))
             .when(F.col("o_orderstatus") == "O", F.lit("options_bse"))
             .when(F.col("o_orderstatus") == "P", F.lit("futures")))
    t = o.select(year_target_of(kind, F.col("o_orderdate")).alias("target"))
    return (t.groupBy("target").agg(F.count(F.lit(1)).alias("rows"))
             .select("target", ledger_name(F.col("target")).alias("ledger_name"), "rows"))


@query("rows_per_date", """
SELECT 'orders' AS source, CAST(TRY_CAST(d AS TIMESTAMP) AS DATE) AS date, CAST(count(*) AS BIGINT) AS rows
FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'not a date' ELSE CAST(o_orderdate AS VARCHAR) END AS d FROM orders)
GROUP BY 2
UNION ALL
SELECT 'events', CAST(ts AS DATE), CAST(count(*) AS BIGINT) FROM events GROUP BY 2
""")
def q_rows_per_date(spark, sf):
    o = table(spark, sf, "orders")
    dated = o.select(F.when(F.col("o_orderstatus") == "P", F.lit("not a date"))
                      .otherwise(F.col("o_orderdate").cast("string")).alias("Date"))
    ev = table(spark, sf, "events").select(F.col("ts").alias("timestamp"))
    a = rows_per_date(dated).select(F.lit("orders").alias("source"), "date", "rows")
    b = rows_per_date(ev).select(F.lit("events").alias("source"), "date", "rows")
    return a.unionByName(b)


_TYPE_INDEX_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_INDEX.items())
_STEM_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SPOT_STEMS.items())
_SPOT_FILE_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SPOT_FILES.items())


@query("spot_targets", f"""
WITH g AS (SELECT CASE event_type {_TYPE_INDEX_SQL} END AS "Index", CAST(count(*) AS BIGINT) AS rows
           FROM events GROUP BY 1),
f AS (SELECT *, CASE "Index" {_SPOT_FILE_SQL} END AS target,
             'spot_' || (CASE "Index" {_STEM_SQL} END) || '.csv' AS day_file FROM g)
SELECT "Index", target, day_file, regexp_extract(day_file, '^spot_(.*)\\.csv$', 1) AS stem, rows FROM f
""")
def q_spot_targets(spark, sf):
    """Spot rows per index routed to the cumulative per-index target; the
    per-day file name and the stem read back from it (an index without a
    spot feed has no target)."""
    ev = table(spark, sf, "events")
    idx = F.create_map(*[x for k, i in TYPE_INDEX.items() for x in (F.lit(k), F.lit(i))])
    g = ev.groupBy(F.try_element_at(idx, F.col("event_type")).alias("Index")).agg(
        F.count(F.lit(1)).alias("rows"))
    stems = F.create_map(*[x for k, v in SPOT_STEMS.items() for x in (F.lit(k), F.lit(v))])
    stem = F.try_element_at(stems, F.col("Index"))
    day_file = F.when(stem.isNotNull(), F.format_string(SPOT_FILENAME_PATTERN, stem))
    return g.select("Index", spot_target(F.col("Index")).alias("target"), day_file.alias("day_file"),
                    spot_stem_from_name(day_file).alias("stem"), "rows")
