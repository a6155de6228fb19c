"""Ledger and reconcile queries.

``labels`` acts as a ledger of ingested documents (one JSON text per label row:
a list, an object, or malformed text), ``documents`` as the incoming items.
The reconcile query decides every (event type, day) of an incoming slice of
events against a history slice whose counts differ on some days.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketbars.operators import ledger as L
from marketbars.queries import query, table


def doc_ledger(spark, sf):
    lab = table(spark, sf, "labels")
    d = F.col("doc_id").cast("string")
    text = (F.when(F.col("toxic") == 1, F.concat(F.lit('{"dates": ["'), d, F.lit('"]}')))
             .when(F.col("quality") == 0, F.lit("not json"))
             .otherwise(F.concat(F.lit('["'), d, F.lit('", "'), d, F.lit('"]'))))
    return lab.select(F.lit("docs").alias("target"), text.alias("dates_json"))


def doc_incoming(spark, sf):
    return table(spark, sf, "documents").select(
        F.lit("docs").alias("target"), F.col("doc_id").cast("string").alias("date"))


LEDGER_SQL = """
led AS (SELECT 'docs' AS target, CASE WHEN toxic = 1 THEN '{"dates": ["' || doc_id || '"]}'
          WHEN quality = 0 THEN 'not json' ELSE '["' || doc_id || '", "' || doc_id || '"]' END AS dates_json
        FROM labels),
ld AS (SELECT DISTINCT target, unnest(CAST(json(dates_json) AS VARCHAR[])) AS date
       FROM led WHERE json_valid(dates_json) AND json_type(dates_json) = 'ARRAY'),
inc AS (SELECT 'docs' AS target, CAST(doc_id AS VARCHAR) AS date FROM documents)"""


@query("ledger_todo", "WITH " + LEDGER_SQL + " SELECT * FROM inc ANTI JOIN ld USING (target, date)")
def q_ledger_todo(spark, sf):
    return L.ledger_todo(doc_incoming(spark, sf), L.parse_ledger(doc_ledger(spark, sf)))


@query("ledger_done", "WITH " + LEDGER_SQL + " SELECT * FROM inc SEMI JOIN ld USING (target, date)")
def q_ledger_done(spark, sf):
    return L.ledger_done(doc_incoming(spark, sf), L.parse_ledger(doc_ledger(spark, sf)))


# ------------------------------------------------------------------ reconcile

def _event_days(spark, sf):
    ev = table(spark, sf, "events")
    return ev.withColumn("date", F.to_date("ts").cast("string")).withColumnRenamed("event_type", "target")


def reconcile_inputs(spark, sf):
    ev = _event_days(spark, sf)
    incoming = ev.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    history = ev.where((F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
                       & (F.col("target") != "signup")
                       & ~((F.col("date") >= "2024-01-15") & (F.col("value") < 5)))
    inc = incoming.groupBy("target", "date").agg(F.count(F.lit(1)).alias("incoming_rows"))
    hist = history.groupBy("target", "date").agg(F.count(F.lit(1)).alias("history_rows"))
    ledger_text = L.dump_ledger(history.where(F.col("date") < "2024-01-12").select("target", "date"))
    ledger_dates = L.parse_ledger(ledger_text)
    targets = history.select("target").distinct()
    return inc, hist, ledger_dates, targets


RECON_SQL = """
ev AS (SELECT *, event_type AS target, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events),
hist AS (SELECT * FROM ev WHERE ts < TIMESTAMP '2024-01-20' AND target <> 'signup'
         AND NOT (date >= '2024-01-15' AND value < 5)),
ic AS (SELECT target, date, count(*) AS n FROM ev WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ALL),
hc AS (SELECT target, date, count(*) AS h FROM hist GROUP BY ALL),
led AS (SELECT DISTINCT target, date FROM hist WHERE date < '2024-01-12'),
tg AS (SELECT DISTINCT target FROM hist),
facts AS (
  SELECT coalesce(ic.target, hc.target) AS target, coalesce(ic.date, hc.date) AS date,
         CAST(coalesce(ic.n, 0) AS BIGINT) AS incoming_rows, CAST(coalesce(hc.h, 0) AS BIGINT) AS history_rows
  FROM ic FULL OUTER JOIN hc ON ic.target = hc.target AND ic.date = hc.date),
f2 AS (
  SELECT facts.*, tg.target IS NOT NULL AS target_exists, led.target IS NOT NULL AS in_ledger
  FROM facts LEFT JOIN tg ON facts.target = tg.target
  LEFT JOIN led ON facts.target = led.target AND facts.date = led.date)"""


def _status_sql(repair=False, dry_run=False, repair_only=False):
    rep = "'sidecar_repaired'" if (repair and not dry_run) else "'sidecar_repair_needed'"
    if repair_only:
        tail = "WHEN NOT target_exists THEN 'missing_target' ELSE 'not_present'"
    elif dry_run:
        tail = "ELSE 'dry_run'"
    else:
        tail = "WHEN NOT target_exists THEN 'created' ELSE 'updated'"
    return f"""CASE WHEN in_ledger THEN 'already_ingested' WHEN incoming_rows = 0 THEN 'empty_source'
    WHEN target_exists AND history_rows > 0 AND history_rows <> incoming_rows THEN 'mismatch'
    WHEN target_exists AND history_rows > 0 THEN {rep} {tail} END"""


@query("reconcile", "WITH " + RECON_SQL + f" SELECT *, {_status_sql()} AS status FROM f2")
def q_reconcile(spark, sf):
    inc, hist, led, tg = reconcile_inputs(spark, sf)
    return L.reconcile(inc, hist, led, tg)


@query("sync_result_counts", "WITH " + RECON_SQL + f""",
d AS (SELECT {_status_sql()} AS status FROM f2)
SELECT status, CAST(count(*) AS BIGINT) AS items FROM d GROUP BY status
""")
def q_sync_result_counts(spark, sf):
    inc, hist, led, tg = reconcile_inputs(spark, sf)
    d = L.reconcile(inc, hist, led, tg)
    return d.groupBy("status").agg(F.count(F.lit(1)).alias("items"))


@query("ledger_repair", "WITH " + RECON_SQL + f""",
d AS (SELECT target, date, {_status_sql(repair=True)} AS status FROM f2),
nl AS (SELECT target, date FROM led UNION
       SELECT target, date FROM d WHERE status IN ('sidecar_repaired', 'created', 'updated'))
SELECT target, '[' || string_agg('"' || date || '"', ', ' ORDER BY date) || ']' AS dates_json
FROM nl GROUP BY target
""")
def q_ledger_repair(spark, sf):
    inc, hist, led, tg = reconcile_inputs(spark, sf)
    d = L.reconcile(inc, hist, led, tg, repair=True)
    return L.repaired_ledger(led, d)


@query("repair_only_status", "WITH " + RECON_SQL + f""",
d AS (SELECT {_status_sql(repair=True, repair_only=True)} AS status FROM f2)
SELECT status, CAST(count(*) AS BIGINT) AS items FROM d GROUP BY status
""")
def q_repair_only_status(spark, sf):
    inc, hist, led, tg = reconcile_inputs(spark, sf)
    d = L.reconcile(inc, hist, led, tg, repair=True, repair_only=True)
    return d.groupBy("status").agg(F.count(F.lit(1)).alias("items"))
