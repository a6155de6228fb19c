"""Histories under load: publishes that were interrupted, ledgers with two writers, the
order of arrival in streams, all targets of a run at once, quarantine and its release,
and what the files' footers and order tell. All of it is written under the shared
checkpoint folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketbars.operators import ledger as L
from marketbars.plans.collect import write_outputs
from marketbars.plans.day_report import day_report
from marketbars.plans.feeds import dead_letters, sync_tables
from marketbars.plans.ingest import ingest, release
from marketbars.queries import query, table
from marketbars.schemas import FUTURES_SCHEMA, OPTIONS_SCHEMA, SPOT_SCHEMA
from marketbars.session import scratch_path
from marketbars.sinks import ledger_log
from marketbars.sinks.storage import Storage
from marketbars.sinks.writers import PART_COL, archive_raw, verified_write
from marketbars.sources.readers import partition_counts, partition_dirs, read_ledger, with_arrival
from marketbars.streaming.ingest_stream import stream_ingest

EVENTS = "event_id, ts, user_id, event_type, value, props"


def _day():
    return F.to_date("ts")


@query("interrupted_publish", f"SELECT {EVENTS} FROM events")
def q_interrupted_publish(spark, sf):
    """Half of the events are ingested; then every other day is left as a crash leaves
    it, set aside with nothing in its place. The second half finds all of them."""
    ev = table(spark, sf, "events")
    history, ledger = scratch_path(spark, "history"), scratch_path(spark, "ledger")
    own = dict(history_path=history, ledger_path=ledger, target="events", keys=["event_id"],
               date_of=_day(), merge_ledgered=True)
    ingest(spark, ev.where("event_id % 2 = 0"), **own)
    storage = Storage(spark, history)
    for name in storage.names(history, folders=True)[::2]:
        if name.startswith(PART_COL):
            storage.move(f"{history}/{name}", f"{history}/_old.{name}")
    ingest(spark, ev.where("event_id % 2 = 1"), **own)
    return spark.read.parquet(history).select(*ev.columns)


@query("ledger_log", """
SELECT event_type AS target, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events GROUP BY ALL
""")
def q_ledger_log(spark, sf):
    """The days of every event type, recorded by two writers in turn, day by day, with a
    snapshot after every few batches."""
    days = (table(spark, sf, "events").groupBy(F.col("event_type").alias("target"))
            .agg(F.array_sort(F.collect_set(_day().cast("string"))).alias("days")))
    path = scratch_path(spark, "ledger")
    rows = [(r["target"], r["days"]) for r in days.collect()]       # targets and their days
    for writer in (0, 1):
        for part in range(0, max((len(d) for _, d in rows), default=0), 6):
            batch = {t: [d for i, d in enumerate(some[part:part + 6]) if i % 2 == writer]
                     for t, some in rows}
            ledger_log.append(spark, path, {t: d for t, d in batch.items() if d}, compact_at=4)
    return L.parse_ledger(read_ledger(spark, path)).select("target", "date")


@query("stream_first_arrival", """
SELECT event_id, ts, CASE WHEN event_id % 10 = 0 THEN value + 1000 ELSE value END AS value FROM events
""")
def q_stream_first_arrival(spark, sf):
    """A small file with a tenth of the keys lands first, a large one with all keys and
    other values after it; one micro-batch takes both. The first arrival stays."""
    ev = table(spark, sf, "events").select("event_id", "ts", "value")
    landing, history = scratch_path(spark, "landing"), scratch_path(spark, "history")
    (ev.where("event_id % 10 = 0").withColumn("value", F.col("value") + 1000).coalesce(1)
     .write.mode("append").parquet(landing))
    ev.write.mode("append").parquet(landing)
    stream_ingest(spark, landing, ev.schema, history, scratch_path(spark, "ledger"),
                  scratch_path(spark, "stream-ckpt"), "events", ["event_id"], date_of=_day())
    return spark.read.parquet(history).select(*ev.columns)


@query("stream_redelivered", f"""
SELECT {EVENTS}, CAST(1 AS BIGINT) AS passed FROM events
""")
def q_stream_redelivered(spark, sf):
    """Every third event is delivered again in a later micro-batch: the stream's state
    drops it before the merge, which is told by the number of rows that came through."""
    ev = table(spark, sf, "events")
    landing, history = scratch_path(spark, "landing"), scratch_path(spark, "history")
    own = (landing, ev.schema, history, scratch_path(spark, "ledger"), scratch_path(spark, "stream-ckpt"),
           "events", ["event_id"])
    ev.write.parquet(landing)
    stream_ingest(spark, *own, date_of=_day(), redelivered_within="7 days")
    ev.where("event_id % 3 = 0").write.mode("append").parquet(landing)
    progress = stream_ingest(spark, *own, date_of=_day(), redelivered_within="7 days")
    again = sum(s["numRowsUpdated"] for p in progress for s in p["stateOperators"])
    return (spark.read.parquet(history).select(*ev.columns)
            .withColumn("passed", F.lit(1 + again).cast("bigint")))


def _bars(ev):
    """Events as option, future and spot bars around a turn of the year, of three
    indexes and one that no target takes."""
    names = F.array(*[F.lit(x) for x in ("NIFTY", "SENSEX", "BANKNIFTY", "OTHER")])
    index = F.try_element_at(names, (F.col("event_id") % 4 + 1).cast("int"))
    at = F.col("ts") - F.expr("INTERVAL 15 DAYS")
    price = F.col("value").cast("double")
    common = dict(Date=F.to_date(at), Time=F.date_format(at, "HH:mm:ss"), Open=price, High=price, Low=price,
                  Close=price, Volume=F.col("event_id"), OpenInterest=F.col("user_id"), Underlying=index,
                  Ticker=F.concat(F.lit("T"), F.col("event_id")), Expiry=F.to_date(at), Strike=F.lit(100),
                  OptionType=F.lit("CE"), SourceFile=F.lit("x"), ContractSeries=F.lit("I"), Index=index,
                  timestamp=at)

    def rows(schema):
        return ev.select(*[common[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    spot = rows(SPOT_SCHEMA).dropDuplicates(["Index", "timestamp"])
    return {"options": rows(OPTIONS_SCHEMA), "futures": rows(FUTURES_SCHEMA), "spot": spot}


@query("sync_all_targets", """
WITH e AS (SELECT event_id, ts - INTERVAL 15 DAY AS w,
                  (['NIFTY', 'SENSEX', 'BANKNIFTY', 'OTHER'])[event_id % 4 + 1] AS u FROM events),
r AS (
  SELECT CASE u WHEN 'OTHER' THEN NULL WHEN 'SENSEX' THEN 'BSE_INDEX_OPTIONS_' || year(w) || '.parquet'
              ELSE 'NSE_INDEX_OPTIONS_' || year(w) || '.parquet' END AS target, w FROM e
  UNION ALL SELECT 'INDEX_FUTURES_' || year(w) || '.parquet', w FROM e
  UNION ALL SELECT CASE u WHEN 'NIFTY' THEN 'Nifty 50.csv' WHEN 'SENSEX' THEN 'Sensex.csv'
                          WHEN 'BANKNIFTY' THEN 'Nifty Bank.csv' END, w
            FROM (SELECT DISTINCT u, w FROM e)),
s AS (SELECT coalesce(target, 'unrouted') AS target,
             CASE WHEN target IS NULL THEN 'unrouted' ELSE 'created' END AS status,
             CAST(CASE WHEN target IS NULL THEN NULL ELSE w END AS DATE) AS date, count(*) AS n
      FROM r GROUP BY ALL)
SELECT target, status, CAST(count(date) AS BIGINT) AS days, CAST(sum(n) AS BIGINT) AS rows FROM s GROUP BY ALL
UNION ALL SELECT target, 'already_ingested', count(date), 0 FROM s WHERE status = 'created' GROUP BY ALL
""")
def q_sync_all_targets(spark, sf):
    """A run that crosses the year, synced twice: rows and days per target and status,
    the rows that no target takes included."""
    tables, root = _bars(table(spark, sf, "events")), scratch_path(spark, "sync")
    first = sync_tables(spark, tables, root, keep_rows=False)
    again = sync_tables(spark, tables, root, keep_rows=False).where("status = 'already_ingested'")
    lost = None
    for kind in ("options", "spot"):
        one = dead_letters(spark, root, kind).select("batch")
        lost = one if lost is None else lost.union(one)
    # the second sync writes the dead letters of its own batch again
    batches = F.count_distinct("batch")
    dead = lost.agg((F.count(F.lit(1)) / batches * 2).cast("bigint").alias("rows")).select(
        F.lit("unrouted").alias("target"), F.lit("unrouted").alias("status"),
        F.lit(0).cast("bigint").alias("days"), "rows")
    counted = (first.where("status <> 'unrouted'").union(again).groupBy("target", "status")
               .agg(F.count("date").alias("days"), F.sum("rows_added").cast("bigint").alias("rows")))
    return counted.union(dead)


@query("quarantine_release", f"""
SELECT {EVENTS}, CASE WHEN event_id % 17 = 0 THEN 'quarantine' ELSE 'history' END AS stored FROM events
""")
def q_quarantine_release(spark, sf):
    """Half of the events are history whose ledger is lost. Then all come: their days, which
    history holds differently, and rows without a date are quarantined; the days are judged
    right and released. Every row is in one of both."""
    ev = table(spark, sf, "events")
    history, held = scratch_path(spark, "history"), scratch_path(spark, "quarantine")
    dated = F.when(F.col("event_id") % 17 != 0, _day())
    own = dict(history_path=history, target="events", keys=["event_id"])
    ingest(spark, ev.where("event_id % 2 = 0 and event_id % 17 <> 0"), date_of=dated,
           ledger_path=scratch_path(spark, "lost"), **own)
    ledger = scratch_path(spark, "ledger")
    ingest(spark, ev, ledger_path=ledger, quarantine_path=held, date_of=dated, **own)
    release(spark, held, ledger_path=ledger, **own)
    return (spark.read.parquet(history).select(*ev.columns, F.lit("history").alias("stored"))
            .union(spark.read.parquet(held).select(*ev.columns, F.lit("quarantine").alias("stored"))))


@query("footer_counts", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY 1
""")
def q_footer_counts(spark, sf):
    """Rows per day of a stored history from its files' footers."""
    path = scratch_path(spark, "history")
    verified_write(spark, table(spark, sf, "events").withColumn(PART_COL, _day()), path, [PART_COL])
    days = partition_dirs(spark, path, PART_COL) or {}
    return spark.createDataFrame(partition_counts(spark, path, list(days.values()), [PART_COL]),
                                 "date string, rows bigint")


@query("dry_run", """
WITH d AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n,
                  count(*) FILTER (WHERE event_id % 2 = 0) AS h FROM events GROUP BY 1)
SELECT date, 'dry_run' AS status, CAST(0 AS BIGINT) AS history_rows, CAST(n AS BIGINT) AS rows_after,
       CAST(n AS BIGINT) AS rows_added, CAST(0 AS BIGINT) AS stored FROM d
""")
def q_dry_run(spark, sf):
    """What an ingest would do, every event arriving twice; nothing is written."""
    ev = table(spark, sf, "events")
    history = scratch_path(spark, "history")
    decisions = ingest(spark, ev.union(ev), history, scratch_path(spark, "ledger"), "events", ["event_id"],
                       date_of=_day(), dry_run=True)
    stored = len(partition_dirs(spark, history, PART_COL) or {})
    return decisions.select("date", "status", "history_rows", "rows_after", "rows_added",
                            F.lit(stored).cast("bigint").alias("stored"))


@query("archived_days", f"SELECT {EVENTS}, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def q_archived_days(spark, sf):
    """Incoming days archived as they came, a day that comes again in place of its copy."""
    ev, path = table(spark, sf, "events").withColumn(PART_COL, _day()), scratch_path(spark, "archive")
    archive_raw(ev.where("event_id % 2 = 0"), path)
    archive_raw(ev, path)
    return spark.read.parquet(path).select(*EVENTS.split(", "),
                                           F.col("ingest_date").cast("string").alias("day"))


@query("no_clobber", "SELECT CAST(count(*) AS BIGINT) AS rows, true AS refused FROM events")
def q_no_clobber(spark, sf):
    """A second write to the same place is refused, and the first one stays."""
    ev, path = table(spark, sf, "events"), scratch_path(spark, "once")
    verified_write(spark, ev, path)
    try:
        verified_write(spark, ev.where("event_id % 2 = 0"), path)
    except Exception:  # noqa: BLE001 - the guard
        refused = True
    else:
        refused = False
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.lit(refused).alias("refused"))


@query("csv_history", """
SELECT event_id, date_trunc('second', ts) AS ts, event_type,
       CASE WHEN event_id % 2 = 0 THEN value ELSE value + 1 END AS value FROM events
""")
def q_csv_history(spark, sf):
    """A CSV history of whole seconds, to which every event comes again with another value."""
    ev = table(spark, sf, "events").select(
        "event_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"), "event_type", "value")
    path = scratch_path(spark, "history")
    own = dict(history_path=path, ledger_path=scratch_path(spark, "ledger"), target="events",
               keys=["event_id"], date_of=_day(), schema=ev.schema, fmt="csv", merge_ledgered=True)
    ingest(spark, ev.where("event_id % 2 = 0"), **own)
    ingest(spark, ev.withColumn("value", F.col("value") + 1), **own)
    return (spark.read.schema(ev.schema).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path).select(*ev.columns))


@query("order_in_files", """
SELECT kind, CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS out_of_order
FROM events, (VALUES ('options'), ('futures')) k(kind) GROUP BY kind
""")
def q_order_in_files(spark, sf):
    """The order of rows inside the written files, read by each row's place in its file."""
    tables = _bars(table(spark, sf, "events"))
    orders = {"options": ["Underlying", "Expiry", "Strike", "OptionType", "Time"],
              "futures": ["Underlying", "ContractSeries", "Time"]}
    out = None
    for kind, order in orders.items():
        path = scratch_path(spark, kind)
        verified_write(spark, tables[kind].withColumn(PART_COL, F.col("Date")), path, [PART_COL],
                       sort_within=order)
        stored = with_arrival(spark.read.parquet(path))
        # a file's rows one after the other
        file = Window.partitionBy("_arrival.path").orderBy("_arrival.place")
        before = F.lag(F.struct(*order)).over(file)
        one = stored.select((before > F.struct(*order)).alias("late")).agg(
            F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("out_of_order"))
        out = one if out is None else out.union(one)
    return out


@query("day_captions", """
WITH d AS (SELECT max(CAST(ts AS DATE) - 15) AS day FROM events),
e AS (SELECT event_id, ts - INTERVAL 15 DAY AS w,
             (['NIFTY', 'SENSEX', 'BANKNIFTY', 'OTHER'])[event_id % 4 + 1] AS u FROM events),
t AS (SELECT e.* FROM e, d WHERE CAST(w AS DATE) = day),
f AS (
  SELECT 'options_nse.parquet' AS file_name, count(*) AS n FROM t WHERE u IN ('NIFTY', 'BANKNIFTY')
  UNION ALL SELECT 'options_bse.parquet', count(*) FROM t WHERE u = 'SENSEX'
  UNION ALL SELECT 'futures.parquet', count(*) FROM t
  UNION ALL SELECT 'spot_Nifty 50.csv', count(DISTINCT w) FROM t WHERE u = 'NIFTY'
  UNION ALL SELECT 'spot_Nifty Bank.csv', count(DISTINCT w) FROM t WHERE u = 'BANKNIFTY'
  UNION ALL SELECT 'spot_Sensex.csv', count(DISTINCT w) FROM t WHERE u = 'SENSEX')
SELECT file_name, CAST(n AS BIGINT) AS rows, n > 0 AS present FROM f
""")
def q_day_captions(spark, sf):
    """The report of a run's last day: every expected file, with its rows."""
    tables = _bars(table(spark, sf, "events"))
    out = scratch_path(spark, "outputs")
    tables["spot"] = tables["spot"].where(F.col("Index") != "OTHER")
    write_outputs(spark, tables, out, validate=False)
    last = tables["futures"].agg(F.max("Date")).first()[0] or dt.date(2024, 1, 1)
    return day_report(spark, out, last.isoformat()).select("file_name", "rows", "present")
