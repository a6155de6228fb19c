"""Sink and stream queries: they write under the shared checkpoint folder
(``spark.checkpoint.dir``), read back and return what was stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketbars.queries import query, table
from marketbars.session import scratch_path
from marketbars.sinks.writers import PART_COL, verified_write
from marketbars.streaming.ingest_stream import stream_ingest


@query("sink_roundtrip", """
SELECT CAST(ts AS DATE) AS trade_date, CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY 1
""")
def q_sink_roundtrip(spark, sf):
    ev = table(spark, sf, "events").withColumn(PART_COL, F.to_date("ts"))
    path = scratch_path(spark, "sink")
    verified_write(spark, ev, path, partition_by=[PART_COL], sort_within=["ts"])
    back = spark.read.parquet(path)
    return back.groupBy(PART_COL).agg(F.count(F.lit(1)).alias("rows"))


@query("stream_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_stream_ingest(spark, sf):
    ev = table(spark, sf, "events")
    landing = scratch_path(spark, "landing")
    # land the table as files of about one day each (a large day is split by
    # AQE): the stream picks them up as new files
    (ev.withColumn("_day", F.to_date("ts")).hint("rebalance", "_day").drop("_day")
       .write.parquet(landing))
    history = scratch_path(spark, "history")
    ledger = scratch_path(spark, "ledger")
    ckpt = scratch_path(spark, "stream-ckpt")
    for _ in range(2):      # the second run finds no new files and adds nothing
        stream_ingest(spark, landing, ev.schema, history, ledger, ckpt, "events",
                      ["event_id"], max_files_per_trigger=8, date_of=F.to_date("ts"))
    return spark.read.parquet(history).drop(PART_COL).select(*ev.columns)


# the benchmark tables and their column counts (fixed by the benchmark spec)
TABLE_COLUMNS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
                 "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
                 "benchmark": 2, "labels": 3, "conversations": 4}


@query("table_probe", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows, {n} AS n_columns FROM {t}"
    for t, n in TABLE_COLUMNS.items()))
def q_table_probe(spark, sf):
    """Each table through SQL straight over its Parquet path: the column list
    comes from the footer (no job over the rows) and the row count from row
    group metadata (no column is read); one grouped count for all tables."""
    parts = []
    for t in TABLE_COLUMNS:
        rel = spark.sql(f"SELECT * FROM parquet.`{sf.rstrip('/')}/{t}.parquet`")
        parts.append(rel.select(F.lit(t).alias("table_name"), F.lit(len(rel.columns)).alias("n_columns")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return (u.groupBy("table_name", "n_columns").agg(F.count(F.lit(1)).alias("rows"))
             .select("table_name", "rows", "n_columns"))
