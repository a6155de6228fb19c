import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from marketbars.operators import ledger as L
from marketbars.plans.ingest import ingest
from marketbars.schemas import OPTIONS_SCHEMA, DEDUP_KEYS
from marketbars.sinks.writers import PART_COL
from marketbars.sources.readers import read_ledger
from marketbars.streaming.ingest_stream import stream_ingest

D1, D2 = dt.date(2026, 8, 24), dt.date(2026, 8, 25)


def _bars(spark, day, times, close=1.0):
    return spark.createDataFrame(
        [("NSE:X", day, t, 1.0, 2.0, 0.5, close, 5, 7, "NIFTY", D2, 100, "CE") for t in times], OPTIONS_SCHEMA)


def test_ingest_idempotent_with_ledger_and_repair(spark):
    base = tempfile.mkdtemp(prefix="mb-ingest-")
    hist, led = os.path.join(base, "hist"), os.path.join(base, "ledger")
    keys = DEDUP_KEYS["options"]
    s1 = ingest(spark, _bars(spark, D1, ["09:15:00", "09:16:00"]), hist, led, "T", keys)
    assert [r["status"] for r in s1.collect()] == ["created"]
    s2 = ingest(spark, _bars(spark, D2, ["09:15:00"]), hist, led, "T", keys)
    assert [r["status"] for r in s2.collect()] == ["updated"]
    # re-delivery of an ingested day: the ledger short-circuits it
    s3 = ingest(spark, _bars(spark, D2, ["09:15:00"], close=9.0), hist, led, "T", keys)
    assert [r["status"] for r in s3.collect()] == ["already_ingested"]
    h = spark.read.parquet(hist)
    assert h.count() == 3 and h.where(F.col("Close") == 9.0).count() == 0
    assert sorted(r["date"] for r in L.parse_ledger(read_ledger(spark, led)).collect()) == \
        [D1.isoformat(), D2.isoformat()]
    # ledger lost: equal counts -> repair needed, then repaired; different count -> mismatch
    spark.createDataFrame([("T", "[]")], "target string, dates_json string").write.mode("overwrite").json(led)
    s4 = ingest(spark, _bars(spark, D1, ["09:15:00", "09:16:00"]), hist, led, "T", keys)
    assert [r["status"] for r in s4.collect()] == ["sidecar_repair_needed"]
    s5 = ingest(spark, _bars(spark, D1, ["09:15:00", "09:16:00"]), hist, led, "T", keys, repair=True)
    assert [r["status"] for r in s5.collect()] == ["sidecar_repaired"]
    s6 = ingest(spark, _bars(spark, D2, ["09:15:00", "09:17:00"]), hist, led, "T", keys)
    assert [r["status"] for r in s6.collect()] == ["mismatch"]
    assert spark.read.parquet(hist).count() == 3
    assert set(r[PART_COL] for r in spark.read.parquet(hist).select(PART_COL).distinct().collect()) == {D1, D2}


def test_stream_ingest_twice_adds_nothing(spark):
    base = tempfile.mkdtemp(prefix="mb-stream-")
    landing = os.path.join(base, "landing")
    df = _bars(spark, D1, ["09:15:00", "09:16:00"]).unionByName(_bars(spark, D2, ["09:15:00"]))
    df.repartition(2, "Date").write.parquet(landing)
    args = (landing, OPTIONS_SCHEMA, os.path.join(base, "hist"), os.path.join(base, "led"),
            os.path.join(base, "ckpt"), "T", DEDUP_KEYS["options"])
    stream_ingest(spark, *args, max_files_per_trigger=1)
    first = spark.read.parquet(os.path.join(base, "hist")).count()
    stream_ingest(spark, *args, max_files_per_trigger=1)
    assert first == 3 and spark.read.parquet(os.path.join(base, "hist")).count() == 3


def test_driver_entry_points(spark):
    import __spark_entry__ as E
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 40
    df = E.entry(spark)
    assert df.columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]
    assert df.count() > 0


def test_ingest_dry_run_reports_stats_and_writes_nothing(spark):
    base = tempfile.mkdtemp(prefix="mb-dry-")
    hist, led = os.path.join(base, "hist"), os.path.join(base, "ledger")
    keys = DEDUP_KEYS["options"]
    ingest(spark, _bars(spark, D1, ["09:15:00"]), hist, led, "T", keys)
    r = ingest(spark, _bars(spark, D2, ["09:15:00", "09:15:00", "09:16:00"]), hist, led, "T", keys,
               dry_run=True).first()
    assert (r["status"], r["history_rows"], r["rows_after"], r["rows_added"]) == ("dry_run", 0, 2, 2)
    assert spark.read.parquet(hist).count() == 1
    assert [x["date"] for x in L.parse_ledger(read_ledger(spark, led)).collect()] == [D1.isoformat()]


def test_stream_late_conflicting_day_is_quarantined(spark):
    base = tempfile.mkdtemp(prefix="mb-late-")
    landing, quarantine = os.path.join(base, "landing"), os.path.join(base, "quarantine")
    args = (landing, OPTIONS_SCHEMA, os.path.join(base, "hist"), os.path.join(base, "led"),
            os.path.join(base, "ckpt"), "T", DEDUP_KEYS["options"])
    _bars(spark, D1, ["09:15:00", "09:16:00"]).write.mode("append").parquet(landing)
    stream_ingest(spark, *args, quarantine_path=quarantine)
    # the ledger is lost, then a late file re-delivers D1 with another row count
    spark.createDataFrame([("T", "[]")], "target string, dates_json string").write.mode("overwrite").json(args[3])
    _bars(spark, D1, ["09:15:00", "09:16:00", "09:17:00"], close=5.0).write.mode("append").parquet(landing)
    stream_ingest(spark, *args, quarantine_path=quarantine)
    hist = spark.read.parquet(args[2])
    assert hist.count() == 2 and hist.where(F.col("Close") == 5.0).count() == 0
    q = spark.read.parquet(quarantine)
    assert q.count() == 3 and {r["target"] for r in q.select("target").distinct().collect()} == {"T"}


def test_stream_moves_processed_files_out_of_the_landing_folder(spark):
    base = tempfile.mkdtemp(prefix="mb-clean-")
    landing = os.path.join(base, "landing")
    _bars(spark, D1, ["09:15:00", "09:16:00"]).write.mode("append").parquet(landing)
    args = (landing, OPTIONS_SCHEMA, os.path.join(base, "hist"), os.path.join(base, "led"),
            os.path.join(base, "ckpt"), "T", DEDUP_KEYS["options"])
    stream_ingest(spark, *args, processed_dir=os.path.join(base, "processed"))
    _bars(spark, D2, ["09:15:00"]).write.mode("append").parquet(landing)
    stream_ingest(spark, *args, processed_dir=os.path.join(base, "processed"))
    assert spark.read.parquet(args[2]).count() == 3
    assert os.path.isdir(os.path.join(base, "processed"))      # the first run's files were moved
