"""Crashes at every step of a publish and of the ledger, order of arrival, quarantine and
its release, dead letters, checksums, counts from footers."""

import datetime as dt
import json
import os
import shutil
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from marketbars.operators import ledger as L
from marketbars.plans import ingest as I
from marketbars.plans.feeds import build_feeds, dead_letters, sync_tables
from marketbars.plans.ingest import ingest, quarantined, release, sync_date
from marketbars.sinks import journal, ledger_log, writers
from marketbars.sinks.journal import WriteError, publish, recover
from marketbars.sinks.storage import Storage
from marketbars.sinks.writers import stage_and_publish, verified_write
from marketbars.sources.readers import footer_counts, partition_counts, read_ledger
from marketbars.streaming.ingest_stream import stream_ingest

from test_plans import D1, D2, _bars

SCHEMA = "id long, day date, v double"


def day_of():
    return F.col("day")


class Crash(RuntimeError):
    pass


@pytest.fixture
def base():
    return tempfile.mkdtemp(prefix="mb-journal-")


def rows(spark, *values):
    return spark.createDataFrame([(i, d, float(v)) for i, d, v in values], SCHEMA)


def own(base):
    return dict(history_path=f"{base}/h", ledger_path=f"{base}/l", target="T", keys=["id"], date_of=day_of())


def stored(spark, base):
    if not os.path.isdir(f"{base}/h"):
        return []
    return sorted((r["id"], r["v"]) for r in spark.read.parquet(f"{base}/h").collect())


def dates(spark, path):
    return sorted((r["target"], r["date"]) for r in L.parse_ledger(read_ledger(spark, path)).collect())


def test_a_crash_after_any_move_loses_nothing(spark, base, monkeypatch):
    move, step = Storage.move, 0
    monkeypatch.setattr(journal, "MOVES", 1)
    while True:
        here = f"{base}/{step}"
        ingest(spark, rows(spark, (1, D1, 1), (2, D2, 1)), **own(here))
        calls = []

        def stops(self, source, target, calls=calls, step=step):
            calls.append(source)
            if len(calls) > step:
                raise Crash(source)
            return move(self, source, target)
        monkeypatch.setattr(Storage, "move", stops)
        more = rows(spark, (3, D1, 2), (4, D2, 2), (1, D1, 9))
        try:
            ingest(spark, more, **own(here), merge_ledgered=True)
            whole = True
        except Crash:
            whole = False
        monkeypatch.setattr(Storage, "move", move)
        ingest(spark, rows(spark, (5, D1, 3)), **own(here), merge_ledgered=True)
        ingest(spark, more, **own(here), merge_ledgered=True)       # what failed is run again
        assert stored(spark, here) == [(1, 1.0), (2, 1.0), (3, 2.0), (4, 2.0), (5, 3.0)], step
        assert dates(spark, f"{here}/l") == [("T", str(D1)), ("T", str(D2))]
        assert not Storage(spark, here).names(f"{here}/h/_publish")
        step += 1
        if whole:
            break
    assert step > 6         # the intent, two partitions with their old ones, the ledger, the end


def test_a_partition_set_aside_returns_before_anything_is_read(spark, base):
    ingest(spark, rows(spark, (1, D1, 1), (2, D1, 1)), **own(base))
    day = f"trade_date={D1}"
    os.rename(f"{base}/h/{day}", f"{base}/h/_old.{day}")
    got = ingest(spark, rows(spark, (3, D1, 1)), **own(base), merge_ledgered=True).first()
    assert (got["status"], got["rows_after"]) == ("updated", 3)
    assert [i for i, _ in stored(spark, base)] == [1, 2, 3]
    # with something in its place it is a leftover
    shutil.copytree(f"{base}/h/{day}", f"{base}/h/_old.{day}")
    assert recover(spark, f"{base}/h") == [] and not os.path.exists(f"{base}/h/_old.{day}")


def test_a_publish_whose_staged_rows_are_lost_is_taken_back(spark, base):
    target = f"{base}/h"
    verified_write(spark, rows(spark, (1, D1, 1), (2, D2, 1)).withColumn("trade_date", day_of()), target, ["trade_date"])
    staging = f"{base}/staged"
    new = rows(spark, (3, D1, 2), (4, D2, 2), (5, dt.date(2026, 8, 26), 2)).withColumn("trade_date", day_of())
    verified_write(spark, new, staging, ["trade_date"])

    def bad(places):
        raise WriteError("not what was written")
    with pytest.raises(WriteError):
        publish(spark, staging, target, 1, verify=bad)
    assert stored(spark, base) == [(1, 1.0), (2, 1.0)]
    # a crash in the middle, and the shared folder is cleaned before the next run
    verified_write(spark, new, staging, ["trade_date"])
    names = sorted(n for n in os.listdir(staging) if "=" in n)
    entry = f"{target}/_publish/x"
    os.makedirs(entry)
    with open(f"{entry}/intent.json", "w") as f:
        json.dump({"staging": staging, "partitions": [[[n], i < 2] for i, n in enumerate(names)],
                   "note": {"ledger_path": "none"}}, f)
    os.makedirs(f"{entry}/old")
    os.rename(f"{target}/{names[0]}", f"{entry}/old/{names[0]}")
    os.rename(f"{staging}/{names[0]}", f"{target}/{names[0]}")
    os.rename(f"{staging}/{names[2]}", f"{target}/{names[2]}")
    shutil.rmtree(staging)
    acted = []
    assert {what for what, _ in recover(spark, target, 1, acted.append)} == {"taken back"}
    assert stored(spark, base) == [(1, 1.0), (2, 1.0)] and acted == []
    assert recover(spark, target) == []


def test_swapped_values_are_refused(spark, base, monkeypatch):
    target = f"{base}/h"
    good = rows(spark, (1, D1, 1), (2, D1, 2)).withColumn("trade_date", day_of())
    swapped = rows(spark, (1, D1, 2), (2, D1, 1)).withColumn("trade_date", day_of())
    read_back, seen = writers.read_back, []

    def tampered(spark_, path, *args):
        if path.endswith("staged") and not seen:
            seen.append(path)
            shutil.rmtree(path)
            swapped.write.partitionBy("trade_date").parquet(path)
        return read_back(spark_, path, *args)
    monkeypatch.setattr(writers, "read_back", tampered)
    with pytest.raises(WriteError, match="contents"):
        stage_and_publish(spark, good, f"{base}/staged", target)
    assert stored(spark, base) == []
    for fmt in ("parquet", "csv"):
        text = good.withColumn("s", F.lit(' a "b", c ')).withColumn("n", F.lit(None).cast("int")).withColumn(
            "w", F.lit("2026-08-24 09:15:00").cast("timestamp_ntz"))
        assert verified_write(spark, text, f"{base}/{fmt}", ["trade_date"], fmt=fmt) == 2
    assert verified_write(spark, good.where("false"), f"{base}/none") == 0
    nested = spark.sql("SELECT map('a', 1, 'b', 2) AS m, array(1.5, null) AS a, named_struct('x', 'y') AS s")
    assert verified_write(spark, nested, f"{base}/nested") == 1


def test_the_ledger_is_a_log(spark, base, monkeypatch):
    path = f"{base}/l"

    def writer(name):
        for i in range(1, 9):
            ledger_log.append(spark, path, {name: [f"2026-08-{i:02d}"]}, compact_at=10 ** 6)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(writer, "AB"))
    every = sorted((t, f"2026-08-{i:02d}") for t in "AB" for i in range(1, 9))
    assert dates(spark, path) == every and len(os.listdir(path)) >= 16
    ledger_log.compact(spark, path)
    assert dates(spark, path) == every and len([n for n in os.listdir(path) if n.startswith("batch")]) == 16
    ledger_log.append(spark, path, {"A": ["2026-08-09"]})
    ledger_log.compact(spark, path)
    every = sorted([*every, ("A", "2026-08-09")])
    assert dates(spark, path) == every
    assert [n.split("-")[0] for n in sorted(os.listdir(path)) if n.endswith(".json")] == ["batch"] + ["snapshot"] * 2
    # a crash at any file operation of a compaction leaves every date
    for name in ("move", "remove", "write"):
        real = getattr(Storage, name)
        for step in range(4):
            left = [step]

            def stops(self, *args, real=real, left=left):
                left[0] -= 1
                if left[0] < 0:
                    raise Crash(args[0])
                return real(self, *args)
            monkeypatch.setattr(Storage, name, stops)
            try:
                ledger_log.compact(spark, path)
            except Crash:
                pass
            monkeypatch.setattr(Storage, name, real)
            assert dates(spark, path) == every, (name, step)
    ledger_log.compact(spark, path)
    assert dates(spark, path) == every


def test_streams_keep_the_first_arrival(spark, base):
    landing = f"{base}/landing"
    for fmt, n in (("parquet", 0), ("csv", 1)):
        place = f"{landing}{n}"
        first = rows(spark, (7, D1, 1)).coalesce(1).write.mode("append")
        many = spark.range(20_000).select("id", F.lit(D1).alias("day"), F.lit(2.0).alias("v")).coalesce(1)
        getattr(first, fmt)(place)
        getattr(many.write.mode("append"), fmt)(place)
        here = f"{base}/{fmt}"
        stream_ingest(spark, place, many.schema, f"{here}/h", f"{here}/l", f"{here}/c", "T", ["id"], fmt=fmt,
                      date_of=day_of())
        got = spark.read.parquet(f"{here}/h")
        assert got.count() == 20_000 and got.where("v = 1.0").select("id").collect() == [(7,)]


def test_redelivered_rows_meet_the_streams_state(spark, base):
    landing, args = f"{base}/landing", ("T", ["id"])
    own_ = (landing, rows(spark).schema, f"{base}/h", f"{base}/l", f"{base}/c", *args)
    rows(spark, (1, D1, 1), (2, D1, 1)).write.mode("append").parquet(landing)
    stream_ingest(spark, *own_, date_of=day_of(), redelivered_within="1 day")
    # after a restart: one row again, one of a known key with another value, one new
    rows(spark, (1, D1, 1), (2, D1, 5), (3, D1, 1)).write.mode("append").parquet(landing)
    progress = stream_ingest(spark, *own_, date_of=day_of(), redelivered_within="1 day")
    assert stored(spark, base) == [(1, 1.0), (2, 1.0), (3, 1.0)]
    assert sum(s["numRowsUpdated"] for p in progress for s in p["stateOperators"]) == 2


def test_two_runs_keep_their_quarantined_rows_and_release_them_once(spark, base):
    held = f"{base}/q"
    for i in (1, 2):
        ingest(spark, rows(spark, (i, None, i)), **own(base), quarantine_path=held)
    assert quarantined(spark, held).agg(F.sum("rows")).first()[0] == 2
    # a day that history holds differently
    ingest(spark, rows(spark, (10, D1, 1), (11, D1, 1)), **{**own(base), "ledger_path": f"{base}/lost"})
    came = rows(spark, (10, D1, 7), (12, D1, 7), (12, D1, 8), (13, D1, 7))
    status = [r["status"] for r in ingest(spark, came.coalesce(1), **own(base), quarantine_path=held).collect()]
    assert status == ["mismatch"]
    by_reason = {r["reason"]: (r["rows"], r["batch"]) for r in
                 quarantined(spark, held).groupBy("reason").agg(F.sum("rows").alias("rows"),
                                                                F.max("batch").alias("batch")).collect()}
    assert (by_reason["mismatch"][0], by_reason["undated"][0]) == (4, 2)
    assert release(spark, held, **{k: v for k, v in own(base).items() if k != "date_of"},
                   batches=["no such"]).collect() == []
    keep = {k: v for k, v in own(base).items() if k != "date_of"}
    out = release(spark, held, **keep, batches=[by_reason["mismatch"][1]]).collect()
    assert [(r["status"], r["rows_added"]) for r in out] == [("released", 2)]
    assert stored(spark, base) == [(10, 1.0), (11, 1.0), (12, 7.0), (13, 7.0)]
    assert {r["reason"]: r["rows"] for r in quarantined(spark, held).groupBy("reason").agg(
        F.sum("rows").alias("rows")).collect()} == {"undated": 2}
    assert release(spark, held, **keep).collect() == []        # undated rows need a date
    out = release(spark, held, **keep, date_of=F.lit(D2)).collect()
    assert [(r["date"], r["status"], r["rows_added"]) for r in out] == [(str(D2), "updated", 2)]
    assert quarantined(spark, held).count() == 0 and len(stored(spark, base)) == 6
    assert release(spark, held, **keep, date_of=F.lit(D2)).collect() == []


def test_rows_that_no_target_takes(spark, base):
    both = _bars(spark, D1, ["09:15:00"]).unionByName(
        _bars(spark, D1, ["09:16:00"]).withColumn("Underlying", F.lit("OTHER")))
    feeds = build_feeds(spark, {"options": both}, f"{base}/a")
    got = sorted((str(r["target"]), r["status"]) for r in sync_date(spark, feeds).collect())
    assert got == [("NSE_INDEX_OPTIONS_2026.parquet", "created"), ("None", "unrouted")]
    assert [r["Time"] for r in dead_letters(spark, f"{base}/a", "options").collect()] == ["09:16:00"]
    assert {r["status"] for r in sync_date(spark, feeds, dry_run=True).collect()} == {"already_ingested", "unrouted"}
    assert dead_letters(spark, f"{base}/a", "options").count() == 1


def test_all_targets_in_one_job(spark, base, monkeypatch):
    later = dt.date(2027, 1, 4)
    options = (_bars(spark, D1, ["09:15:00", "09:16:00"]).unionByName(_bars(spark, later, ["09:15:00"]))
               .unionByName(_bars(spark, D1, ["09:15:00"]).withColumn("Underlying", F.lit("SENSEX")))
               .unionByName(_bars(spark, None, ["09:15:00"]))
               .unionByName(_bars(spark, D1, ["09:17:00"]).withColumn("Underlying", F.lit("OTHER"))))

    def run(tables, **flags):
        return sorted((str(r["target"]), str(r["date"]), r["status"], r["rows_added"])
                      for r in sync_tables(spark, tables, base, **flags).collect())
    nse = "NSE_INDEX_OPTIONS_{}.parquet"
    assert run({"options": options}, dry_run=True)[0][2] == "dry_run" and not os.path.isdir(f"{base}/options")
    assert run({"options": options}) == [
        ("BSE_INDEX_OPTIONS_2026.parquet", str(D1), "created", 1), (nse.format(2026), str(D1), "created", 2),
        (nse.format(2027), str(later), "created", 1), ("None", "None", "unrouted", 0)]
    # the same keys in another target are other rows; a day in another batch is merged
    more = _bars(spark, D1, ["09:15:00", "09:18:00"], close=9.0)
    assert run({"options": more}, merge_ledgered=True) == [(nse.format(2026), str(D1), "updated", 1)]
    back = spark.read.parquet(f"{base}/options")
    assert back.count() == 5 and back.where("Close = 9.0").count() == 1
    assert len(dates(spark, f"{base}/ledger")) == 3
    # a target that fails doesn't keep the others from being synced
    merged = I._merged

    def breaks(spark_, incoming, path, stored_, targets, to_merge, *args):
        if any("BSE" in t for t, _ in to_merge):
            raise Crash("this target")
        return merged(spark_, incoming, path, stored_, targets, to_merge, *args)
    monkeypatch.setattr(I, "_merged", breaks)
    got = {r[0]: r[2] for r in run({"options": options.withColumn("Date", F.lit(D2))})}
    assert got["BSE_INDEX_OPTIONS_2026.parquet"] == "error" and got[nse.format(2026)] == "updated"


def test_counts_come_from_the_footers(spark, base):
    verified_write(spark, rows(spark, (1, D1, 1), (2, D1, 1), (3, D2, 1)).withColumn("trade_date", day_of()),
                   f"{base}/h", ["trade_date"])
    dirs = [f"{base}/h/trade_date={d}" for d in (D1, D2)]
    assert sorted(partition_counts(spark, f"{base}/h", dirs, ["trade_date"])) == [(str(D1), 2), (str(D2), 1)]
    assert partition_counts(spark, f"{base}/h", [], ["trade_date"]) == []
    with footer_counts(spark):
        plan = (spark.read.option("basePath", f"{base}/h").schema("trade_date date").parquet(*dirs)
                .groupBy("trade_date").count()._jdf.queryExecution().toString())
    assert "PushedAggregation: [COUNT(*)]" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_outputs_on_another_file_system_are_staged_there(spark, base, monkeypatch):
    monkeypatch.setattr(Storage, "same_as", lambda self, path: path.startswith(base))
    staging = journal.staging_path(spark, f"{base}/h")
    assert staging.startswith(f"{base}/h/_publish/")
    assert stage_and_publish(spark, rows(spark, (1, D1, 1)).withColumn("trade_date", day_of()), staging, f"{base}/h") == 1
    assert stored(spark, base) == [(1, 1.0)]
