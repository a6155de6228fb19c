"""No incoming row is lost or counted wrongly: days in several batches, rows without
dates, bad cells, arrival order, broken ledgers, replays, isolation of subsets."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from marketbars.operators import bars as B
from marketbars.operators import ledger as L
from marketbars.operators.contracts import chain_items
from marketbars.plans import ingest as I
from marketbars.plans.collect import build_run, pending_work, produced_work, write_outputs
from marketbars.plans.feeds import build_feeds
from marketbars.plans.ingest import ingest, sync_date
from marketbars.schemas import (
    BAR_PAYLOAD_SCHEMA, DEDUP_KEYS, FUTURES_SCHEMA, OPTIONS_SCHEMA, SPOT_SCHEMA,
)
from marketbars.sinks.writers import WriteError, archive_raw, verified_write
from marketbars.sources.readers import (
    csv_cells, read_bar_payloads, read_bars, read_chain_payloads, read_ledger,
)
from marketbars.streaming.ingest_stream import stream_ingest

from test_collect import MON, TUE, bar, inputs
from test_plans import D1, D2, _bars

KEYS = DEDUP_KEYS["options"]


@pytest.fixture
def base():
    return tempfile.mkdtemp(prefix="mb-safe-")


def stream(spark, base, landing, **more):
    stream_ingest(spark, landing, OPTIONS_SCHEMA, f"{base}/hist", f"{base}/led", f"{base}/ckpt", "T",
                  KEYS, max_files_per_trigger=1, quarantine_path=f"{base}/quarantine", **more)


def test_a_day_in_several_batches_is_kept_whole(spark, base):
    landing = f"{base}/landing"
    times = [f"09:{m:02d}:00" for m in range(15, 23)]
    for i in range(0, 8, 2):
        _bars(spark, D1, times[i:i + 2]).coalesce(1).write.mode("append").parquet(landing)
    # a row that came before, with other values, and a row without a date
    _bars(spark, D1, times[:1], close=9.0).coalesce(1).write.mode("append").parquet(landing)
    _bars(spark, None, times[:1]).coalesce(1).write.mode("append").parquet(landing)
    stream(spark, base, landing)
    hist = spark.read.parquet(f"{base}/hist")
    assert sorted(r["Time"] for r in hist.collect()) == times
    assert spark.read.parquet(f"{base}/quarantine").count() == 1


def test_undated_rows_have_a_status_and_a_copy(spark, base):
    rows = _bars(spark, D1, ["09:15:00"]).unionByName(_bars(spark, None, ["09:15:00", "09:16:00"]))
    got = {r["date"]: (r["status"], r["incoming_rows"])
           for r in ingest(spark, rows, f"{base}/h", f"{base}/l", "T", KEYS).collect()}
    assert got == {D1.isoformat(): ("created", 1), None: ("undated", 2)}
    assert spark.read.parquet(f"{base}/h").count() == 1
    assert spark.read.parquet(f"{base}/h_quarantine").count() == 2
    only = ingest(spark, _bars(spark, None, ["09:15:00"]), f"{base}/h", f"{base}/l", "T", KEYS).collect()
    assert [(r["date"], r["status"]) for r in only] == [(None, "undated")]


def test_spot_rows_of_several_indexes(spark, base):
    ts = dt.datetime(2026, 8, 24, 9, 15)
    rows = spark.createDataFrame([(x, ts, 1.0, 1.0, 1.0, 1.0, 1) for x in ("NIFTY", "BANKNIFTY", "SENSEX")],
                                 SPOT_SCHEMA)
    ingest(spark, rows, f"{base}/h", f"{base}/l", "S", DEDUP_KEYS["spot"])
    assert spark.read.parquet(f"{base}/h").count() == 3
    one = rows.drop("Index").limit(2)           # a history of one index has no such column
    ingest(spark, one, f"{base}/h1", f"{base}/l1", "S", DEDUP_KEYS["spot"])
    assert spark.read.parquet(f"{base}/h1").count() == 1


def test_the_first_arrival_stays(spark, base):
    twice = _bars(spark, D1, ["09:15:00"], close=9.0).unionByName(_bars(spark, D1, ["09:15:00"], close=1.0))
    ingest(spark, twice.coalesce(1), f"{base}/h", f"{base}/l", "T", KEYS)
    assert [r["Close"] for r in spark.read.parquet(f"{base}/h").collect()] == [9.0]
    ordered = twice.withColumn("seq", F.when(F.col("Close") == 9.0, 2).otherwise(1))
    ingest(spark, ordered, f"{base}/h2", f"{base}/l2", "T", KEYS, order_by=["seq"])
    stored = spark.read.parquet(f"{base}/h2")
    assert [r["Close"] for r in stored.collect()] == [1.0] and "seq" not in stored.columns
    # without any natural key in the data the whole row is the key
    ingest(spark, twice.select("Date", "Close").union(twice.select("Date", "Close")), f"{base}/h3",
           f"{base}/l3", "T", ["absent"])
    assert spark.read.parquet(f"{base}/h3").count() == 2


def test_types_are_those_of_the_history(spark, base):
    ingest(spark, _bars(spark, D1, ["09:15:00"]), f"{base}/h", f"{base}/l", "T", KEYS)
    other = _bars(spark, D2, ["09:15:00"]).withColumn("Volume", F.col("Volume").cast("double"))
    ingest(spark, other, f"{base}/h", f"{base}/l", "T", KEYS)
    hist = spark.read.parquet(f"{base}/h")
    assert hist.count() == 2 and dict(hist.dtypes)["Volume"] == "bigint"
    ingest(spark, other, f"{base}/h2", f"{base}/l2", "T", KEYS, schema=OPTIONS_SCHEMA)
    assert dict(spark.read.parquet(f"{base}/h2").dtypes)["Volume"] == "bigint"


def test_an_unreadable_ledger_is_not_an_empty_one(spark, base):
    assert read_ledger(spark, f"{base}/none").count() == 0
    ingest(spark, _bars(spark, D1, ["09:15:00"]), f"{base}/h", f"{base}/l", "T", KEYS)

    class Broken:
        def __getattr__(self, name):
            if name == "read":
                raise OSError("storage is away")
            return getattr(spark, name)
    with pytest.raises(OSError):
        read_ledger(Broken(), f"{base}/l")
    ingest(spark, _bars(spark, D2, ["09:15:00"]), f"{base}/h", f"{base}/l", "T", KEYS)
    dates = sorted(r["date"] for r in L.parse_ledger(read_ledger(spark, f"{base}/l")).collect())
    assert dates == [D1.isoformat(), D2.isoformat()]


def test_a_replay_after_a_crash_records_the_day(spark, base, monkeypatch):
    landing = f"{base}/landing"
    _bars(spark, D1, ["09:15:00", "09:16:00"]).coalesce(1).write.parquet(landing)
    record = I._record
    calls = []

    def fails_once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("lost between publish and ledger")
        return record(*args)
    monkeypatch.setattr(I, "_record", fails_once)
    with pytest.raises(Exception):
        stream(spark, base, landing)
    stream(spark, base, landing)
    assert spark.read.parquet(f"{base}/hist").count() == 2
    assert [r["date"] for r in L.parse_ledger(read_ledger(spark, f"{base}/led")).collect()] == [D1.isoformat()]


def test_one_bad_cell_costs_one_value(spark, base):
    e = bar(MON)[0]
    lines = [
        '{"symbol":"A","trading_date":"2026-08-24","s":"ok","message":"","candles":'
        f'[[{e},"bad",2,0.5,1.5,10,5],[{e},1.25,2,0.5,1.5,10,null]]}}',
        '{"symbol":"B","trading_date":"2026-08-24","s":"ok","message":"","candles":{"x":1}}',
        '{"symbol":"C","trading_date":"2026-08-24","s":"ok","message":"","candles":null}',
        '{"symbol":"D","trading_date":"2026-08-24","s":"ok","message":"","candles":[[null,1,2,0.5,1.5,10,5]]}',
        '{"symbol":"E","trading_date":"2026-08-24","s":"ok","message":"","candles":[1,2]}',
        '{"symbol":"F","trading_date":"2026-08-24","s":"ok","message":""}',
        '{"symbol":"G","trading_date":"2026-08-24","s":"ok","message":"","candles":"text"}',
        '{"symbol":"H","trading_date":"2026-08-24","s":"ok","message":"","candles":[]}']
    path = f"{base}/payloads.json"
    with open(path, "w") as f:
        f.write("\n".join(lines))
    p = read_bar_payloads(spark, path)
    got = {r["symbol"]: r["outcome"] for r in B.payload_outcomes(p, "options", 7).collect()}
    assert got == {"A": "ok", "B": "failed", "C": "no_data", "D": "failed", "E": "failed", "F": "no_data",
                   "G": "failed", "H": "no_data"}
    rows = sorted((r["Open"] is None, r["Open"], r["OpenInterest"]) for r in B.explode_bars(p, 7).collect())
    assert rows == [(False, 1.25, None), (True, None, 5)]


def test_strikes_may_be_text(spark, base):
    from marketbars.functions.coerce import strike_to_int
    path = f"{base}/chains.json"
    with open(path, "w") as f:
        f.write('{"underlying":"NIFTY","trading_date":"2026-08-24","requested_expiry":"E","s":"ok","data":{"optionsChain":'
                '[{"symbol":"a","option_type":"CE","strike_price":"100.0"},{"symbol":"b","option_type":"CE",'
                '"strike_price":250},{"symbol":"c","option_type":"CE","strike_price":"abc"},'
                '{"symbol":"d","option_type":"CE","strike_price":-1}]}}')
    items = chain_items(read_chain_payloads(spark, path))
    got = {r["symbol"]: r["k"] for r in items.select("symbol", strike_to_int(F.col("strike_price")).alias("k")).collect()}
    assert got == {"a": 100, "b": 250, "c": None, "d": None}


def test_counters_follow_what_was_asked_and_kept(spark):
    t = build_run(spark, start="2026-08-22", end="2026-08-25", **inputs(spark))
    counts = {(r["date"], r["kind"]): r for r in t["counts"].collect()}
    tables = {k: {r["d"]: r["n"] for r in t[k].groupBy(c.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
              for k, c in (("options", F.col("Date")), ("futures", F.col("Date")),
                           ("spot", F.to_date("timestamp")))}
    for (day, kind), r in counts.items():
        assert r["rows"] == tables[kind].get(day, 0), (day, kind)
    # the fourth future was not asked for; three were, one answered on each day
    assert [counts[(d, "futures")]["contracts"] for d in (MON, TUE)] == [3, 3]
    assert [counts[(d, "futures")]["failed"] for d in (MON, TUE)] == [2, 2]
    assert counts[(MON, "spot")]["contracts"] == 3 and counts[(MON, "spot")]["failed"] == 2
    only = build_run(spark, start="2026-08-22", end="2026-08-25", selected=["NIFTY"], **inputs(spark))
    assert {(r["date"], r["contracts"]) for r in only["counts"].where("kind = 'spot'").collect()} == \
        {(MON, 1), (TUE, 1)}
    assert {r["underlying"] for r in t["unresolved"].collect()} == {"BANKNIFTY", "SENSEX"}
    assert {(r["Index"], r["rows"]) for r in t["spot_rows"].collect()} == {("NIFTY", 1), ("SENSEX", 1)}
    assert sum(r["off_date"] for r in t["off_date"].collect()) == 0


def test_a_kind_without_any_answer_is_an_error(spark):
    given = inputs(spark)
    given["futures_payloads"] = given["futures_payloads"].where("false")
    t = build_run(spark, start="2026-08-24", end="2026-08-25", **given)
    assert {r["status"] for r in t["status"].collect()} == {"partial"}
    given["master_cells"] = given["master_cells"].where("false")        # nothing to ask for
    t = build_run(spark, start="2026-08-24", end="2026-08-25", **given)
    assert {r["status"] for r in t["status"].collect()} == {"partial"}


def test_one_bad_subset_does_not_keep_the_others(spark, base):
    t = dict(build_run(spark, start="2026-08-24", end="2026-08-25", **inputs(spark)))
    t["options"] = t["options"].withColumn("High", F.when(F.col("Date") == MON, 0.0).otherwise(F.col("High")))
    report = {(r["kind"], r["exchange"], r["date"]): (r["status"], r["rows"])
              for r in write_outputs(spark, t, base).collect()}
    assert report[("options", "NSE", MON)][0] == "invalid"
    assert report[("options", "NSE", TUE)] == ("written", 3) and report[("options", "BSE", TUE)] == ("written", 1)
    assert report[("futures", None, MON)] == ("written", 1) and report[("spot", None, TUE)] == ("written", 1)
    stored = spark.read.parquet(f"{base}/options")
    assert {r["trade_date"] for r in stored.select("trade_date").distinct().collect()} == {TUE}
    # a kind that breaks is reported, and the others are written
    t["futures"] = t["futures"].withColumn("Volume", F.expr("1 div (Volume - Volume)"))
    again = {r["kind"]: r["status"] for r in write_outputs(spark, t, f"{base}/again").collect()}
    assert again["futures"] == "error" and again["spot"] == "written"
    t["options"] = t["options"].where("false")
    assert ("options", "empty") in {(r["kind"], r["status"]) for r in write_outputs(spark, t, base).collect()}


def test_pending_work_per_kind(spark, base):
    t = build_run(spark, start="2026-08-24", end="2026-08-25", **inputs(spark))
    write_outputs(spark, t, base)

    def pending():
        return {(r["trading_date"], r["kind"]) for r in
                pending_work(spark, "2026-08-24", "2026-08-25", base).collect()}
    assert pending() == {(MON, "options"), (MON, "spot"), (TUE, "spot")}
    # a day of another shape, or an empty one, is collected again
    tue = f"{base}/options/exchange=BSE/trade_date={TUE}"
    spark.createDataFrame([(1,)], "x int").write.mode("overwrite").parquet(tue)
    assert (TUE, "options") in pending()
    valid = {(r["kind"], r["exchange"], r["trading_date"]): r["valid"]
             for r in produced_work(spark, base).collect()}
    assert not valid[("options", "BSE", TUE)] and valid[("futures", None, MON)]
    run = build_run(spark, start="2026-08-24", end="2026-08-25", **inputs(spark),
                    pending=pending_work(spark, "2026-08-24", "2026-08-25", base))
    assert run["futures"].count() == 0 and run["options"].count() == 5 and run["spot"].count() == 2
    assert {r["kind"] for r in run["counts"].collect()} == {"options", "spot"}


def test_feeds_by_exchange_year_and_index(spark, base):
    new_year = dt.date(2027, 1, 4)
    options = (_bars(spark, D1, ["09:15:00", "09:16:00"]).unionByName(_bars(spark, new_year, ["09:15:00"]))
               .unionByName(_bars(spark, D1, ["09:15:00"]).withColumn("Underlying", F.lit("SENSEX"))
                            .withColumn("Ticker", F.lit("BSE:X")))
               .unionByName(_bars(spark, D1, ["09:15:00"]).withColumn("Underlying", F.lit("OTHER"))))
    futures = spark.createDataFrame([("NIFTY-I.NFO", D1, "09:15:00", 1.0, 2.0, 0.5, 1.5, 5, 7, "x", "NIFTY", "I")],
                                    FUTURES_SCHEMA)
    spot = spark.createDataFrame([(x, dt.datetime(2026, 8, 24, 9, m), 1.0, 2.0, 0.5, 1.5, 3)
                                  for x in ("NIFTY", "SENSEX") for m in (15, 16)], SPOT_SCHEMA)
    feeds = build_feeds(spark, {"options": options, "futures": futures, "spot": spot}, base, archive=True)
    assert [f["target"] for f in feeds] == [
        "BSE_INDEX_OPTIONS_2026.parquet", "NSE_INDEX_OPTIONS_2026.parquet", "NSE_INDEX_OPTIONS_2027.parquet",
        None, "INDEX_FUTURES_2026.parquet", "Nifty 50.csv", "Sensex.csv"]
    first = {(r["target"], r["status"], r["rows_added"], r["archived"]) for r in sync_date(spark, feeds).collect()}
    assert ("NSE_INDEX_OPTIONS_2026.parquet", "created", 2, True) in first and len(first) == 7
    assert (None, "unrouted", 0, False) in first
    again = {r["status"] for r in sync_date(spark, feeds).collect()}
    assert again == {"already_ingested", "unrouted"}
    # a later day is appended to the CSV history of its index
    later = spot.withColumn("timestamp", F.expr("timestamp + interval 1 day"))
    out = sync_date(spark, build_feeds(spark, {"spot": later}, base)).collect()
    assert {(r["target"], r["status"], r["rows_added"]) for r in out} == \
        {("Nifty 50.csv", "updated", 2), ("Sensex.csv", "updated", 2)}
    csv = spark.read.option("header", True).csv(f"{base}/spot/Nifty 50.csv")
    assert csv.count() == 4 and {r["Index"] for r in csv.collect()} == {"NIFTY"}


def test_archive_keeps_one_copy_of_a_day(spark, base):
    day = _bars(spark, D1, ["09:15:00"]).withColumn("trade_date", F.col("Date"))
    for _ in range(2):
        archive_raw(day, f"{base}/archive")
    stored = spark.read.parquet(f"{base}/archive")
    assert stored.count() == 1 and str(stored.first()["ingest_date"]) == D1.isoformat()


def test_verified_write_replaces_partitions_and_guards_others(spark, base):
    two = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "x int, p string")
    assert verified_write(spark, two, f"{base}/t", ["p"]) == 3
    new = spark.createDataFrame([(9, "b"), (8, "b")], "x int, p string")
    assert verified_write(spark, new, f"{base}/t", ["p"], "overwrite") == 2
    assert sorted((r["x"], r["p"]) for r in spark.read.parquet(f"{base}/t").collect()) == \
        [(1, "a"), (2, "a"), (8, "b"), (9, "b")]
    assert not [n for n in os.listdir(f"{base}/t") if n.startswith("_old")]
    with pytest.raises(Exception):              # the no-clobber guard
        verified_write(spark, new, f"{base}/t", ["p"])
    assert issubclass(WriteError, RuntimeError)


def test_master_cells(spark):
    lines = ['a,5" pipe,c', '"x, ""y""",z', ' "q" ,w', '', ',,', '"open,b', 'a,"b"c,d']
    df = spark.createDataFrame([(s,) for s in lines], "line string")
    got = [r["c"] for r in df.select(csv_cells(F.col("line")).alias("c")).collect()]
    assert got == [["a", '5" pipe', "c"], ['x, "y"', "z"], ["q", "w"], [""], ["", "", ""],
                   ['"open', "b"], ["a", '"b"c', "d"]]


def test_times_do_not_depend_on_the_session_zone(spark, base):
    from marketbars.functions.timefmt import bar_time, bar_timestamp_text
    before = spark.conf.get("spark.sql.session.timeZone")
    gap = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "w timestamp_ntz")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = gap.select(bar_time(F.col("w")).alias("t"), bar_timestamp_text(F.col("w")).alias("x")).first()
        spot = spark.createDataFrame([("N", dt.datetime(2024, 3, 10, 2, 30), 1.0, 1.0, 1.0, 1.0, 1)], SPOT_SCHEMA)
        verified_write(spark, spot, f"{base}/csv", fmt="csv")
        back = read_bars(spark, f"{base}/csv", "spot", "csv").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == ("02:30:00", "2024-03-10 02:30:00")
    assert back["timestamp"] == dt.datetime(2024, 3, 10, 2, 30)


def test_outcomes_take_the_best_of_several_answers(spark):
    asked = spark.createDataFrame([(MON, "A"), (MON, "B")], "trading_date date, symbol string")
    p = spark.createDataFrame([("A", MON, "error", "", None), ("A", MON, "ok", "", [bar(MON)]),
                               ("A", MON, "ok", "", [bar(MON, mm=16)]), ("C", MON, "ok", "", [bar(MON)])],
                              BAR_PAYLOAD_SCHEMA)
    got = {r["symbol"]: (r["outcome"], r["rows"]) for r in B.payload_outcomes(p, "options", 7, asked).collect()}
    assert got == {"A": ("ok", 2), "B": ("failed", 0)}


def test_the_shared_folder_must_be_named_on_a_cluster(spark):
    from marketbars.session import shared_dir

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(ValueError):
        shared_dir(Session())


def test_rows_of_a_sync_are_not_dealt_by_index(spark):
    import datetime as dt
    from marketbars.plans.feeds import routed
    rows = spark.createDataFrame(
        [(u, dt.date(2024, 1, 2)) for u in ("NIFTY", "SENSEX", "OTHER", None)] + [("NIFTY", None)],
        "Underlying string, Date date")
    out = routed(spark, "options", rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert [r.target for r in out.collect()] == [
        "NSE_INDEX_OPTIONS_2024.parquet", "BSE_INDEX_OPTIONS_2024.parquet", None, None, None]


def test_sync_of_rows_that_are_not_kept(spark, tmp_path):
    import datetime as dt
    from pyspark.sql import functions as F
    from marketbars.plans.feeds import dead_letters, sync_tables
    from marketbars.schemas import FUTURES_SCHEMA
    day = dt.date(2024, 1, 2)
    some = spark.range(40).select(*[
        (F.lit(day) if f.name == "Date" else F.lit("09:15:00") if f.name == "Time"
         else F.concat(F.lit("T"), F.col("id") % 20) if f.name == "Ticker" else F.lit(1))
        .cast(f.dataType).alias(f.name) for f in FUTURES_SCHEMA.fields])
    lost = some.limit(3).withColumn("Date", F.lit(None).cast("date"))
    tables = {"futures": some.unionByName(lost)}
    for status, added in (("created", 20), ("already_ingested", 0)):
        got = {(r.target, r.status): r.rows_added
               for r in sync_tables(spark, tables, str(tmp_path), keep_rows=False).collect()}
        assert got[("INDEX_FUTURES_2024.parquet", status)] == added
    assert dead_letters(spark, str(tmp_path), "futures").count() == 6
    assert not spark.sparkContext._jsc.getPersistentRDDs()
