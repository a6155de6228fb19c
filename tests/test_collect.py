import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from marketbars.operators import contracts as C
from marketbars.plans.collect import build_run, pending_dates, run_dates, write_outputs
from marketbars.plans.day_report import day_report
from marketbars.schemas import BAR_PAYLOAD_SCHEMA, CHAIN_PAYLOAD_SCHEMA

MON, TUE = dt.date(2026, 8, 24), dt.date(2026, 8, 25)


def epoch(d, hh=9, mm=15):   # exchange wall clock -> epoch seconds
    return (dt.datetime(d.year, d.month, d.day, hh, mm) - dt.timedelta(hours=5, minutes=30)
            - dt.datetime(1970, 1, 1)).total_seconds()


def bar(d, n=7, mm=15):
    return [str(x) for x in [epoch(d, 9, mm), 10.0, 12.0, 9.0, 11.0, 100.0, 50.0][:n]]


def inputs(spark):
    def listing(u, d):
        return (u, d, "", "ok", "", {"expiryData": [{"date": "27-08-2026", "expiry": "E1"},
                                                   {"date": "3-9-2026", "expiry": "E2"}], "optionsChain": None})

    def chain(u, d, e, opts):
        return (u, d, e, "ok", "", {"expiryData": None, "optionsChain": [
            {"symbol": s, "option_type": t, "strike_price": str(k)} for s, t, k in opts]})
    chain_listing = spark.createDataFrame([listing("NIFTY", MON), listing("NIFTY", TUE),
                                           listing("SENSEX", TUE)], CHAIN_PAYLOAD_SCHEMA)
    chains = spark.createDataFrame([
        chain("NIFTY", MON, "E1", [("NSE:NIFTY26AUG100CE", "CE", 100.0)]),
        chain("NIFTY", TUE, "E1", [("NSE:NIFTY26AUG100CE", "CE", 100.0), ("NSE:NIFTY26AUG100PE", "PE", 100.0)]),
        chain("NIFTY", TUE, "E2", [("NSE:NIFTY26SEP100CE", "CE", 100.0)]),
        chain("SENSEX", TUE, "E1", [("BSE:SENSEX26AUG100CE", "CE", 100.0)]),
    ], CHAIN_PAYLOAD_SCHEMA)
    option_payloads = spark.createDataFrame([
        ("NSE:NIFTY26AUG100CE", MON, "ok", "", [bar(MON)]),
        ("NSE:NIFTY26AUG100CE", TUE, "ok", "", [bar(TUE), bar(TUE, mm=16)]),
        ("NSE:NIFTY26AUG100PE", TUE, "no_data", "", None),
        ("NSE:NIFTY26SEP100CE", TUE, "ok", "", [bar(TUE)]),
        ("BSE:SENSEX26AUG100CE", TUE, "ok", "", [bar(TUE)]),
    ], BAR_PAYLOAD_SCHEMA)
    ep = lambda d: str(int(epoch(d, 15, 30)))
    master = spark.createDataFrame([(c,) for c in [
        ["1", ep(dt.date(2026, 8, 25)), "NSE:NIFTY26AUGFUT"],
        ["2", ep(dt.date(2026, 9, 29)), "NSE:NIFTY26SEPFUT"],
        ["3", ep(dt.date(2026, 10, 27)), "NSE:NIFTY26OCTFUT"],
        ["4", ep(dt.date(2026, 11, 24)), "NSE:NIFTY26NOVFUT"],
    ]], "cells array<string>")
    futures_payloads = spark.createDataFrame([
        ("NSE:NIFTY26AUGFUT", MON, "ok", "", [bar(MON)]),
        ("NSE:NIFTY26AUGFUT", TUE, "ok", "", [bar(TUE)]),
        ("NSE:NIFTY26NOVFUT", TUE, "ok", "", [bar(TUE)]),   # not among the three nearest on TUE
    ], BAR_PAYLOAD_SCHEMA)
    spot_payloads = spark.createDataFrame([
        ("NSE:NIFTY50-INDEX", MON, "ok", "", [bar(MON, 6), bar(MON, 6)]),   # duplicate timestamp
        ("BSE:SENSEX-INDEX", TUE, "ok", "", [bar(TUE, 6)]),
    ], BAR_PAYLOAD_SCHEMA)
    return dict(option_payloads=option_payloads, futures_payloads=futures_payloads,
                spot_payloads=spot_payloads, chain_listing=chain_listing, chains=chains, master_cells=master)


def test_run_dates_skips_weekend_and_holiday(spark):
    got = {r["date"].isoformat(): r["status"] for r in run_dates(spark, "2026-01-24", "2026-01-27").collect()}
    assert got == {"2026-01-24": "weekend", "2026-01-25": "weekend", "2026-01-26": "holiday",
                   "2026-01-27": "trading"}


def test_build_run_write_and_report(spark):
    t = build_run(spark, start="2026-08-22", end="2026-08-25", **inputs(spark))
    assert t["options"].count() == 5
    fut = {(r["trading_date"], r["symbol"]): r["contract_series"] for r in t["futures_contracts"].collect()}
    assert fut[(TUE, "NSE:NIFTY26AUGFUT")] == "I" and (TUE, "NSE:NIFTY26NOVFUT") not in fut
    assert fut[(MON, "NSE:NIFTY26OCTFUT")] == "III"
    assert t["futures"].count() == 2
    assert t["spot"].count() == 2
    st = {r["date"]: r["status"] for r in t["status"].collect()}
    assert st == {MON: "downloaded", TUE: "downloaded"}
    disc = {(r["underlying"], r["trading_date"]): (r["expiries"], r["contracts"], r["status"])
            for r in t["discovery"].collect()}
    assert disc[("NIFTY", TUE)] == (2, 3, "ok") and disc[("SENSEX", TUE)] == (2, 1, "ok")
    assert disc[("SENSEX", MON)] == (0, 0, "no_expiries") and disc[("BANKNIFTY", TUE)][2] == "no_expiries"
    assert len(disc) == 6
    # a failed discovery counts as one failed options outcome of its day, no contract
    opt = {r["date"]: (r["contracts"], r["failed"]) for r in t["counts"].where("kind = 'options'").collect()}
    assert opt[MON] == (1, 2) and opt[TUE][1] == 1
    out = tempfile.mkdtemp(prefix="mb-collect-")
    write_outputs(spark, t, out)
    assert sorted(p for p in os.listdir(os.path.join(out, "options")) if p.startswith("exchange=")) == \
        ["exchange=BSE", "exchange=NSE"]
    pend = [r["trading_date"] for r in pending_dates(spark, "2026-08-24", "2026-08-25", out).collect()]
    assert pend == [MON]         # Monday has no BSE options: not complete
    from marketbars.plans.collect import completed_dates
    assert [r["trading_date"] for r in completed_dates(spark, out, "2026-08-25", "2026-08-25").collect()] == [TUE]
    assert completed_dates(spark, out, "2026-09-01", "2026-09-30").count() == 0     # no day of the range read
    assert completed_dates(spark, os.path.join(out, "absent")).count() == 0
    rep = {r["file_name"]: (r["present"], r["summary"]) for r in day_report(spark, out, "2026-08-25").collect()}
    assert rep["options_nse.parquet"] == (True, "3 rows | indexes: NIFTY | 2 contracts")
    assert rep["options_bse.parquet"] == (True, "1 rows | indexes: SENSEX | 1 contracts")
    assert rep["spot_Nifty 50.csv"][0] is False and rep["spot_Sensex.csv"][0] is True


def test_range_resolution_matches_single_date(spark):
    cells = inputs(spark)["master_cells"]
    specs = C.futures_spec_dim(spark)
    days = spark.createDataFrame([(MON,), (TUE,)], "trading_date date")
    rng = {(r["trading_date"], r["rank"]): r["symbol"] for r in C.resolve_futures_range(cells, days, specs).collect()}
    for d in (MON, TUE):
        single = {(d, r["rank"]): r["symbol"] for r in C.resolve_futures(cells, d, specs).collect()}
        assert single == {k: v for k, v in rng.items() if k[0] == d}


def test_split_validation_and_feed_presence(spark):
    import pytest
    from pyspark.sql import functions as F
    from marketbars.plans.collect import ValidationError, check_options_split
    from marketbars.operators.routing import exchange_dim, route_exchange
    from marketbars.sources.catalog import feed_catalog, present_feeds
    t = build_run(spark, start="2026-08-24", end="2026-08-25", **inputs(spark))
    routed = route_exchange(t["options"], exchange_dim(spark))
    assert check_options_split(routed).count() == 3
    with pytest.raises(ValidationError):
        check_options_split(routed.withColumn("High", F.lit(0.0)))
    with pytest.raises(ValidationError):
        check_options_split(routed.where("false"))
    produced = spark.createDataFrame([("options_nse.parquet",), ("futures.parquet",)], "file_name string")
    got = {r["file_name"]: r["present"] for r in present_feeds(feed_catalog(spark), produced).collect()}
    assert got["options_nse.parquet"] and not got["options_bse.parquet"] and len(got) == 6


def test_sync_date_isolates_failures(spark):
    from marketbars.plans.ingest import sync_date
    from marketbars.schemas import DEDUP_KEYS
    base = tempfile.mkdtemp(prefix="mb-sync-")
    t = build_run(spark, start="2026-08-24", end="2026-08-25", **inputs(spark))
    feeds = [
        dict(incoming=t["futures"], history_path=os.path.join(base, "fut"),
             ledger_path=os.path.join(base, "fut.led"), target="INDEX_FUTURES_2026", keys=DEDUP_KEYS["futures"]),
        dict(incoming=t["options"].withColumn("Volume", F.expr("1 div (Volume - Volume)")),
             history_path=os.path.join(base, "bad"), ledger_path=os.path.join(base, "bad.led"),
             target="BROKEN", keys=DEDUP_KEYS["options"]),
        dict(incoming=t["options"].withColumn("Date", F.lit("x")), history_path=os.path.join(base, "und"),
             ledger_path=os.path.join(base, "und.led"), target="UNDATED", keys=DEDUP_KEYS["options"]),
    ]
    rows = {(r["target"], r["status"]): r for r in sync_date(spark, feeds).collect()}
    made = rows[("INDEX_FUTURES_2026", "created")]
    assert (made["rows_before"], made["rows_after"], made["rows_added"], made["archived"]) == (0, 1, 1, False)
    assert "DIVIDE_BY_ZERO" in rows[("BROKEN", "error")]["message"]
    assert rows[("UNDATED", "undated")]["date"] is None
    assert spark.read.parquet(os.path.join(base, "und_quarantine")).count() == 5


def _brute_force_range(master, specs, days):
    """Per date, exactly as the single-date resolver: earliest expiry >= d per
    symbol, sorted by (expiry, symbol), three nearest."""
    out = set()
    for d in days:
        for und, (root, exch) in specs.items():
            best = {}
            for sym, r, e, exp in master:
                if r == root and e == exch and exp >= d and (sym not in best or exp < best[sym]):
                    best[sym] = exp
            ordered = sorted(best.items(), key=lambda kv: (kv[1], kv[0]))[:3]
            out |= {(und, d, sym, exp, i + 1) for i, (sym, exp) in enumerate(ordered)}
    return out


def test_range_resolution_matches_brute_force_on_messy_masters(spark):
    """Symbols listed with several expiries, interleaved (A B A B ...) so that
    the third distinct symbol lies far back, expiry ties across symbols."""
    import random
    rnd = random.Random(7)
    base = dt.date(2029, 6, 1)
    specs = {"IX": ("IX", "NSE"), "JY": ("JY", "NSE")}
    spec_df = spark.createDataFrame([(u, r, e, "FO") for u, (r, e) in specs.items()],
                                    "underlying string, root string, exchange string, segment string")
    for trial in range(3):
        master, rows = [], []
        for root in ("IX", "JY"):
            months = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN"][: rnd.randint(2, 6)]
            for mon in months:
                sym = f"NSE:{root}29{mon}FUT"
                for _ in range(rnd.randint(1, 4)):
                    exp = base + dt.timedelta(days=rnd.randint(-5, 45))
                    master.append((sym, root, "NSE", exp))
        # a long two-symbol alternation for IX
        for k in range(8):
            for mon in ("JUL", "AUG"):
                exp = base + dt.timedelta(days=3 * k + (1 if mon == "AUG" else 0))
                master.append((f"NSE:IX29{mon}FUT", "IX", "NSE", exp))
        for sym, _, exch, exp in master:
            secs = (exp - dt.date(1970, 1, 1)).days * 86400 + 36000
            rows.append(([str(9 * 10**15 + len(rows)), str(secs), sym],))
        cells = spark.createDataFrame(rows, "cells array<string>")
        days = [base + dt.timedelta(days=i) for i in range(0, 40) if (base + dt.timedelta(days=i)).weekday() < 5]
        day_df = spark.createDataFrame([(d,) for d in days], "trading_date date")
        got = {(r["underlying"], r["trading_date"], r["symbol"], r["expiry"], r["rank"])
               for r in C.resolve_futures_range(cells, day_df, spec_df).collect()}
        assert got == _brute_force_range(master, specs, days), trial


def test_a_range_that_ends_before_it_starts_is_an_error(spark):
    import pytest
    from marketbars.plans.collect import trading_dates
    with pytest.raises(ValueError):
        trading_dates(spark, "2026-08-25", "2026-08-24")
    assert [str(r[0]) for r in trading_dates(spark, "2026-08-24", "2026-08-24").collect()] == ["2026-08-24"]
