import datetime as dt

from pyspark.sql import functions as F

from marketbars.operators import bars as B
from marketbars.operators import contracts as C
from marketbars.operators import ledger as L
from marketbars.operators.calendar import classify_days, holidays
from marketbars.operators.report import date_status, file_summary, outcome_counts, run_summary
from marketbars.schemas import BAR_PAYLOAD_SCHEMA, CHAIN_PAYLOAD_SCHEMA

D = dt.date(2026, 8, 25)
E = "1787652600.0"   # 2026-08-25 15:40 IST


def test_response_outcomes(spark):
    bar7 = [E, "1.0", "2.0", "0.5", "1.5", "10.0", "5.0"]
    data = [
        ("a", D, "ok", "", [bar7]),                       # ok
        ("b", D, "ok", "", []),                           # ok but empty -> no_data
        ("c", D, "ok", "", [bar7, bar7[:6]]),             # short bar -> failed
        ("d", D, "no_data", "", None),                    # no_data
        ("e", D, "error", "No Data found", None),         # message -> no_data
        ("f", D, "error", "no candles", None),            # message -> no_data
        ("g", D, "error", "timeout", None),               # failed
        ("h", D, None, None, None),                       # failed
        ("i", D, "ok", "no data", [bar7]),                # ok wins over message
    ]
    p = spark.createDataFrame(data, BAR_PAYLOAD_SCHEMA)
    got = {r["symbol"]: (r["outcome"], r["rows"]) for r in B.payload_outcomes(p, "options", 7).collect()}
    assert got == {"a": ("ok", 1), "b": ("no_data", 0), "c": ("failed", 0), "d": ("no_data", 0),
                   "e": ("no_data", 0), "f": ("no_data", 0), "g": ("failed", 0), "h": ("failed", 0),
                   "i": ("ok", 1)}
    counts = outcome_counts(B.payload_outcomes(p, "options", 7)).first()
    assert (counts["contracts"], counts["successful"], counts["no_data"], counts["failed"], counts["rows"]) == \
        (9, 2, 4, 3, 2)
    assert run_summary(outcome_counts(B.payload_outcomes(p, "options", 7))).first()["rows"] == 2
    st = date_status(outcome_counts(B.payload_outcomes(p, "options", 7))).first()["status"]
    assert st == "downloaded"


def test_options_bars_projection(spark):
    p = spark.createDataFrame([("NSE:X", D, "ok", "", [[E, "1.0", "2.0", "0.5", "1.5", "10.0", "5.0"]])], BAR_PAYLOAD_SCHEMA)
    c = spark.createDataFrame([("NSE:X", "NIFTY", D, 100, "CE")],
                              "Ticker string, Underlying string, Expiry date, Strike int, OptionType string")
    r = B.options_bars(p, c).first()
    assert tuple(r) == ("NSE:X", D, "15:40:00", 1.0, 2.0, 0.5, 1.5, 10, 5, "NIFTY", D, 100, "CE")


def test_expiry_window_boundaries(spark):
    listing = spark.createDataFrame([(
        "NIFTY", D, None, "ok", "",
        ({"expiryData": [
            {"date": "25-08-2026", "expiry": "e0"},     # day 0
            {"date": "29-9-2026", "expiry": "e35"},     # day 35, unpadded
            {"date": "30-09-2026", "expiry": "e36"},    # day 36
            {"date": "24-08-2026", "expiry": "e-1"},    # day -1
            {"date": "bad", "expiry": "x"},
            {"date": "27-08-2026", "expiry": ""},       # blank epoch
            {"date": "27-08-2026", "expiry": "first"},
            {"date": "27-08-2026", "expiry": "last"},   # same date listed twice: last wins
        ], "optionsChain": None}))], CHAIN_PAYLOAD_SCHEMA)
    t = C.expiry_targets(C.expiry_items(listing))
    got = sorted((r["expiry"].isoformat(), r["epoch"]) for r in t.collect())
    assert got == [("2026-08-25", "e0"), ("2026-08-27", "last"), ("2026-09-29", "e35")]


def test_option_contracts_filters_and_last_wins(spark):
    def chain(epoch, status, options):
        return ("NIFTY", D, epoch, status, "", {"expiryData": None, "optionsChain": options})
    o = lambda s, t, k: {"symbol": s, "option_type": t, "strike_price": None if k is None else str(k)}
    data = [
        chain("e1", "ok", [o("NSE:NIFTY1CE", "CE", 100.0), o("NSE:NIFTY2PE", "PE", 100.7),
                           o("NSE:BANKNIFTY1CE", "CE", 100.0), o("", "CE", 1.0), o("NSE:NIFTY3XX", "XX", 1.0),
                           o("NSE:NIFTY4CE", "CE", -1.0), o("NSE:NIFTY5CE", "CE", None), o("nifty6ce", "CE", 5.0)]),
        chain("e2", "ok", [o("NSE:NIFTY1CE", "CE", 200.0)]),
        chain("e3", "error", [o("NSE:NIFTY9CE", "CE", 1.0)]),
    ]
    items = C.chain_items(spark.createDataFrame(data, CHAIN_PAYLOAD_SCHEMA))
    targets = spark.createDataFrame([("NIFTY", D, dt.date(2026, 8, 27), "e1"), ("NIFTY", D, dt.date(2026, 9, 3), "e2"),
                                     ("NIFTY", D, dt.date(2026, 9, 10), "e3")],
                                    "underlying string, trading_date date, expiry date, epoch string")
    rows = C.chain_rows(C.tag_requested_expiry(items, targets), C.prefix_dim(spark))
    got = {r["Ticker"]: (r["Expiry"].isoformat(), r["Strike"]) for r in C.option_contracts(rows).collect()}
    assert got == {"NSE:NIFTY1CE": ("2026-09-03", 200), "NSE:NIFTY2PE": ("2026-08-27", 100),
                   "nifty6ce": ("2026-08-27", 5)}
    stats = {r["expiry"].isoformat(): (r["usable"], r["raw"]) for r in C.expiry_stats(rows).collect()}
    assert stats == {"2026-08-27": (3, 8), "2026-09-03": (1, 1)}
    assert C.failed_requests(items).count() == 1


def test_futures_resolution(spark):
    ms = lambda d: str(int(dt.datetime(d.year, d.month, d.day, 10, 0).timestamp()))
    rows = [
        ["999999999999999999", "x", ms(dt.date(2026, 8, 27)), "NSE:NIFTY26AUGFUT"],
        ["1", ms(dt.date(2026, 9, 24)), "junk", "NSE:NIFTY26SEPFUT"],     # epoch elsewhere
        ["NSE:NIFTY26OCTFUT"],                                            # symbol month only
        ["NSE:NIFTY26NOVFUT", "2"],                                       # later month
        [ms(dt.date(2026, 7, 30)), "NSE:NIFTY26JULFUT"],                  # expired
        [ms(dt.date(2026, 8, 27)), "NSE:BANKNIFTY26AUGFUT"],              # other root
        [ms(dt.date(2026, 8, 27)), "BSE:NIFTY26AUGFUT"],                  # other exchange
        ["NSE:NIFTY26XYZFUT"],                                            # unknown month: dropped
    ]
    cells = spark.createDataFrame([(r,) for r in rows], "cells array<string>")
    specs = C.futures_spec_dim(spark).where(F.col("underlying") == "NIFTY")
    got = [(r["symbol"], r["ticker"], r["contract_series"], r["expiry"].isoformat())
           for r in C.resolve_futures(cells, "2026-08-25", specs).orderBy("rank").collect()]
    assert got == [("NSE:NIFTY26AUGFUT", "NIFTY-I.NFO", "I", "2026-08-27"),
                   ("NSE:NIFTY26SEPFUT", "NIFTY-II.NFO", "II", "2026-09-24"),
                   ("NSE:NIFTY26OCTFUT", "NIFTY-III.NFO", "III", "2026-10-01")]


def test_weekend_before_holiday(spark):
    dates = spark.createDataFrame([(dt.date(2026, 3, 14),), (dt.date(2026, 1, 26),), (dt.date(2026, 1, 27),)], "date date")
    got = {r["date"].isoformat(): (r["status"], r["holiday_name"])
           for r in classify_days(dates, holidays(spark)).collect()}
    assert got == {"2026-03-14": ("weekend", "Holi"), "2026-01-26": ("holiday", "Republic Day"),
                   "2026-01-27": ("trading", None)}


def test_ledger_parse_and_dump(spark):
    led = spark.createDataFrame([("t", '["2026-08-25", "2026-08-24", "2026-08-25"]'), ("t", "not json"),
                                 ("u", '{"a": 1}'), ("v", None), ("w", "[]")], "target string, dates_json string")
    dates = L.parse_ledger(led)
    assert sorted(tuple(r) for r in dates.collect()) == [("t", "2026-08-24"), ("t", "2026-08-25")]
    assert L.dump_ledger(dates).first()["dates_json"] == '["2026-08-24", "2026-08-25"]'


def test_reconcile_every_branch(spark):
    inc = spark.createDataFrame([("T", "d1", 5), ("T", "d3", 5), ("T", "d4", 5), ("T", "d5", 5), ("N", "d5", 3)],
                                "target string, date string, incoming_rows bigint")
    hist = spark.createDataFrame([("T", "d2", 4), ("T", "d3", 9), ("T", "d4", 5)],
                                 "target string, date string, history_rows bigint")
    led = spark.createDataFrame([("T", "d1")], "target string, date string")

    def run(**kw):
        return {(r["target"], r["date"]): r["status"] for r in L.reconcile(inc, hist, led, **kw).collect()}
    assert run() == {("T", "d1"): "already_ingested", ("T", "d2"): "empty_source", ("T", "d3"): "mismatch",
                     ("T", "d4"): "sidecar_repair_needed", ("T", "d5"): "updated", ("N", "d5"): "created"}
    assert run(repair=True)[("T", "d4")] == "sidecar_repaired"
    assert run(repair=True, dry_run=True)[("T", "d4")] == "sidecar_repair_needed"
    assert run(dry_run=True)[("T", "d5")] == "dry_run"
    ro = run(repair_only=True)
    assert (ro[("T", "d5")], ro[("N", "d5")]) == ("not_present", "missing_target")


def test_file_summary_caption(spark):
    df = spark.createDataFrame([("A", "NIFTY")] * 1200 + [("B", "SENSEX")], "Ticker string, Underlying string")
    assert file_summary(df).first()["summary"] == "1,201 rows | indexes: NIFTY, SENSEX | 2 contracts"
