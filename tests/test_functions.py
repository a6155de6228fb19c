import datetime as dt

from pyspark.sql import functions as F

from marketbars.functions.epochs import expiry_epoch_to_date, plausible_expiry_epoch
from marketbars.functions.symbols import continuous_ticker, first_match, fut_symbol_parts, month_expiry
from marketbars.functions.timefmt import (
    bar_date, bar_time, epoch_to_market_time, ntz_epoch_seconds, parse_dmy,
)
from marketbars.functions.coerce import strike_to_int, to_double


def one(spark, expr, value, schema):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_epoch_to_market_time_independent_of_session_zone(spark):
    e = 1787652600  # 2026-08-25 10:10 UTC
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        r = spark.createDataFrame([(e,)], "e bigint").select(
            bar_date(epoch_to_market_time(F.col("e"))).alias("d"),
            bar_time(epoch_to_market_time(F.col("e"))).alias("t")).first()
        assert (r["d"], r["t"]) == (dt.date(2026, 8, 25), "15:40:00")
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ntz_epoch_seconds_floors_in_any_session_zone(spark):
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        r = one(spark, ntz_epoch_seconds(F.col("ts")), dt.datetime(2024, 1, 1, 0, 0, 1, 500000), "ts timestamp_ntz")
        assert r == 1704067201
        r = one(spark, ntz_epoch_seconds(F.col("ts")), dt.datetime(1969, 12, 31, 23, 59, 59, 500000),
                "ts timestamp_ntz")
        assert r == -1
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_dmy_accepts_unpadded_rejects_invalid(spark):
    df = spark.createDataFrame([("5-8-2026",), ("05-08-2026",), ("32-08-2026",), ("",), (None,)], "s string")
    got = [r["d"] for r in df.select(parse_dmy(F.col("s")).alias("d")).collect()]
    assert got == [dt.date(2026, 8, 5), dt.date(2026, 8, 5), None, None, None]


def test_expiry_epoch_cases(spark):
    cases = [
        ("1787652600", 1787652600),          # seconds
        ("1787652600123", 1787652600),       # milliseconds -> seconds
        ("9000000000000000", None),          # huge internal id
        (" 1787652600 ", 1787652600),        # whitespace stripped
        ("17876526x0", None), ("", None), (None, None),
        ("999999999", None),                 # below the plausible range
        ("2051222400", 2051222400),          # upper bound inclusive
        ("2051222401", None),
        ("2051222400999", 2051222400),       # ms at the upper bound
        ("2051222401000", None),
    ]
    df = spark.createDataFrame(cases, "c string, want bigint")
    for r in df.select("want", plausible_expiry_epoch(F.col("c")).alias("got")).collect():
        assert r["got"] == r["want"]
    d = one(spark, expiry_epoch_to_date(F.col("c")), "1787652600", "c string")
    assert d == dt.date(2026, 8, 25)


def test_symbol_parse_and_month(spark):
    df = spark.createDataFrame([("NSE:NIFTY26JANFUT",), ("BSE:SENSEX26SEPFUT",), ("NSE:NIFTY26XYZFUT",),
                                ("nse:nifty26janfut",), ("NSE:NIFTY 26JANFUT",)], "s string")
    p = df.select(fut_symbol_parts(F.col("s")).alias("p")).select("p.*")
    rows = [tuple(r) for r in p.collect()]
    assert rows[0] == ("NSE", "NIFTY", "26", "JAN")
    assert rows[1] == ("BSE", "SENSEX", "26", "SEP")
    assert rows[3] == (None, None, None, None) and rows[4] == (None, None, None, None)
    m = p.select(month_expiry(F.col("yy"), F.col("mon")).alias("m")).collect()
    assert m[0]["m"] == dt.date(2026, 1, 1) and m[2]["m"] is None


def test_first_match_only_first(spark):
    df = spark.createDataFrame([(["x", " NSE:NIFTY26JANFUT ", "NSE:NIFTY26FEBFUT"],), (["a", "b"],)],
                               "cells array<string>")
    r = df.select(first_match(F.col("cells")).alias("m")).collect()
    assert (r[0]["m"]["symbol"], r[0]["m"]["pos"]) == ("NSE:NIFTY26JANFUT", 2)
    assert (r[1]["m"]["symbol"], r[1]["m"]["pos"]) == (None, 0)


def test_continuous_ticker(spark):
    assert one(spark, continuous_ticker(F.col("r"), F.lit("II")), "SENSEX", "r string") == "SENSEX-II.NFO"


def test_strike_and_double_coercion(spark):
    df = spark.createDataFrame([(100.9,), (-1.0,), (None,), (float("nan"),), (0.0,)], "x double")
    got = [r["s"] for r in df.select(strike_to_int(F.col("x")).alias("s")).collect()]
    assert got == [100, None, None, None, 0]
    df = spark.createDataFrame([("1.5",), ("abc",), ("NaN",)], "x string")
    assert [r["d"] for r in df.select(to_double(F.col("x")).alias("d")).collect()] == [1.5, None, None]
