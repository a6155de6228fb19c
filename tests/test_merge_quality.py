import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from marketbars.operators.merge import keep_first, merge_first_wins, merge_stats, resolve_keys
from marketbars.operators.quality import duplicate_count, quality_report, validate
from marketbars.schemas import OPTIONS_SCHEMA

D1, D2 = dt.date(2026, 8, 24), dt.date(2026, 8, 25)
SCHEMA = "Ticker string, Date date, Time string, Close double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_resolve_keys():
    assert resolve_keys(["Ticker", "Date"], ["Ticker", "x"]) == ["Ticker"]
    assert resolve_keys(["k"], ["a", "b"]) == ["a", "b"]


def test_existing_rows_win_and_stats(spark):
    hist = spark.createDataFrame([("A", D1, "09:15:00", 1.0), ("A", D2, "09:15:00", 2.0)], SCHEMA)
    new = spark.createDataFrame([("A", D2, "09:15:00", 99.0), ("A", D2, "09:16:00", 3.0)], SCHEMA)
    keys = ["Ticker", "Date", "Time"]
    for date_of in (None, F.col("Date")):
        for strategy in ("window", "aggregate"):
            m = merge_first_wins(hist, new, keys, date_of=date_of, strategy=strategy)
            assert rows(m) == [("A", D1, "09:15:00", 1.0), ("A", D2, "09:15:00", 2.0), ("A", D2, "09:16:00", 3.0)]
    s = merge_stats(hist, new, merge_first_wins(hist, new, keys)).first()
    assert (s["before"], s["new_rows"], s["after"], s["added"], s["within_bound"]) == (2, 2, 3, 1, True)


def test_missing_columns_null_filled(spark):
    hist = spark.createDataFrame([("A", D1, "09:15:00", 1.0)], SCHEMA)
    new = spark.createDataFrame([("B", D1, "09:15:00")], "Ticker string, Date date, Time string")
    m = merge_first_wins(hist, new, ["Ticker", "Date", "Time"])
    assert m.columns == ["Ticker", "Date", "Time", "Close"]
    assert rows(m) == [("A", D1, "09:15:00", 1.0), ("B", D1, "09:15:00", None)]


def test_whole_row_key_when_no_key_column(spark):
    hist = spark.createDataFrame([("x", 1), ("x", 1), ("y", 2)], "a string, b int")
    new = spark.createDataFrame([("x", 1), ("z", 3)], "a string, b int")
    assert rows(merge_first_wins(hist, new, ["Ticker"])) == [("x", 1), ("y", 2), ("z", 3)]


def test_keep_first_by_explicit_order_and_null_keys(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), ("k", 5, "c")], "k string, pos int, v string")
    assert rows(keep_first(df, ["k"], ["pos"])) == sorted([(None, 1, "a"), ("k", 5, "c")], key=repr)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=12),
       st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=12))
def test_merge_properties(spark, h, d):
    schema = "t string, m int, v int"
    hist = keep_first(spark.createDataFrame(h, schema), ["t", "m"])     # compact history
    day = spark.createDataFrame(d, schema)
    once = merge_first_wins(hist, day, ["t", "m"])
    twice = merge_first_wins(once, day, ["t", "m"])
    assert rows(once) == rows(twice)                                        # idempotent
    assert set(map(tuple, hist.collect())) <= set(rows(once))              # history never changes
    assert once.count() <= hist.count() + day.count()
    local = merge_first_wins(hist, day, ["t", "m"], date_of=F.col("m"))    # partition-local form
    assert rows(local) == rows(once)


def _bars(spark, data):
    return spark.createDataFrame(data, OPTIONS_SCHEMA)


def _row(t="A", time="09:15:00", o=10.0, h=12.0, lo=9.0, c=11.0, ot="CE", strike=100):
    return (t, D1, time, o, h, lo, c, 5, 7, "NIFTY", D2, strike, ot)


def test_quality_report_messages(spark):
    df = _bars(spark, [_row(), _row(time="09:15:00"), _row(time="09:16:00", h=8.0),
                       _row(time="09:17:00", ot="XX"), _row(time="09:18:00", ot="ZZ"),
                       _row(time="09:19:00", ot=None, o=None), _row(time="09:20:00", strike=0),
                       _row(time="09:21:00", o=float("nan"))])
    ok, errors = validate(df)
    assert not ok
    assert errors == ["Missing values in Open.", "Missing values in OptionType.",
                      "Invalid OptionType: {'XX', 'ZZ'}", "Duplicate rows: 1", "Invalid OHLC rows: 1",
                      "Non-positive strike price."]
    assert validate(_bars(spark, [_row()])) == (True, [])
    assert validate(_bars(spark, [])) == (False, ["DataFrame is empty."])
    extra = _bars(spark, [_row()]).withColumn("x", F.lit(1))
    assert validate(extra)[1] == ["Unexpected column structure."]


def test_quality_grouped(spark):
    df = _bars(spark, [_row(), _row(t="B", h=1.0)]).withColumn("g", F.col("Ticker"))
    r = {x["g"]: x["ok"] for x in quality_report(df, group_by=["g"]).collect()}
    assert r == {"A": True, "B": False}


def test_duplicate_count_null_keys_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (None, None)], "a int, b int")
    r = duplicate_count(df, ["a", "b"]).first()
    assert (r["rows"], r["distinct_keys"], r["duplicate_rows"]) == (4, 3, 1)


def test_invalid_types_are_rows_and_a_short_list(spark):
    from marketbars.operators.quality import LISTED, invalid_type_counts, quality_report, with_invalid_types
    bad = sorted(f"T{i}" for i in range(250))
    rows = [(d, t) for d in ("a", "b", None) for t in (*bad[:250 if d == "a" else 90], "CE", None)]
    df = spark.createDataFrame(rows + rows[:40], "grp string, OptionType string").repartition(5)
    want = {"a": bad, "b": bad[:90], None: bad[:90]}
    counted = {(r.grp, r.OptionType): r.rows for r in invalid_type_counts(df, ["grp"]).collect()}
    assert counted == {(g, t): 1 + (g == "a" and t in bad[:40]) for g, some in want.items() for t in some}
    groups = df.groupBy("grp").count()
    got = {r.grp: (r.invalid_types, r.invalid_values) for r in with_invalid_types(groups, df, ["grp"]).collect()}
    assert got == {g: (some[:LISTED], len(some)) for g, some in want.items()}
    report = quality_report(df, expected_columns=["OptionType"], keys=[], group_by=["grp"])
    for r in report.collect():
        listed = ", ".join(f"'{t}'" for t in want[r.grp][:LISTED])
        more = " and 150 more" if r.grp == "a" else ""
        assert f"Invalid OptionType: {{{listed}}}{more}" in r.errors
    whole = quality_report(df.drop("grp"), expected_columns=["OptionType"], keys=[]).first()
    assert whole.invalid_types == bad[:LISTED] and whole.invalid_values == 250 and not whole.ok
    empty = quality_report(df.drop("grp").limit(0), expected_columns=["OptionType"], keys=[]).first()
    assert empty.invalid_types == [] and empty.rows == 0


def test_invalid_types_has_every_day_and_all_values(spark, tmp_path):
    import datetime as dt
    from marketbars.queries.q_reports import ALLOWED_TYPES, q_invalid_types
    bad = sorted(f"T{i}" for i in range(250))
    clean, dirty = dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 2, 9)
    rows = [(clean, ALLOWED_TYPES[0]), (clean, None), (None, "X"), (dirty, ALLOWED_TYPES[0])]
    rows += [(dirty, b) for b in bad] * 2
    spark.createDataFrame(rows, "ts timestamp_ntz, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.date: (r.invalid_types, r.invalid_rows) for r in q_invalid_types(spark, str(tmp_path)).collect()}
    assert got == {clean.date(): ("", 0), dirty.date(): (",".join(bad), 500), None: ("X", 1)}
