"""Scale properties read from physical plans: partial top-1 before the
shuffle, partition pruning of history, broadcast only of fixed dimensions,
and no nested-loop or cartesian join in any registered query."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from marketbars.operators.merge import keep_first, merge_first_wins


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_limits_each_key_before_the_shuffle(spark):
    # one hot key holding most rows
    df = spark.range(5000).select((F.when(F.col("id") < 4000, F.lit(0)).otherwise(F.col("id"))).alias("k"),
                                  F.col("id").alias("v"))
    plan = _plan(keep_first(df, ["k"], ["v"]))
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and plan.index("Exchange hashpartitioning") < partial
    got = keep_first(df, ["k"], ["v"]).where("k = 0").collect()
    assert [r["v"] for r in got] == [0]


def test_merge_reads_only_the_incoming_dates_of_history(spark):
    base = tempfile.mkdtemp(prefix="mb-prune-")
    days = [dt.date(2026, 8, d) for d in (24, 25, 26, 27, 28)]
    hist = spark.createDataFrame([(i, 1.0, d) for i, d in enumerate(days)], "k bigint, v double, trade_date date")
    hist.write.partitionBy("trade_date").parquet(os.path.join(base, "h"))
    h = spark.read.parquet(os.path.join(base, "h"))
    inc = spark.createDataFrame([(2, 5.0, days[2]), (9, 5.0, days[2])], "k bigint, v double, trade_date date")
    merged = merge_first_wins(h, inc, ["k", "trade_date"], date_of=F.col("trade_date"))
    plan = _plan(merged)
    # the shuffled branch scans only the incoming day's partition; the other
    # branch passes the remaining partitions through without an exchange
    assert "PartitionFilters: [coalesce((trade_date" in plan and "= 2026-08-26), false)]" in plan
    assert "PartitionFilters: [NOT coalesce((trade_date" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    got = sorted((r["k"], r["v"]) for r in merged.collect())
    assert got == [(0, 1.0), (1, 1.0), (2, 1.0), (3, 1.0), (4, 1.0), (9, 5.0)]


def test_no_cartesian_or_nested_loop_join_in_registered_queries(spark):
    import __spark_entry__ as E
    # these write while being built
    skip = {"stream_ingest", "sink_roundtrip", "stream_split_days", "ingest_first_arrival",
            "written_outputs"}
    for name, fn in E.queries().items():
        if name in skip or name in E.LLM_QUERIES:
            continue
        plan = _plan(fn(spark, E.SMOKE_DIR))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_no_broadcast_hints():
    """No side is broadcast by hint: all are left to the optimizer's size checks."""
    import pathlib
    import re
    root = pathlib.Path(__file__).resolve().parent.parent / "marketbars"
    found = set()
    for path in root.rglob("*.py"):
        if path.parent.name == "llm":       # an optional part with tests of its own
            continue
        for m in re.finditer(r"F\.broadcast\((\w+)", path.read_text()):
            found.add((path.name, m.group(1)))
    assert not found


def test_bars_are_exploded_after_the_join(spark):
    """A response is shuffled as one row, not as its bars."""
    from marketbars.operators import bars as B
    from marketbars.schemas import BAR_PAYLOAD_SCHEMA
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        p = spark.createDataFrame([("A", dt.date(2026, 8, 24), "ok", "", [["1", "1", "1", "1", "1", "1", "1"]])],
                                  BAR_PAYLOAD_SCHEMA)
        c = spark.createDataFrame([("A", dt.date(2026, 8, 24), "NIFTY", None, 100, "CE")],
                                  "Ticker string, trading_date date, Underlying string, Expiry date, Strike int, "
                                  "OptionType string")
        plan = _plan(B.options_bars(p, c))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the plan is printed top down: the generator stands above every exchange
    assert plan.index("Generate") < plan.index("Exchange") and "Join" in plan


def test_merge_pushes_the_date_range_to_a_flat_history(spark):
    base = tempfile.mkdtemp(prefix="mb-range-")
    rows = [(i, dt.datetime(2026, 8, 1 + i % 20, 9, 15), 1.0) for i in range(100)]
    spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, v double").write.parquet(os.path.join(base, "h"))
    h = spark.read.parquet(os.path.join(base, "h"))
    inc = spark.createDataFrame([(1000, dt.datetime(2026, 8, 5, 9, 16), 2.0)],
                                "k bigint, ts timestamp_ntz, v double")
    merged = merge_first_wins(h, inc, ["k", "ts"], date_of=F.to_date("ts"), raw_date_col="ts")
    plan = merged._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2026-08-05T00:00)" in plan and "LessThan(ts,2026-08-06T00:00)" in plan
    assert merged.count() == 101
