import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from marketbars.schemas import SPOT_SCHEMA
from marketbars.sinks.writers import verified_write, write_csv
from marketbars.sources.readers import read_bars, read_symbol_master, valid_table


def test_symbol_master_ragged_quoted(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="mb-master-"), "master.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('101,"NIFTY, 26 AUG",1787652600,NSE:NIFTY26AUGFUT\n')
        fh.write('\n')
        fh.write('102,"say ""hi""",x\n')
        fh.write(",".join(str(i) for i in range(70)) + ",NSE:NIFTY26SEPFUT\n")   # wider than any fixed schema
    cells = [r["cells"] for r in read_symbol_master(spark, path).collect()]
    assert cells[0] == ["101", "NIFTY, 26 AUG", "1787652600", "NSE:NIFTY26AUGFUT"]
    assert cells[1] == ["102", 'say "hi"', "x"]
    assert len(cells) == 3 and cells[2][-1] == "NSE:NIFTY26SEPFUT" and len(cells[2]) == 71


def test_csv_spot_roundtrip_and_verified_parquet(spark):
    base = tempfile.mkdtemp(prefix="mb-io-")
    rows = [("NIFTY", dt.datetime(2026, 8, 25, 9, 15), 1.0, 2.0, 0.5, 1.5, 10)]
    df = spark.createDataFrame(rows, SPOT_SCHEMA)
    write_csv(df, os.path.join(base, "spot"))
    back = read_bars(spark, os.path.join(base, "spot"), "spot", fmt="csv")
    assert [tuple(r) for r in back.collect()] == rows
    n = verified_write(spark, df.withColumn("trade_date", F.to_date("timestamp")),
                       os.path.join(base, "pq"), partition_by=["trade_date"])
    assert n == 1
    pq = spark.read.parquet(os.path.join(base, "pq"))
    assert valid_table(pq.drop("trade_date"), [f.name for f in SPOT_SCHEMA.fields])
    assert not valid_table(pq, [f.name for f in SPOT_SCHEMA.fields])


def test_partitioned_write_rebalances_and_keeps_order(spark):
    from marketbars.sinks.writers import _layout, write_parquet
    # one hot day holding most rows, plus two small days
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, F.lit("2026-08-25")).when(F.col("id") < 2800, F.lit("2026-08-26"))
         .otherwise(F.lit("2026-08-27")).alias("trade_date"),
        (F.col("id") * 7919 % 3001).alias("k"))
    plan = _layout(df, ["trade_date"], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    out = os.path.join(tempfile.mkdtemp(prefix="mb-layout-"), "t")
    write_parquet(df, out, ["trade_date"], sort_within=["k"])
    files = spark.read.parquet(out).select(F.input_file_name().alias("f"), "k")
    for (f,) in files.select("f").distinct().collect():
        ks = [r["k"] for r in spark.read.parquet(f).collect()]
        assert ks == sorted(ks)          # the writer kept the requested order
    assert spark.read.parquet(out).count() == 3000


def test_scale_conf_sizes_shuffles_from_the_input():
    from marketbars.session import scale_conf
    assert scale_conf(10**6, 8)["spark.sql.shuffle.partitions"] == "16"          # two per core at least
    assert scale_conf(64 * 2**30, 8)["spark.sql.shuffle.partitions"] == "512"    # ~128 MB each
    assert scale_conf(100 * 2**40, 8000)["spark.sql.shuffle.partitions"] == "100000"
    assert scale_conf(100 * 2**40, 8000, 500_000)["spark.sql.shuffle.partitions"] == "500000"
