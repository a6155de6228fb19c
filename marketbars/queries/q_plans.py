"""Composed jobs on the benchmark tables: streams whose days come in several
batches, arrival order in the ingest, routing to targets, work still to be done, and
the readers of nested chains, master text and CSV bars. Those that write do so under
the shared checkpoint folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketbars.operators import bars as B
from marketbars.operators import contracts as C
from marketbars.operators.report import pending_kinds
from marketbars.plans.collect import write_outputs
from marketbars.plans.feeds import routed
from marketbars.plans.ingest import ingest
from marketbars.queries import query, table
from marketbars.queries.q_contracts import (
    CHAIN_DATE, CHAIN_SQL, LISTING_DATE, MASTER_SQL, chain_parts, listing_items, master_rows,
)
from marketbars.queries.q_payloads import (
    TYPE_BARS, USER_BARS, option_payloads, spot_index, spot_payloads,
)
from marketbars.schemas import CHAIN_PAYLOAD_SCHEMA
from marketbars.session import scratch_path, written_once
from marketbars.sinks.writers import PART_COL, verified_write, write_csv
from marketbars.sources.readers import read_bars, read_symbol_master
from marketbars.streaming.ingest_stream import stream_ingest


# ------------------------------------------------------------------ ingest

BATCHES = 4         # micro-batches


@query("stream_split_days", """
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN event_id % 17 = 0 THEN 'quarantine' ELSE 'history' END AS stored
FROM events
""")
def q_stream_split_days(spark, sf):
    """Every day is spread over all landed files, a quarter of them to a micro-batch, so all
    days come in parts; rows without a date go to quarantine. No row is lost."""
    ev = table(spark, sf, "events")
    landing, history = scratch_path(spark, "landing"), scratch_path(spark, "history")
    ledger, quarantine = scratch_path(spark, "ledger"), scratch_path(spark, "quarantine")
    files = max(BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))     # sized from the input
    ev.repartition(files).write.parquet(landing)
    dated = F.when(F.col("event_id") % 17 != 0, F.to_date("ts"))
    stream_ingest(spark, landing, ev.schema, history, ledger, scratch_path(spark, "stream-ckpt"),
                  "events", ["event_id"], max_files_per_trigger=-(-files // BATCHES), date_of=dated,
                  quarantine_path=quarantine)
    return (spark.read.parquet(history).select(*ev.columns, F.lit("history").alias("stored"))
            .union(spark.read.parquet(quarantine)
                   .select(*ev.columns, F.lit("quarantine").alias("stored"))))


@query("ingest_first_arrival", """
SELECT event_id, ts, CAST(value + 1000 AS DOUBLE) AS value, CAST(ts AS DATE) AS trade_date FROM events
""")
def q_ingest_first_arrival(spark, sf):
    """Every event arrives twice, the larger value first: the first stays."""
    ev = table(spark, sf, "events")
    twice = ev.select("event_id", "ts", F.posexplode(F.array(F.col("value") + 1000, F.col("value")))
                      .alias("arrived", "value"))
    history = scratch_path(spark, "history")
    ingest(spark, twice, history, scratch_path(spark, "ledger"), "events", ["event_id"],
           date_of=F.to_date("ts"), order_by=["arrived"])
    return spark.read.parquet(history).select("event_id", "ts", "value", PART_COL)


# ----------------------------------------------------------------- routing

@query("feed_routing", """
WITH o AS (
  SELECT *, CAST(year(o_orderdate) AS VARCHAR) AS y, (['NIFTY', 'SENSEX', 'OTHER'])[o_orderkey % 3 + 1] AS u
  FROM orders)
SELECT target, CAST(count(*) AS BIGINT) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM (
  SELECT o_orderkey, CASE u WHEN 'NIFTY' THEN 'NSE_INDEX_OPTIONS_' || y || '.parquet'
                            WHEN 'SENSEX' THEN 'BSE_INDEX_OPTIONS_' || y || '.parquet' ELSE 'unrouted' END AS target FROM o
  UNION ALL SELECT o_orderkey, 'INDEX_FUTURES_' || y || '.parquet' FROM o
  UNION ALL SELECT o_orderkey, CASE u WHEN 'NIFTY' THEN 'Nifty 50.csv' WHEN 'SENSEX' THEN 'Sensex.csv'
                               ELSE 'unrouted' END FROM o)
GROUP BY target
""")
def q_feed_routing(spark, sf):
    """Orders of seven years as option, futures and spot rows: written by target,
    read back per target. Rows that no target takes are kept apart."""
    o = table(spark, sf, "orders")
    name = F.try_element_at(F.array(*[F.lit(x) for x in ("NIFTY", "SENSEX", "OTHER")]),
                            (F.col("o_orderkey") % 3 + 1).cast("int"))
    rows = o.select("o_orderkey", name.alias("Underlying"), name.alias("Index"),
                    F.to_date("o_orderdate").alias("Date"))
    parts = [routed(spark, kind, rows).select("o_orderkey", "target")
             for kind in ("options", "futures", "spot")]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    path = scratch_path(spark, "targets")
    verified_write(spark, both.withColumn("target", F.coalesce("target", F.lit("unrouted"))), path,
                   partition_by=["target"])
    return (spark.read.parquet(path).groupBy("target")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys")))


@query("pending_by_kind", """
WITH d AS (SELECT CAST(ts AS DATE) AS trading_date, min(event_id) AS a, max(event_id) AS b, count(*) AS n
           FROM events GROUP BY 1)
SELECT trading_date, 'options' AS kind FROM d WHERE a % 3 = 0 OR b % 4 = 0
UNION ALL SELECT trading_date, 'futures' FROM d WHERE n % 2 = 1
UNION ALL SELECT trading_date, 'spot' FROM d WHERE b % 2 = 1
""")
def q_pending_by_kind(spark, sf):
    """Work left per kind: options need valid rows of both exchanges, futures any
    file of the day, spot those of all indexes."""
    ev = table(spark, sf, "events")
    d = ev.groupBy(F.to_date("ts").alias("trading_date")).agg(
        F.min("event_id").alias("a"), F.max("event_id").alias("b"), F.count(F.lit(1)).alias("n"))

    def made(kind, exchange, valid, where="true"):
        return d.where(where).select("trading_date", F.lit(kind).alias("kind"),
                                     F.lit(exchange).cast("string").alias("exchange"), valid.alias("valid"))
    produced = (made("options", "NSE", F.col("a") % 3 != 0).union(made("options", "BSE", F.lit(True), "b % 4 <> 0"))
                .union(made("options", "XXX", F.lit(True))).union(made("futures", None, F.lit(True), "n % 2 = 0"))
                .union(made("spot", "NIFTY", F.lit(True))).union(made("spot", "SENSEX", F.lit(True), "b % 2 = 0")))
    exchanges = spark.createDataFrame([("NSE",), ("BSE",)], "exchange string")
    indexes = spark.createDataFrame([("NIFTY",), ("SENSEX",)], "index string")
    return pending_kinds(d.select("trading_date"), produced, exchanges, indexes)


# ----------------------------------------------------------------- readers

CHUNK = 500         # rows of one response


def _landed_chains(payloads):
    """Chain responses as JSON text, parsed with the declared schema."""
    text = F.to_json(F.struct(*payloads.columns))
    return payloads.select(F.from_json(text, CHAIN_PAYLOAD_SCHEMA).alias("p")).select("p.*")


@query("expiry_listing", f"""
WITH items AS (
  SELECT o_orderpriority || '-' || (o_orderkey // {CHUNK}) AS underlying, DATE '{LISTING_DATE}' AS trading_date,
    o_orderkey AS pos,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL
         WHEN o_orderkey % 11 = 0 THEN '9' || strftime(o_orderdate, '%-d-%-m-%Y')
         ELSE strftime(o_orderdate, '%-d-%-m-%Y') END AS date_text,
    CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE CAST(o_orderkey * 100 AS VARCHAR) END AS epoch
  FROM orders),
p AS (SELECT *, CAST(try_strptime(date_text, '%d-%m-%Y') AS DATE) AS expiry FROM items)
SELECT underlying, trading_date, expiry, arg_max(epoch, pos) AS epoch FROM p
WHERE expiry IS NOT NULL AND expiry >= trading_date AND date_diff('day', trading_date, expiry) <= 35
  AND epoch IS NOT NULL AND epoch <> ''
GROUP BY underlying, trading_date, expiry
""")
def q_expiry_listing(spark, sf):
    """Expiry listings as landed: nested responses of up to CHUNK expiries."""
    i = listing_items(spark, sf)
    name = F.concat("underlying", F.lit("-"), F.floor(F.col("pos") / CHUNK).cast("string"))
    item = F.struct("pos", F.col("date_text").alias("date"), F.col("epoch").alias("expiry"))
    grouped = (i.groupBy(name.alias("underlying"), "trading_date")
               .agg(F.array_sort(F.collect_list(item)).alias("items")))
    listed = F.transform("items", lambda x: F.struct(x["date"].alias("date"), x["expiry"].alias("expiry")))
    landed = _landed_chains(grouped.select("underlying", "trading_date", F.lit("ok").alias("s"),
                                           F.struct(listed.alias("expiryData")).alias("data")))
    return C.expiry_targets(C.expiry_items(landed))


NESTED_SQL = (CHAIN_SQL
              .replace(f"DATE '{CHAIN_DATE}' AS trading_date",
                       f"CAST(DATE '{CHAIN_DATE}' + CAST(p_partkey // {CHUNK} AS INTEGER) AS DATE) AS trading_date")
              .replace("CASE WHEN p_partkey % 11 = 0 THEN -1.0",
                       "CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN -1.0"))


@query("chain_contracts", "WITH " + NESTED_SQL + " SELECT * FROM contracts")
def q_chain_contracts(spark, sf):
    """Option chains as landed: nested responses of up to CHUNK options, strikes as
    quoted text, some of it no number."""
    _, _, items = chain_parts(spark, sf)
    k = F.col("pos")
    day = F.date_add("trading_date", F.floor(k / CHUNK).cast("int"))
    strike = F.when(k % 31 == 0, F.lit("abc")).otherwise(F.col("strike_price").cast("string"))
    option = F.struct("pos", "symbol", "option_type", strike.alias("strike_price"))
    grouped = (items.groupBy("underlying", day.alias("trading_date"), "requested_expiry", "s")
               .agg(F.array_sort(F.collect_list(option)).alias("options")))
    listed = F.transform("options", lambda x: F.struct(
        x["symbol"].alias("symbol"), x["option_type"].alias("option_type"),
        x["strike_price"].alias("strike_price")))
    landed = _landed_chains(grouped.select("underlying", "trading_date", "requested_expiry", "s",
                                           F.struct(listed.alias("optionsChain")).alias("data")))
    nested = C.chain_items(landed)
    epoch = F.col("requested_expiry")
    targets = nested.select("underlying", "trading_date", epoch.alias("epoch"),
                            F.date_add(F.lit(dt.date(1970, 1, 1)), epoch.cast("int")).alias("expiry")).distinct()
    rows = C.chain_rows(C.tag_requested_expiry(nested, targets), C.prefix_dim(spark))
    return C.option_contracts(rows)


@query("master_lines", "WITH " + MASTER_SQL + """
SELECT o_orderkey, symbol, CAST(symbol_pos + 1 AS INTEGER) AS symbol_pos, exch, root, expiry FROM x
WHERE expiry IS NOT NULL
""")
def q_master_lines(spark, sf):
    """The symbol master as a text file: ragged rows, a first cell with commas and
    quotes, a stray quote in the last but one."""
    rows = master_rows(spark, sf)
    line = F.concat(F.lit('"a ""b"", c",'), F.array_join("cells", ","), F.lit(',5" pipe,'),
                    F.col("o_orderkey").cast("string"))
    path = scratch_path(spark, "master")
    rows.select(line.alias("value")).write.text(path)
    cells = read_symbol_master(spark, path)
    keyed = cells.select(F.element_at("cells", -1).cast("bigint").alias("o_orderkey"),
                         F.slice("cells", F.lit(1), F.size("cells") - 1).alias("cells"))
    return C.master_candidates(keyed)


@query("csv_bars", f"""
WITH {TYPE_BARS}
SELECT upper(event_type) AS "Index", w AS timestamp, o AS Open, h AS High, l AS Low, c AS Close,
       CAST(v AS BIGINT) AS Volume
FROM ev WHERE k <> 9
""")
def q_csv_bars(spark, sf):
    """Spot bars written as CSV and read back with the declared schema."""
    path = scratch_path(spark, "spot-csv")
    write_csv(B.spot_bars(spot_payloads(spark, sf), spot_index(spark, sf)), path)
    return read_bars(spark, path, "spot", "csv")


@query("written_outputs", f"""
WITH u AS (WITH {USER_BARS}
  SELECT CAST(w AS DATE) AS date, c.c_custkey FROM ev e JOIN customer c ON e.user_id = c.c_custkey WHERE e.k <> 9),
s AS (WITH {TYPE_BARS} SELECT CAST(w AS DATE) AS date FROM ev WHERE k <> 9)
SELECT 'options' AS kind, CASE WHEN c_custkey % 2 = 0 THEN 'NSE' ELSE 'BSE' END AS exchange, date,
       CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS stored FROM u GROUP BY 2, 3
UNION ALL SELECT 'futures', NULL, date, count(*), count(*) FROM u GROUP BY date
UNION ALL SELECT 'spot', NULL, date, count(*), count(*) FROM s GROUP BY date
""")
def q_written_outputs(spark, sf):
    """A run's tables written by exchange, index and day: the writer's report, and the
    rows read back per subset."""
    payloads = written_once(option_payloads(spark, sf), "answers")      # of options and futures
    even = F.col("c_custkey") % 2 == 0
    c = table(spark, sf, "customer")
    name = F.concat(F.lit("U"), F.col("c_custkey").cast("string"))
    under = F.when(even, F.lit("NIFTY")).otherwise(F.lit("SENSEX"))
    options = B.options_bars(payloads, c.select(
        name.alias("Ticker"), under.alias("Underlying"), F.lit(dt.date(2024, 2, 29)).alias("Expiry"),
        F.lit(100).alias("Strike"), F.lit("CE").alias("OptionType")))
    futures = B.futures_bars(payloads, c.select(
        name.alias("symbol"), name.alias("ticker"), F.lit("I").alias("contract_series"),
        under.alias("underlying")))
    spot = B.spot_bars(spot_payloads(spark, sf), spot_index(spark, sf))
    out = scratch_path(spark, "outputs")
    report = write_outputs(spark, {"options": options, "futures": futures, "spot": spot}, out, validate=False)
    none = F.lit(None).cast("string")
    back = (spark.read.parquet(f"{out}/options").groupBy("exchange", PART_COL).agg(F.count(F.lit(1)).alias("stored"))
            .select(F.lit("options").alias("kind"), "exchange", F.col(PART_COL).alias("date"), "stored"))
    for kind, fmt in (("futures", "parquet"), ("spot", "csv")):
        rows = spark.read.option("header", True).format(fmt).load(f"{out}/{kind}")
        back = back.union(rows.groupBy(PART_COL).agg(F.count(F.lit(1)).alias("stored"))
                          .select(F.lit(kind), none, F.col(PART_COL), "stored"))
    b = back.toDF("b_kind", "b_exchange", "b_date", "stored")
    return (report.where("status = 'written'")
            .join(b, F.expr("kind = b_kind and exchange <=> b_exchange and date = b_date"))
            .select("kind", "exchange", "date", "rows", "stored"))
