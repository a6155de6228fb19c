"""Contract queries: expiry window, option discovery (part as the chain),
futures symbols and symbol-master parsing (orders as master rows)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketbars.functions.epochs import expiry_epoch_to_date, plausible_expiry_epoch
from marketbars.functions.symbols import fut_symbol_parts, month_expiry
from marketbars.functions.timefmt import ntz_epoch_seconds
from marketbars.operators import contracts as C
from marketbars.queries import query, table
from marketbars.schemas import DEFAULT_UNDERLYINGS, FUT_SYMBOL_PATTERN, MONTHS

LISTING_DATE = "1998-01-01"
CHAIN_DATE = "2026-08-03"
MASTER_DATE = "2029-06-15"
# the five market segments of the customer table (fixed by the benchmark spec)
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


# ------------------------------------------------------------ expiry window

def listing_items(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    text = F.date_format("o_orderdate", "d-M-yyyy")
    return o.select(
        F.col("o_orderpriority").alias("underlying"),
        F.lit(dt.date.fromisoformat(LISTING_DATE)).alias("trading_date"),
        k.alias("pos"),
        F.when(k % 13 == 0, F.lit(None)).when(k % 11 == 0, F.concat(F.lit("9"), text))
         .otherwise(text).alias("date_text"),
        F.when(k % 9 == 0, F.lit("")).otherwise((k * 100).cast("string")).alias("epoch"))


@query("expiry_window", f"""
WITH items AS (
  SELECT o_orderpriority AS underlying, DATE '{LISTING_DATE}' AS trading_date, o_orderkey AS pos,
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
def q_expiry_window(spark, sf):
    return C.expiry_targets(listing_items(spark, sf))


# ---------------------------------------------------------- option discovery

def chain_from_part(spark, sf):
    return chain_parts(spark, sf)[0]


def chain_parts(spark, sf):
    """(chain rows, expiry targets, per-expiry chain items) from ``part``."""
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    i = (k % 3 + 1).cast("int")
    under = F.try_element_at(F.array(*[F.lit(x) for x in ("NIFTY", "BANKNIFTY", "SENSEX")]), i)
    prefix = F.try_element_at(F.array(*[F.lit(x) for x in ("NSE:NIFTY", "NSE:BANKNIFTY", "BSE:SENSEX")]), i)
    d = F.lit(dt.date.fromisoformat(CHAIN_DATE))
    expiry = F.date_add(d, (F.col("p_size") % 5 * 7).cast("int"))
    otype = (F.when(k % 7 == 0, F.lit("XX")).when(k % 7 == 1, F.lit(None))
              .when(k % 2 == 0, F.lit("CE")).otherwise(F.lit("PE")))
    sym = F.concat(prefix, F.substring("p_brand", 7, 2), F.coalesce(otype, F.lit("NA")))
    symbol = (F.when(k % 17 == 0, F.lit("")).when(k % 19 == 0, F.concat(F.lit("XX:"), sym))
               .when(k % 23 == 0, F.lower(sym)).otherwise(sym))
    strike = (F.when(k % 11 == 0, F.lit(-1.0)).when(k % 13 == 0, F.lit(None).cast("double"))
               .when(k % 29 == 0, F.col("p_retailprice")).otherwise(F.col("p_size") * 100.0))
    s = F.when((under == "SENSEX") & (F.col("p_size") % 5 == 4), F.lit("error")).otherwise(F.lit("ok"))
    epoch = F.unix_date(expiry).cast("string")
    items = p.select(under.alias("underlying"), d.alias("trading_date"), epoch.alias("requested_expiry"),
                     s.alias("s"), k.alias("pos"), symbol.alias("symbol"),
                     otype.alias("option_type"), strike.alias("strike_price"), expiry.alias("_exp"))
    targets = items.select("underlying", "trading_date", F.col("_exp").alias("expiry"),
                           F.col("requested_expiry").alias("epoch")).distinct()
    tagged = C.tag_requested_expiry(items.drop("_exp"), targets)
    return C.chain_rows(tagged, C.prefix_dim(spark)), targets, items.drop("_exp")


CHAIN_SQL = f"""
base AS (
  SELECT p_partkey AS pos, p_size, p_brand,
    (['NIFTY', 'BANKNIFTY', 'SENSEX'])[p_partkey % 3 + 1] AS underlying,
    (['NSE:NIFTY', 'NSE:BANKNIFTY', 'BSE:SENSEX'])[p_partkey % 3 + 1] AS prefix,
    DATE '{CHAIN_DATE}' AS trading_date,
    CAST(DATE '{CHAIN_DATE}' + CAST(7 * (p_size % 5) AS INTEGER) AS DATE) AS expiry,
    CASE WHEN p_partkey % 7 = 0 THEN 'XX' WHEN p_partkey % 7 = 1 THEN NULL
         WHEN p_partkey % 2 = 0 THEN 'CE' ELSE 'PE' END AS option_type,
    CASE WHEN p_partkey % 11 = 0 THEN -1.0 WHEN p_partkey % 13 = 0 THEN NULL
         WHEN p_partkey % 29 = 0 THEN p_retailprice ELSE p_size * 100.0 END AS strike_price
  FROM part),
items AS (
  SELECT *, CASE WHEN pos % 17 = 0 THEN '' WHEN pos % 19 = 0 THEN 'XX:' || sym
                 WHEN pos % 23 = 0 THEN lower(sym) ELSE sym END AS symbol,
    CASE WHEN underlying = 'SENSEX' AND p_size % 5 = 4 THEN 'error' ELSE 'ok' END AS s
  FROM (SELECT *, prefix || substr(p_brand, 7, 2) || coalesce(option_type, 'NA') AS sym FROM base)),
rows AS (
  SELECT *, coalesce(symbol IS NOT NULL AND symbol <> '' AND option_type IN ('CE', 'PE')
      AND strike_price IS NOT NULL AND strike_price <> -1
      AND len(list_filter(CASE underlying WHEN 'NIFTY' THEN ['NSE:NIFTY', 'NIFTY']
                                          WHEN 'BANKNIFTY' THEN ['NSE:BANKNIFTY', 'BANKNIFTY']
                                          WHEN 'SENSEX' THEN ['BSE:SENSEX', 'SENSEX'] END,
                          lambda x: starts_with(upper(symbol), x))) > 0, false) AS usable,
    CAST(trunc(strike_price) AS INTEGER) AS strike
  FROM items WHERE s = 'ok'),
contracts AS (
  SELECT trading_date, symbol AS Ticker, underlying AS Underlying, expiry AS Expiry,
         strike AS Strike, option_type AS OptionType FROM (
    SELECT *, row_number() OVER (PARTITION BY underlying, trading_date, symbol
                                 ORDER BY expiry DESC, pos DESC) AS rn
    FROM rows WHERE usable) WHERE rn = 1)"""


@query("option_contracts", "WITH " + CHAIN_SQL + " SELECT * FROM contracts")
def q_option_contracts(spark, sf):
    return C.option_contracts(chain_from_part(spark, sf))


@query("contracts_per_expiry", "WITH " + CHAIN_SQL + """,
stats AS (SELECT underlying, expiry, CAST(count(*) FILTER (WHERE usable) AS BIGINT) AS usable,
                 CAST(count(*) AS BIGINT) AS raw FROM rows GROUP BY underlying, expiry),
per AS (SELECT Underlying, Expiry, count(*) AS contracts FROM contracts GROUP BY Underlying, Expiry)
SELECT s.underlying AS Underlying, s.expiry AS Expiry, s.usable, s.raw,
       CAST(coalesce(per.contracts, 0) AS BIGINT) AS contracts
FROM stats s LEFT JOIN per ON s.underlying = per.Underlying AND s.expiry = per.Expiry
""")
def q_contracts_per_expiry(spark, sf):
    rows = chain_from_part(spark, sf)
    stats = C.expiry_stats(rows)
    per = C.contracts_per_expiry(C.option_contracts(rows))
    j = stats.join(per, (stats.underlying == per.Underlying) & (stats.expiry == per.Expiry), "left")
    # a report of one row per listed expiry: shown in key order (a tiny sort)
    return (j.select(stats.underlying.alias("Underlying"), stats.expiry.alias("Expiry"),
                     stats.usable, stats.raw, F.coalesce(per.contracts, F.lit(0)).alias("contracts"))
             .orderBy("Underlying", "Expiry"))


_IDX_SQL = ", ".join(f"('{u}')" for u in DEFAULT_UNDERLYINGS)


@query("discovery_status", "WITH " + CHAIN_SQL + f""",
idx AS (SELECT u.underlying, d.trading_date
        FROM (VALUES {_IDX_SQL}) u(underlying),
             (SELECT DISTINCT trading_date FROM base
              UNION SELECT DISTINCT CAST(trading_date + 1 AS DATE) FROM base) d),
tg AS (SELECT underlying, trading_date, count(DISTINCT expiry) AS expiries FROM base GROUP BY ALL),
fr AS (SELECT underlying, trading_date, count(DISTINCT expiry) AS failed_requests FROM items
       WHERE coalesce(s, '') <> 'ok' GROUP BY ALL),
ct AS (SELECT Underlying AS underlying, trading_date, count(*) AS contracts FROM contracts GROUP BY ALL)
SELECT idx.underlying, idx.trading_date, CAST(coalesce(expiries, 0) AS BIGINT) AS expiries,
  CAST(coalesce(contracts, 0) AS BIGINT) AS contracts,
  CAST(coalesce(failed_requests, 0) AS BIGINT) AS failed_requests,
  CASE WHEN coalesce(expiries, 0) = 0 THEN 'no_expiries' WHEN coalesce(contracts, 0) = 0 THEN 'no_contracts'
       ELSE 'ok' END AS status
FROM idx LEFT JOIN tg USING (underlying, trading_date) LEFT JOIN fr USING (underlying, trading_date)
LEFT JOIN ct USING (underlying, trading_date)
""")
def q_discovery_status(spark, sf):
    """Per index and day asked for (the chain's day and the day after, which
    has no listing): expiries, contracts, rejected requests and the verdict."""
    rows, targets, items = chain_parts(spark, sf)
    days = items.select("trading_date").distinct()
    days = days.unionByName(days.select(F.date_add("trading_date", 1).alias("trading_date"))).distinct()
    index_days = days.select("trading_date", F.explode(F.array(*[F.lit(u) for u in DEFAULT_UNDERLYINGS]))
                             .alias("underlying"))
    return C.discovery_status(index_days, targets, C.option_contracts(rows), C.failed_requests(items))


# ------------------------------------------------------------ futures symbols

_MONTH_CASE = "CASE mon " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MONTHS, 1)) + " END"


@query("symbol_parse", f"""
WITH s AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN lower(sym) ELSE sym END AS symbol FROM (
    SELECT o_orderkey, 'NSE:' || c_mktsegment || strftime(o_orderdate, '%y') ||
      CASE WHEN o_orderkey % 13 = 0 THEN 'XYZ' ELSE upper(strftime(o_orderdate, '%b')) END || 'FUT' AS sym
    FROM orders JOIN customer ON o_custkey = c_custkey)),
p AS (SELECT o_orderkey, symbol,
  CASE WHEN regexp_full_match(symbol, '{FUT_SYMBOL_PATTERN}') THEN regexp_extract(symbol, '{FUT_SYMBOL_PATTERN}', 1) END AS exch,
  CASE WHEN regexp_full_match(symbol, '{FUT_SYMBOL_PATTERN}') THEN regexp_extract(symbol, '{FUT_SYMBOL_PATTERN}', 2) END AS root,
  CASE WHEN regexp_full_match(symbol, '{FUT_SYMBOL_PATTERN}') THEN regexp_extract(symbol, '{FUT_SYMBOL_PATTERN}', 3) END AS yy,
  CASE WHEN regexp_full_match(symbol, '{FUT_SYMBOL_PATTERN}') THEN regexp_extract(symbol, '{FUT_SYMBOL_PATTERN}', 4) END AS mon
  FROM s)
SELECT *, CASE WHEN ({_MONTH_CASE}) IS NOT NULL
               THEN make_date(2000 + CAST(yy AS INTEGER), {_MONTH_CASE}, 1) END AS expiry
FROM p
""")
def q_symbol_parse(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k = F.col("o_orderkey")
    mon = F.when(k % 13 == 0, F.lit("XYZ")).otherwise(F.upper(F.date_format("o_orderdate", "MMM")))
    sym = F.concat(F.lit("NSE:"), F.col("c_mktsegment"), F.date_format("o_orderdate", "yy"), mon, F.lit("FUT"))
    sym = F.when(k % 17 == 0, F.lower(sym)).otherwise(sym)
    s = j.select("o_orderkey", sym.alias("symbol"))
    p = s.select("o_orderkey", "symbol", fut_symbol_parts(F.col("symbol")).alias("p"))
    return p.select("o_orderkey", "symbol", "p.exch", "p.root", "p.yy", "p.mon",
                    month_expiry(F.col("p.yy"), F.col("p.mon")).alias("expiry"))


# ---------------------------------------------------------------- epochs

@query("epoch_parse", """
WITH c AS (
  SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '' ELSE CASE event_id % 5
      WHEN 0 THEN CAST(secs AS VARCHAR) WHEN 1 THEN CAST(secs * 1000 + event_id % 1000 AS VARCHAR)
      WHEN 2 THEN CAST(secs * 1000000 AS VARCHAR) WHEN 3 THEN ' ' || CAST(secs AS VARCHAR) || ' '
      ELSE 'x' || CAST(secs AS VARCHAR) END END AS cell
  FROM (SELECT event_id, epoch_us(ts) // 1000000 AS secs FROM events)),
p AS (SELECT *, CASE WHEN regexp_full_match(trim(cell), '[0-9]+') THEN TRY_CAST(trim(cell) AS HUGEINT) END AS raw FROM c),
q AS (SELECT *, CASE WHEN raw >= 1000000000000 AND raw < 10000000000000 THEN raw // 1000 ELSE raw END AS s1 FROM p),
r AS (SELECT event_id, cell, CAST(CASE WHEN s1 >= 1000000000 AND s1 <= 2051222400 THEN s1 END AS BIGINT) AS epoch_s FROM q),
t AS (SELECT *, CAST(to_timestamp(epoch_s) AT TIME ZONE 'Asia/Kolkata' AS DATE) AS expiry_date FROM r)
SELECT *, CAST(isodow(expiry_date) - 1 AS INTEGER) AS weekday,
       CAST(expiry_date + 1 AS DATE) AS next_day FROM t
""")
def q_epoch_parse(spark, sf):
    ev = table(spark, sf, "events")
    secs = ntz_epoch_seconds(F.col("ts"))
    eid = F.col("event_id")
    k = eid % 5
    cell = (F.when(k == 0, secs.cast("string"))
             .when(k == 1, (secs * 1000 + eid % 1000).cast("string"))
             .when(k == 2, (secs * 1000000).cast("string"))
             .when(k == 3, F.concat(F.lit(" "), secs.cast("string"), F.lit(" ")))
             .otherwise(F.concat(F.lit("x"), secs.cast("string"))))
    cell = F.when(eid % 7 == 0, F.lit("")).otherwise(cell)
    c = ev.select("event_id", cell.alias("cell"))
    d = expiry_epoch_to_date(F.col("cell"))
    return c.select("event_id", "cell", plausible_expiry_epoch(F.col("cell")).alias("epoch_s"),
                    d.alias("expiry_date"), F.weekday(d).alias("weekday"),
                    F.date_add(d, 1).alias("next_day"))


# ------------------------------------------------------- symbol-master rows

def master_rows(spark, sf):
    """Ragged master rows built from orders (one row per order)."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    secs = ntz_epoch_seconds(F.col("o_orderdate")) + 36000     # 10:00 UTC = 15:30 IST
    root = F.concat(F.lit("IX"), F.col("o_orderstatus"))
    yy = F.date_format("o_orderdate", "yy")
    mon = F.upper(F.date_format("o_orderdate", "MMM"))
    sym = F.concat(F.lit("NSE:"), root, yy, mon, F.lit("FUT"))
    bad = F.concat(F.lit("NSE:"), root, yy, F.lit("XYZ"), F.lit("FUT"))
    other = F.concat(F.lit("NSE:"), root, F.lit("99JANFUT"))
    idh = (k * 1000003 + F.lit(9000000000000000)).cast("string")
    s, ms = secs.cast("string"), (secs * 1000).cast("string")
    cells = (F.when(k % 11 == 0, F.array(idh, F.lit("abc"), bad))
              .when(k % 13 == 0, F.array(idh, s, sym, other))
              .when(k % 4 == 0, F.array(idh, F.date_format("o_orderdate", "yyyy-MM-dd"), s, sym, F.lit("EQ")))
              .when(k % 4 == 1, F.array(idh, s, F.lit("x"), sym))
              .when(k % 4 == 2, F.array(idh, F.lit("abc"), F.concat(F.lit(" "), sym, F.lit(" "))))
              .otherwise(F.array(sym, ms)))
    return o.select("o_orderkey", cells.alias("cells"))


_EP = ("CASE WHEN regexp_full_match(trim(c), '[0-9]+') THEN CASE WHEN TRY_CAST(trim(c) AS HUGEINT) >= 1000000000000 "
       "AND TRY_CAST(trim(c) AS HUGEINT) < 10000000000000 THEN TRY_CAST(trim(c) AS HUGEINT) // 1000 "
       "ELSE TRY_CAST(trim(c) AS HUGEINT) END END")

MASTER_SQL = f"""
m AS (
  SELECT o_orderkey, secs, 'NSE:IX' || o_orderstatus || yy AS head, mon,
    CAST(9000000000000000 + o_orderkey * 1000003 AS VARCHAR) AS idh, o_orderdate
  FROM (SELECT *, epoch_us(o_orderdate) // 1000000 + 36000 AS secs, strftime(o_orderdate, '%y') AS yy,
               upper(strftime(o_orderdate, '%b')) AS mon FROM orders)),
c AS (
  SELECT o_orderkey, CASE
    WHEN o_orderkey % 11 = 0 THEN [idh, 'abc', head || 'XYZFUT']
    WHEN o_orderkey % 13 = 0 THEN [idh, CAST(secs AS VARCHAR), head || mon || 'FUT', 'NSE:IX' || substr(head, 7, 1) || '99JANFUT']
    WHEN o_orderkey % 4 = 0 THEN [idh, strftime(o_orderdate, '%Y-%m-%d'), CAST(secs AS VARCHAR), head || mon || 'FUT', 'EQ']
    WHEN o_orderkey % 4 = 1 THEN [idh, CAST(secs AS VARCHAR), 'x', head || mon || 'FUT']
    WHEN o_orderkey % 4 = 2 THEN [idh, 'abc', ' ' || head || mon || 'FUT ']
    ELSE [head || mon || 'FUT', CAST(secs * 1000 AS VARCHAR)] END AS cells
  FROM m),
f AS (
  SELECT o_orderkey, cells,
    list_transform(cells, lambda c: trim(coalesce(c, ''))) AS st,
    list_transform(list_transform(cells, lambda c: {_EP}),
                   lambda s: CASE WHEN s >= 1000000000 AND s <= 2051222400
                             THEN CAST(to_timestamp(CAST(s AS BIGINT)) AT TIME ZONE 'Asia/Kolkata' AS DATE) END) AS ep
  FROM c),
g AS (
  SELECT *, coalesce(list_position(list_transform(st, lambda c: regexp_full_match(c, '{FUT_SYMBOL_PATTERN}')), true), 0) AS pos
  FROM f),
h AS (
  SELECT o_orderkey, st[pos] AS symbol, CAST(pos AS INTEGER) AS symbol_pos,
    regexp_extract(st[pos], '{FUT_SYMBOL_PATTERN}', 1) AS exch,
    regexp_extract(st[pos], '{FUT_SYMBOL_PATTERN}', 2) AS root,
    regexp_extract(st[pos], '{FUT_SYMBOL_PATTERN}', 3) AS yy,
    regexp_extract(st[pos], '{FUT_SYMBOL_PATTERN}', 4) AS mon,
    CASE WHEN pos > 1 THEN ep[pos - 1] END AS before_cell,
    list_filter(ep, lambda x: x IS NOT NULL)[1] AS any_cell
  FROM g WHERE pos > 0),
x AS (
  SELECT o_orderkey, symbol, symbol_pos, exch, root,
    coalesce(before_cell, any_cell, CASE WHEN ({_MONTH_CASE}) IS NOT NULL
             THEN make_date(2000 + CAST(yy AS INTEGER), {_MONTH_CASE}, 1) END) AS expiry
  FROM h)"""


@query("expiry_fallback", "WITH " + MASTER_SQL + " SELECT * FROM x WHERE expiry IS NOT NULL")
def q_expiry_fallback(spark, sf):
    return C.master_candidates(master_rows(spark, sf))


def segment_specs(spark):
    rows = [(s, s, "BSE" if s == "MACHINERY" else "NSE", "FO") for s in SEGMENTS]
    return spark.createDataFrame(rows, "underlying string, root string, exchange string, segment string")


def segment_master(spark, sf):
    """One master row per order: huge id, expiry epoch (15:30 IST of the order
    date rebased 31 years into the plausible epoch range), FUT symbol."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    r = F.add_months(F.to_date("o_orderdate"), 372)
    secs = (F.unix_date(r).cast("bigint") * 86400 + 36000).cast("string")
    sym = F.concat(F.lit("NSE:"), F.col("c_mktsegment"), F.date_format(r, "yy"),
                   F.upper(F.date_format(r, "MMM")), F.lit("FUT"))
    idh = (F.col("o_orderkey") * 1000003 + F.lit(9000000000000000)).cast("string")
    return j.select(F.array(idh, secs, sym).alias("cells"))


_SEG = ", ".join(f"('{s}', '{'BSE' if s == 'MACHINERY' else 'NSE'}')" for s in SEGMENTS)

NEAR_CTES = f"""WITH r AS (
  SELECT c_mktsegment, CAST(CAST(o_orderdate AS DATE) + INTERVAL 31 YEAR AS DATE) AS d
  FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (
  SELECT c_mktsegment AS root, 'NSE' AS exch, strftime(d, '%y') AS yy, upper(strftime(d, '%b')) AS mon,
    'NSE:' || c_mktsegment || strftime(d, '%y') || upper(strftime(d, '%b')) || 'FUT' AS symbol,
    date_diff('second', TIMESTAMP '1970-01-01', CAST(d AS TIMESTAMP)) + 36000 AS secs
  FROM r),
e AS (
  SELECT *, CASE WHEN secs >= 1000000000 AND secs <= 2051222400
                 THEN CAST(to_timestamp(secs) AT TIME ZONE 'Asia/Kolkata' AS DATE)
                 ELSE make_date(2000 + CAST(yy AS INTEGER), {_MONTH_CASE}, 1) END AS expiry
  FROM m),
s AS (SELECT * FROM (VALUES {_SEG}) t(root, exch)),
c AS (SELECT e.root AS underlying, symbol, min(expiry) AS expiry
      FROM e JOIN s ON e.root = s.root AND e.exch = s.exch
      WHERE expiry >= DATE '{MASTER_DATE}' GROUP BY e.root, symbol)"""


@query("near_next_far", f"""
{NEAR_CTES},
k AS (SELECT *, row_number() OVER (PARTITION BY underlying ORDER BY expiry, symbol) AS rank FROM c)
SELECT underlying, symbol, underlying || '-' || (['I', 'II', 'III'])[rank] || '.NFO' AS ticker,
       (['I', 'II', 'III'])[rank] AS contract_series, expiry, CAST(rank AS INTEGER) AS rank
FROM k WHERE rank <= 3
""")
def q_near_next_far(spark, sf):
    return C.resolve_futures(segment_master(spark, sf), MASTER_DATE, segment_specs(spark))


RANGE_START, RANGE_END = "2029-06-01", "2029-07-31"


@query("futures_range", f"""
WITH r AS (
  SELECT c_mktsegment, CAST(CAST(o_orderdate AS DATE) + INTERVAL 31 YEAR AS DATE) AS d
  FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (
  SELECT c_mktsegment AS root, 'NSE' AS exch, strftime(d, '%y') AS yy, upper(strftime(d, '%b')) AS mon,
    'NSE:' || c_mktsegment || strftime(d, '%y') || upper(strftime(d, '%b')) || 'FUT' AS symbol,
    date_diff('second', TIMESTAMP '1970-01-01', CAST(d AS TIMESTAMP)) + 36000 AS secs
  FROM r),
e AS (
  SELECT *, CASE WHEN secs >= 1000000000 AND secs <= 2051222400
                 THEN CAST(to_timestamp(secs) AT TIME ZONE 'Asia/Kolkata' AS DATE)
                 ELSE make_date(2000 + CAST(yy AS INTEGER), {_MONTH_CASE}, 1) END AS expiry
  FROM m),
s AS (SELECT * FROM (VALUES {_SEG}) t(root, exch)),
c AS (SELECT DISTINCT e.root AS underlying, symbol, expiry FROM e JOIN s ON e.root = s.root AND e.exch = s.exch),
td AS (SELECT d AS trading_date FROM (
         SELECT CAST(unnest(generate_series(DATE '{RANGE_START}', DATE '{RANGE_END}', INTERVAL 1 DAY)) AS DATE) AS d)
       WHERE isodow(d) <= 5),
p AS (SELECT underlying, trading_date, symbol, min(expiry) AS expiry
      FROM td JOIN c ON c.expiry >= td.trading_date GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY underlying, trading_date ORDER BY expiry, symbol) AS rank FROM p)
SELECT underlying, trading_date, symbol, underlying || '-' || (['I', 'II', 'III'])[rank] || '.NFO' AS ticker,
       (['I', 'II', 'III'])[rank] AS contract_series, expiry, CAST(rank AS INTEGER) AS rank
FROM k WHERE rank <= 3
""")
def q_futures_range(spark, sf):
    from marketbars.plans.collect import trading_dates
    days = trading_dates(spark, RANGE_START, RANGE_END)
    return C.resolve_futures_range(segment_master(spark, sf), days, segment_specs(spark))


@query("unresolved_futures", f"""
{NEAR_CTES}
SELECT s.root AS underlying, 'no active futures on or after the date' AS reason
FROM s WHERE s.root NOT IN (SELECT underlying FROM c)
""")
def q_unresolved_futures(spark, sf):
    """Configured indexes with no active contract (the spec says BSE for one
    segment while every master row of it is NSE: exact exchange match)."""
    specs = segment_specs(spark)
    resolved = C.resolve_futures(segment_master(spark, sf), MASTER_DATE, specs)
    return C.unresolved_indexes(specs, resolved)
