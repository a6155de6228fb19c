"""Payload queries: events are ticks, rolled up into 1-minute bars and landed
as vendor-style JSON responses (one per user and day for options/futures, one
per event type and day for spot, so a response never holds more than 1,440
bars), parsed back with the declared schema, classified and flattened."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketbars.functions.timefmt import ntz_epoch_seconds
from marketbars.operators import bars as B
from marketbars.operators.report import (
    date_status, expected_kinds, outcome_counts, run_summary, run_verdict,
)
from marketbars.queries import query, table
from marketbars.functions.symbols import continuous_ticker
from marketbars.sources.readers import parse_bar_payload_text, parse_candles


def _land(payloads, candles, broken=None):
    """Serialise to JSON text and parse back: what a landed response file holds.
    ``candles`` are cell texts: responses of even ``k`` carry them as JSON numbers
    (a cell that is no number as null), the others as quoted text. ``broken``
    responses carry an object in the place of the list."""
    fields = ("symbol", "trading_date", "s", "message")
    numbers = F.transform(candles, lambda c: F.transform(c, lambda x: x.try_cast("double")))
    empty = F.struct(F.lit("x").alias("x"))

    def line(cells):
        return F.to_json(F.struct(*fields, cells.alias("candles")), {"ignoreNullFields": "false"})
    text = F.when(F.col("k") % 2 == 0, line(numbers)).otherwise(line(candles))
    if broken is not None:
        text = F.when(broken, line(empty)).otherwise(text)
    raw = payloads.select(parse_bar_payload_text(text).alias("p")).select("p.*")
    return parse_candles(raw)


def _faults(k):
    """(s, message) per injected case; k in 0..9 from the payload's first event id."""
    s = (F.when(k == 0, F.lit("no_data")).when(k.isin(1, 2), F.lit("error"))
          .when(k == 5, F.lit(None)).when(k == 6, F.lit("OK")).otherwise(F.lit("ok")))
    msg = (F.when(k == 1, F.lit("No data for this symbol")).when(k == 2, F.lit("rate limited"))
            .when(k == 5, F.lit("no candles in range")).otherwise(F.lit("")))
    return s, msg


def minute_bars(ev, key, symbol):
    """Events as ticks -> one 1-minute OHLC bar per (key, minute).

    Ticks are ordered by their sequence number (``event_id``): open/close are
    the values of the first/last tick of the minute, volume is the tick count.
    Every aggregate has a fixed-width buffer, so Spark plans a hash aggregate
    with a map-side partial step: a key holding a third of all events still
    sends at most one row per minute per map task. ``symbol`` (an expression
    over ``key``) is applied after the aggregation.
    """
    minute = F.floor(ntz_epoch_seconds(F.col("ts")) / 60) * 60    # floor: also before 1970
    b = ev.groupBy(key, F.to_date("ts").alias("trading_date"), minute.alias("epoch")).agg(
        F.min_by("value", "event_id").alias("o"), F.max("value").alias("h"),
        F.min("value").alias("l"), F.max_by("value", "event_id").alias("c"),
        F.count(F.lit(1)).alias("v"), F.max("event_id").alias("oi"),
        F.min("event_id").alias("first_id"))
    return b.select(symbol.alias("symbol"), *[c for c in b.columns if c != key])


def _payloads(bars, candle):
    """Minute bars -> one response per (symbol, trading_date): at most 1,440
    bars a day whatever the data volume; ``k`` (0..9) picks the injected case."""
    return (bars.groupBy("symbol", "trading_date")
                .agg(F.array_sort(F.collect_list(candle)).alias("candles"),
                     (F.min("first_id") % 10).alias("k")))


def _finish(p, faults, fields):
    """Bad cells in every response: no number as the volume of every fifth count of
    ticks, and no epoch in the first bar of responses with k = 9 (which fails them).
    With ``faults``, an empty list (k = 3), a short first bar (k = 4), an object in
    the place of the list (k = 7) and the answers of ``_faults`` too."""
    k = F.col("k")
    cells = F.transform("candles", lambda c, i: F.transform(c, lambda x, j: F.when(
        (j == 5) & (x % 5 == 0), F.lit("n/a")).when(
        (j == 0) & (i == 0) & (k == 9), F.lit(None).cast("string")).otherwise(x.cast("string"))))
    if faults:
        s, msg = _faults(k)
        cells = (F.when(k == 3, F.array().cast("array<array<string>>"))
                  .when(k == 4, F.transform(cells, lambda c, i: F.when(i == 0, F.slice(c, 1, fields - 1))
                                            .otherwise(c)))
                  .otherwise(cells))
        broken = k == 7
    else:
        s, msg, broken = F.lit("ok"), F.lit(""), None
    return _land(p.select("symbol", "trading_date", "k", s.alias("s"), msg.alias("message"),
                          cells.alias("candles")), F.col("candles"), broken)


def option_payloads(spark, sf, faults=False):
    """One options response per user and day: [epoch, o, h, l, c, v, oi] bars."""
    ev = table(spark, sf, "events")
    b = minute_bars(ev, "user_id", F.concat(F.lit("U"), F.col("user_id").cast("string")))
    candle = F.array(*[F.col(c).cast("double") for c in ("epoch", "o", "h", "l", "c", "v", "oi")])
    return _finish(_payloads(b, candle), faults, 7)


def spot_payloads(spark, sf, faults=False):
    """One spot response per event type and day: [epoch, o, h, l, c, v] bars,
    followed by a re-sent copy (close + 1) of every bar whose volume is even,
    which keep-first must drop."""
    ev = table(spark, sf, "events")
    b = minute_bars(ev, "event_type", F.concat(F.lit("IDX:"), F.upper("event_type")))
    candle = F.array(*[F.col(c).cast("double") for c in ("epoch", "o", "h", "l", "c", "v")])
    p = _payloads(b, candle)
    resent = F.transform(F.filter("candles", lambda c: c[5] % 2 == 0),
                         lambda c: F.array(c[0], c[1], c[2], c[3], c[4] + 1, c[5]))
    return _finish(p.withColumn("candles", F.concat("candles", resent)), faults, 6)


def customer_contracts(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("Ticker"),
                    F.col("c_mktsegment").alias("Underlying"),
                    F.date_add(F.lit("2024-01-25").cast("date"), F.col("c_nationkey")).alias("Expiry"),
                    (F.col("c_nationkey") * 100 + 100).cast("int").alias("Strike"),
                    F.when(F.col("c_custkey") % 2 == 0, F.lit("CE")).otherwise(F.lit("PE")).alias("OptionType"))


MINUTE_BARS = """mb AS (
  SELECT {key}, m, arg_min(value, event_id) AS o, max(value) AS h, min(value) AS l,
         arg_max(value, event_id) AS c, count(*) AS n, max(event_id) AS oi, min(event_id) AS first_id
  FROM (SELECT *, date_trunc('minute', ts) AS m FROM events) GROUP BY {key}, m),
ev AS (SELECT *, (to_timestamp(epoch_us(m) // 1000000) AT TIME ZONE 'Asia/Kolkata') AS w,
         CASE WHEN n % 5 <> 0 THEN n END AS v,
         min(first_id) OVER (PARTITION BY {key}, CAST(m AS DATE)) % 10 AS k FROM mb)"""
USER_BARS = MINUTE_BARS.format(key="user_id")
TYPE_BARS = MINUTE_BARS.format(key="event_type")


@query("bars_from_payload", f"""
WITH {USER_BARS}
SELECT 'U' || e.user_id AS Ticker, CAST(w AS DATE) AS Date, strftime(w, '%H:%M:%S') AS Time,
  e.o AS Open, e.h AS High, e.l AS Low, e.c AS Close,
  CAST(e.v AS BIGINT) AS Volume, CAST(e.oi AS BIGINT) AS OpenInterest,
  c.c_mktsegment AS Underlying, CAST(DATE '2024-01-25' + c.c_nationkey AS DATE) AS Expiry,
  CAST(c.c_nationkey * 100 + 100 AS INTEGER) AS Strike,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'CE' ELSE 'PE' END AS OptionType
FROM ev e JOIN customer c ON e.user_id = c.c_custkey WHERE e.k <> 9
""")
def q_bars_from_payload(spark, sf):
    return B.options_bars(option_payloads(spark, sf), customer_contracts(spark, sf))


@query("futures_bars", f"""
WITH {USER_BARS}
SELECT c.c_mktsegment || '-' || (['I', 'II', 'III'])[c.c_nationkey % 3 + 1] || '.NFO' AS Ticker,
  CAST(w AS DATE) AS Date, strftime(w, '%H:%M:%S') AS Time,
  e.o AS Open, e.h AS High, e.l AS Low, e.c AS Close,
  CAST(e.v AS BIGINT) AS Volume, CAST(e.oi AS BIGINT) AS OpenInterest,
  'daily_extraction' AS SourceFile, c.c_mktsegment AS Underlying,
  (['I', 'II', 'III'])[c.c_nationkey % 3 + 1] AS ContractSeries
FROM ev e JOIN customer c ON e.user_id = c.c_custkey WHERE e.k <> 9
""")
def q_futures_bars(spark, sf):
    c = table(spark, sf, "customer")
    series = F.try_element_at(F.array(F.lit("I"), F.lit("II"), F.lit("III")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    contracts = c.select(F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("symbol"),
                         continuous_ticker(F.col("c_mktsegment"), series).alias("ticker"),
                         series.alias("contract_series"), F.col("c_mktsegment").alias("underlying"))
    return B.futures_bars(option_payloads(spark, sf), contracts)


@query("spot_bars", f"""
WITH {TYPE_BARS}
SELECT upper(event_type) AS "Index", w AS timestamp, o AS Open, h AS High, l AS Low, c AS Close,
       CAST(v AS BIGINT) AS Volume
FROM ev WHERE k <> 9
""")
def q_spot_bars(spark, sf):
    return B.spot_bars(spot_payloads(spark, sf), spot_index(spark, sf))


def spot_index(spark, sf):
    return (table(spark, sf, "events").select("event_type").distinct()
            .select(F.concat(F.lit("IDX:"), F.upper("event_type")).alias("symbol"),
                    F.upper("event_type").alias("Index")))


def all_outcomes(spark, sf):
    """Outcomes over what was asked for. Options: users of every seventh number
    were not asked for although they answered, and N-contracts of every eleventh
    user never answered. Spot: on every ninth day of the month nothing was asked
    for or landed, and on every fifth the CLICK index did not answer."""
    ev = table(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("trading_date"))
    pairs = ev.select("user_id", "trading_date").distinct()
    name = F.col("user_id").cast("string")
    asked = (pairs.where("user_id % 7 <> 3").select("trading_date", F.concat(F.lit("U"), name).alias("symbol"))
             .union(pairs.where("user_id % 11 = 0")
                    .select("trading_date", F.concat(F.lit("N"), name).alias("symbol"))))
    day = F.dayofmonth("trading_date")
    spot = (spot_payloads(spark, sf, faults=True)
            .where((day % 9 != 0) & ((day % 5 != 0) | (F.col("symbol") != "IDX:CLICK"))))
    spot_asked = (ev.select("event_type", "trading_date").distinct().where(day % 9 != 0)
                  .select("trading_date", F.concat(F.lit("IDX:"), F.upper("event_type")).alias("symbol")))
    o = B.payload_outcomes(option_payloads(spark, sf, faults=True), "options", 7, asked)
    s = B.payload_outcomes(spot, "spot", 6, spot_asked, B.spot_rows_kept(spot, spot_index(spark, sf)))
    return o.unionByName(s)


def status_of_days(spark, sf):
    days = table(spark, sf, "events").select(F.to_date("ts").alias("trading_date")).distinct()
    return date_status(outcome_counts(all_outcomes(spark, sf)), expected_kinds(days, ["options", "spot"]))


OUTCOME_SQL = """
m AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS d, date_trunc('minute', ts) AS m, event_id AS first_id
  FROM events),
g AS (
  SELECT d, 'options' AS kind, 'U' || user_id AS symbol, count(*) AS n, min(first_id) % 10 AS k
  FROM (SELECT user_id, d, m, min(first_id) AS first_id FROM m GROUP BY ALL) GROUP BY user_id, d
  UNION ALL
  SELECT d, 'spot', 'IDX:' || upper(event_type), count(*), min(first_id) % 10
  FROM (SELECT event_type, d, m, min(first_id) AS first_id FROM m GROUP BY ALL) GROUP BY event_type, d),
asked AS (
  SELECT DISTINCT d, 'options' AS kind, 'U' || user_id AS symbol FROM m WHERE user_id % 7 <> 3
  UNION ALL SELECT DISTINCT d, 'options', 'N' || user_id FROM m WHERE user_id % 11 = 0
  UNION ALL SELECT DISTINCT d, 'spot', 'IDX:' || upper(event_type) FROM m WHERE day(d) % 9 <> 0),
answer AS (
  SELECT asked.d, asked.kind, g.n, CASE
    WHEN g.k IS NULL OR (asked.kind = 'spot' AND day(asked.d) % 5 = 0 AND asked.symbol = 'IDX:CLICK')
      THEN 'failed'                                          -- no answer
    WHEN g.k IN (0, 1, 3, 5) THEN 'no_data'                  -- status, message, empty list, message
    WHEN g.k IN (2, 4, 6, 7, 9) THEN 'failed'                -- error, short bar, 'OK', no list, no epoch
    ELSE 'ok' END AS outcome
  FROM asked LEFT JOIN g ON asked.d = g.d AND asked.kind = g.kind AND asked.symbol = g.symbol),
counts AS (
  SELECT d AS date, kind, CAST(count(*) AS BIGINT) AS contracts,
    CAST(count(*) FILTER (WHERE outcome = 'ok') AS BIGINT) AS successful,
    CAST(count(*) FILTER (WHERE outcome = 'no_data') AS BIGINT) AS no_data,
    CAST(count(*) FILTER (WHERE outcome = 'failed') AS BIGINT) AS failed,
    CAST(coalesce(sum(CASE WHEN outcome = 'ok' THEN n ELSE 0 END), 0) AS BIGINT) AS rows
  FROM answer GROUP BY d, kind),
days AS (SELECT date, kind, coalesce(rows, 0) AS rows
         FROM (SELECT DISTINCT d AS date FROM m) CROSS JOIN (VALUES ('options'), ('spot')) t(kind)
         LEFT JOIN counts USING (date, kind)),
statuses AS (
  SELECT date, CAST(count(*) FILTER (WHERE rows > 0) AS BIGINT) AS kinds_produced,
    CAST(count(*) FILTER (WHERE NOT rows > 0) AS BIGINT) AS kinds_with_errors,
    CASE WHEN count(*) FILTER (WHERE rows > 0) = 0 THEN 'failed'
         WHEN count(*) FILTER (WHERE NOT rows > 0) > 0 THEN 'partial' ELSE 'downloaded' END AS status
  FROM days GROUP BY date)"""


@query("payload_outcomes", "WITH " + OUTCOME_SQL + " SELECT * FROM counts")
def q_payload_outcomes(spark, sf):
    return outcome_counts(all_outcomes(spark, sf))


@query("run_summary", "WITH " + OUTCOME_SQL + """
SELECT kind, CAST(sum(contracts) AS BIGINT) AS contracts, CAST(sum(successful) AS BIGINT) AS successful,
  CAST(sum(no_data) AS BIGINT) AS no_data, CAST(sum(failed) AS BIGINT) AS failed,
  CAST(sum(rows) AS BIGINT) AS rows
FROM counts GROUP BY kind
""")
def q_run_summary(spark, sf):
    return run_summary(outcome_counts(all_outcomes(spark, sf)))


@query("date_status", "WITH " + OUTCOME_SQL + " SELECT * FROM statuses")
def q_date_status(spark, sf):
    return status_of_days(spark, sf)


@query("run_verdict", "WITH " + OUTCOME_SQL + """
SELECT CAST(count(*) FILTER (WHERE status = 'downloaded') AS BIGINT) AS dates_downloaded,
       CAST(count(*) FILTER (WHERE status = 'partial') AS BIGINT) AS dates_partial,
       CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS dates_failed,
       CASE WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 1 ELSE 0 END AS exit_code
FROM statuses
""")
def q_run_verdict(spark, sf):
    return run_verdict(status_of_days(spark, sf))
