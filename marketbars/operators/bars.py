"""Landed vendor payloads -> typed options / futures / spot bar tables.

A payload row is one history response (request columns + ``s``, ``message``,
``candles``). All payloads of a run live in one DataFrame, so flattening is a
single ``posexplode`` over the whole scan rather than a loop per contract.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.functions.coerce import to_bigint, to_double
from marketbars.functions.timefmt import bar_date, bar_time, epoch_to_market_time
from marketbars.operators.merge import keep_first
from marketbars.schemas import (
    FUTURES_COLUMNS, FUTURES_SOURCE_LABEL, OPTIONS_COLUMNS, OPTIONS_SCHEMA,
    FUTURES_SCHEMA, SPOT_SCHEMA,
)
from marketbars.sources.readers import ARRIVAL

OK, NO_DATA, FAILED = "ok", "no_data", "failed"


def is_no_data(s: Column, message: Column) -> Column:
    """Vendor "no trades" answer: status no_data (any case), or a message that
    mentions "no data" / "no candle"."""
    status = F.lower(F.coalesce(s, F.lit("")))
    msg = F.lower(F.coalesce(message, F.lit("")))
    return (status == "no_data") | msg.contains("no data") | msg.contains("no candle")


def response_outcome(s: Column, message: Column, candles: Column, min_fields: int,
                     readable: Column | None = None) -> Column:
    """ok / no_data / failed for one response.

    ``s == 'ok'`` exactly is tested first (an ok response is never no_data). A
    ``candles`` value that is not a list of lists fails; a missing or empty list is
    no_data; any bar shorter than ``min_fields``, or whose epoch is not a number,
    fails the whole response. Other bad cells become missing values later. A
    non-ok response is no_data or failed by ``is_no_data``.
    """
    n_bars = F.coalesce(F.size(candles), F.lit(0))
    broken = F.exists(candles, lambda c: (F.coalesce(F.size(c), F.lit(0)) < min_fields)
                      | to_double(F.try_element_at(c, F.lit(1))).isNull())
    unread = F.lit(False) if readable is None else ~F.coalesce(readable, F.lit(True))
    return (F.when(s == "ok",
                   F.when(unread, F.lit(FAILED))
                   .when(n_bars <= 0, F.lit(NO_DATA))
                   .when(broken, F.lit(FAILED))
                   .otherwise(F.lit(OK)))
            .when(is_no_data(s, message), F.lit(NO_DATA))
            .otherwise(F.lit(FAILED)))


def with_outcome(payloads: DataFrame, min_fields: int) -> DataFrame:
    readable = F.col("readable") if "readable" in payloads.columns else None
    return payloads.withColumn("outcome", response_outcome(
        F.col("s"), F.col("message"), F.col("candles"), min_fields, readable))


def payload_outcomes(payloads: DataFrame, kind: str, min_fields: int,
                     requested: DataFrame | None = None,
                     kept: DataFrame | None = None) -> DataFrame:
    """One row per request: date, kind, symbol, outcome, rows kept.

    ``requested`` (trading_date, symbol): the contracts that were asked for.
    Responses to anything else are not counted, and a request without a response
    failed. Of several responses to one request the best outcome counts, and the
    rows of all that are ok. Without ``requested``, every response is a request.
    ``kept`` (trading_date, symbol, rows): rows that the table keeps, where that is
    fewer than the bars (re-sent bars).
    """
    p = with_outcome(payloads, min_fields)
    rows = F.when(F.col("outcome") == OK, F.size("candles")).otherwise(0).cast("bigint")
    if requested is None:
        answers = p.select("trading_date", "symbol", "outcome", rows.alias("rows"))
    else:
        # the order of the outcomes' names is their rank: failed < no_data < ok
        answers = (p.groupBy("trading_date", "symbol")
                   .agg(F.max("outcome").alias("outcome"), F.sum(rows).alias("rows")))
        answers = (requested.select("trading_date", "symbol").distinct()
                   .join(answers, ["trading_date", "symbol"], "left"))
    if kept is not None:
        counted = kept.select("trading_date", "symbol", F.col("rows").alias("_kept"))
        answers = (answers.join(counted, ["trading_date", "symbol"], "left")
                   .withColumn("rows", F.coalesce("_kept", F.lit(0))))
    return answers.select(
        F.col("trading_date").alias("date"), F.lit(kind).alias("kind"), "symbol",
        F.coalesce("outcome", F.lit(FAILED)).alias("outcome"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"))


def explode_bars(payloads: DataFrame, min_fields: int, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of the ok responses: request columns + ``keep`` + pos + wall clock + fields.

    ``pos`` (the bar's position in its payload) is the arrival order used for
    keep-first de-duplication.
    """
    ok = with_outcome(payloads, min_fields).where(F.col("outcome") == OK)
    x = ok.select("symbol", "trading_date", *keep, F.posexplode("candles").alias("pos", "c"))
    c = F.col("c")

    def field(i: int) -> Column:      # 0-based vendor position
        return F.try_element_at(c, F.lit(i + 1))

    wall = epoch_to_market_time(to_double(field(0)))
    return x.select(
        "symbol", "trading_date", *keep, "pos", wall.alias("wall"),
        to_double(field(1)).alias("Open"), to_double(field(2)).alias("High"),
        to_double(field(3)).alias("Low"), to_double(field(4)).alias("Close"),
        to_bigint(field(5)).alias("Volume"), to_bigint(field(6)).alias("OpenInterest"))


def conform(df: DataFrame, schema, keep: Sequence[str] = ()) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types (then ``keep``)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *keep)


def _answered(payloads: DataFrame, contracts: DataFrame, symbol_col: str) -> DataFrame:
    """Responses with their contract's columns. The join is on whole responses,
    before the bars are exploded: a response is one row, its bars up to 1,440."""
    dated = "trading_date" in contracts.columns
    c = contracts.withColumnRenamed(symbol_col, "symbol")
    return payloads.join(c, ["symbol", "trading_date"] if dated else ["symbol"], "inner")


def options_bars(payloads: DataFrame, contracts: DataFrame, arrival: bool = False) -> DataFrame:
    """13-column options table. ``contracts``: Ticker, Underlying, Expiry, Strike,
    OptionType (+ trading_date to join per date). With ``arrival``, the bar's
    position in its response follows, for merges in which the first arrival wins."""
    bars = explode_bars(_answered(payloads, contracts, "Ticker"), 7,
                        ["Underlying", "Expiry", "Strike", "OptionType"])
    out = bars.select(
        F.col("symbol").alias("Ticker"), bar_date(F.col("wall")).alias("Date"),
        bar_time(F.col("wall")).alias("Time"),
        "Open", "High", "Low", "Close", "Volume", "OpenInterest",
        "Underlying", "Expiry", "Strike", "OptionType", F.col("pos").alias(ARRIVAL))
    return conform(out, OPTIONS_SCHEMA, [ARRIVAL] if arrival else [])


def futures_bars(payloads: DataFrame, contracts: DataFrame,
                 source_label: str = FUTURES_SOURCE_LABEL, arrival: bool = False) -> DataFrame:
    """12-column futures table. ``contracts``: symbol, ticker, contract_series,
    underlying (+ trading_date)."""
    bars = explode_bars(_answered(payloads, contracts, "symbol"), 7,
                        ["ticker", "contract_series", "underlying"])
    out = bars.select(
        F.col("ticker").alias("Ticker"), bar_date(F.col("wall")).alias("Date"),
        bar_time(F.col("wall")).alias("Time"),
        "Open", "High", "Low", "Close", "Volume", "OpenInterest",
        F.lit(source_label).alias("SourceFile"),
        F.col("underlying").alias("Underlying"),
        F.col("contract_series").alias("ContractSeries"), F.col("pos").alias(ARRIVAL))
    return conform(out, FUTURES_SCHEMA, [ARRIVAL] if arrival else [])


def first_spot_bars(payloads: DataFrame, index_of_symbol: DataFrame) -> DataFrame:
    """The spot bars kept, with the response they came from (symbol, trading_date):
    the first per (Index, timestamp) by day asked for and position."""
    bars = explode_bars(_answered(payloads, index_of_symbol, "symbol"), 6, ["Index"])
    bars = bars.select("Index", F.col("wall").alias("timestamp"), "symbol", "trading_date", "pos",
                       "Open", "High", "Low", "Close", "Volume")
    return keep_first(bars, ["Index", "timestamp"], ["trading_date", "pos"])


def spot_bars(payloads: DataFrame, index_of_symbol: DataFrame) -> DataFrame:
    """Spot table (Index + 6 columns), keep-first per (Index, timestamp) by
    payload position. ``index_of_symbol``: symbol, Index."""
    return conform(first_spot_bars(payloads, index_of_symbol), SPOT_SCHEMA)


def spot_rows_kept(payloads: DataFrame, index_of_symbol: DataFrame) -> DataFrame:
    """(trading_date, symbol, rows): bars of each response in the spot table."""
    return (first_spot_bars(payloads, index_of_symbol).groupBy("trading_date", "symbol")
            .agg(F.count(F.lit(1)).alias("rows")))


def rows_per_index(df: DataFrame, index: Column) -> DataFrame:
    """Rows of every index of a bar table."""
    return df.groupBy(index.alias("Index")).agg(F.count(F.lit(1)).alias("rows"))


def off_date_rows(bars: DataFrame) -> DataFrame:
    """Per day asked for: bars, and those whose own date is another day (a bar is
    filed under its own epoch's date). ``bars``: from ``explode_bars``."""
    return bars.groupBy("trading_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bar_date(F.col("wall")) != F.col("trading_date")).alias("off_date"))


__all__ = [
    "OK", "NO_DATA", "FAILED", "is_no_data", "response_outcome", "payload_outcomes",
    "explode_bars", "spot_rows_kept", "rows_per_index", "off_date_rows", "ARRIVAL", "options_bars", "futures_bars", "spot_bars", "conform",
    "OPTIONS_COLUMNS", "FUTURES_COLUMNS",
]
