"""Which contracts to collect: option discovery from chain payloads and
near/next/far futures from the symbol master. One DataFrame job covers every
index and every date at once."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketbars.functions.coerce import strike_to_int
from marketbars.functions.epochs import plausible_seconds, seconds_to_market_date, stripped_epoch_digits
from marketbars.functions.symbols import continuous_ticker, month_expiry, strip_ws
from marketbars.functions.timefmt import parse_dmy
from marketbars.operators.calendar import date_span
from marketbars.schemas import (
    FUT_SYMBOL_PATTERN, CONTRACT_SERIES, EXPIRY_WINDOW_DAYS, FUTURES_SPECS, OPTION_TYPES, UNDERLYINGS,
)


_SEP = "\u0001"
_BLANKS = r"[ \t\n\r\x0b\x0c]*"
_PART = "\u0002"
# a line: what stands before the first cell that is a symbol, the symbol's parts, the rest
_SYMBOL_LINE = (rf"(?s)^((?:.*?{_SEP})??){_BLANKS}{FUT_SYMBOL_PATTERN.strip('^$')}{_BLANKS}"
                rf"(?:{_SEP}.*)?\z")
_LAST_CELL = rf"([^{_SEP}]*){_SEP}\z"
_DIGIT_CELL = rf"(?:^|{_SEP}){_BLANKS}([0-9]+){_BLANKS}(?={_SEP}|\z)"


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


# ---------------------------------------------------------------- options ---

def expiry_items(listing: DataFrame) -> DataFrame:
    """Listing payloads (underlying, trading_date, data.expiryData) -> one row per
    listed expiry: underlying, trading_date, pos, date_text, epoch."""
    empty = F.array().cast("array<struct<date:string,expiry:string>>")
    x = listing.select("underlying", "trading_date",
                       F.posexplode(F.coalesce(F.col("data.expiryData"), empty)).alias("pos", "item"))
    return x.select("underlying", "trading_date", "pos",
                    F.col("item.date").alias("date_text"), F.col("item.expiry").alias("epoch"))


def expiry_targets(items: DataFrame, window_days: int = EXPIRY_WINDOW_DAYS) -> DataFrame:
    """Expiries to request per (underlying, trading_date).

    Keeps parseable ``d-M-yyyy`` dates with ``trading_date <= expiry <=
    trading_date + window_days`` and a non-empty epoch; when one date is listed
    twice the later entry (higher ``pos``) wins. Output: underlying,
    trading_date, expiry (DATE), epoch (STRING).
    """
    x = items.withColumn("expiry", parse_dmy(F.col("date_text")))
    days = F.datediff(F.col("expiry"), F.col("trading_date"))
    x = x.where(F.col("expiry").isNotNull() & (days >= 0) & (days <= window_days)
                & F.col("epoch").isNotNull() & (F.col("epoch") != ""))
    return (x.groupBy("underlying", "trading_date", "expiry")
             .agg(F.max_by("epoch", "pos").alias("epoch")))


def prefix_dim(spark: SparkSession, prefixes: dict[str, list[str]] | None = None) -> DataFrame:
    """underlying -> accepted symbol prefixes (upper case)."""
    if prefixes is None:
        prefixes = {k: v[2] for k, v in UNDERLYINGS.items()}
    return spark.createDataFrame([(k, v) for k, v in prefixes.items()],
                                 "underlying string, prefixes array<string>")


def chain_items(chains: DataFrame) -> DataFrame:
    """Per-expiry chain payloads (underlying, trading_date, requested_expiry, s,
    data.optionsChain) -> one row per option: ..., pos, symbol, option_type,
    strike_price (a response with an empty chain keeps one row with NULLs)."""
    x = chains.select("underlying", "trading_date", "requested_expiry", "s",
                      F.posexplode_outer(F.col("data.optionsChain")).alias("pos", "o"))
    return x.select("underlying", "trading_date", "requested_expiry", "s", "pos",
                    F.col("o.symbol").alias("symbol"), F.col("o.option_type").alias("option_type"),
                    F.col("o.strike_price").alias("strike_price"))


def tag_requested_expiry(items: DataFrame, targets: DataFrame) -> DataFrame:
    """Tag chain rows with the expiry that was requested (not a payload field)
    and keep ok responses. Non-ok responses are reported by ``failed_requests``."""
    t = targets.withColumnRenamed("epoch", "requested_expiry")
    return (items.join(t, ["underlying", "trading_date", "requested_expiry"], "inner")
                 .where(F.col("s") == "ok"))


def failed_requests(items: DataFrame) -> DataFrame:
    """Per-expiry requests the vendor rejected (one row per response)."""
    return (items.where(F.coalesce(F.col("s"), F.lit("")) != "ok")
                 .select("underlying", "trading_date", "requested_expiry").distinct())


def chain_rows(tagged: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Adds the parsed Strike and ``usable``: non-empty symbol, CE/PE, a strike
    that is present, not -1 and integral-convertible, and an upper-cased symbol
    starting with one of the index's prefixes (no prefixes: no filter)."""
    x = tagged.join(prefixes, "underlying", "left")
    sym, otype = F.col("symbol"), F.col("option_type")
    strike = strike_to_int(F.col("strike_price"))
    up = F.upper(sym)
    pref = F.coalesce(F.col("prefixes"), F.array().cast("array<string>"))
    prefix_ok = (F.size(pref) == 0) | F.exists(pref, lambda p: up.startswith(p))
    usable = (sym.isNotNull() & (sym != "") & otype.isin(*OPTION_TYPES)
              & strike.isNotNull() & prefix_ok)
    present = sym.isNotNull() | otype.isNotNull() | F.col("strike_price").isNotNull()
    return x.select("underlying", "trading_date", "expiry", "pos",
                    sym.alias("Ticker"), otype.alias("OptionType"), strike.alias("Strike"),
                    present.alias("present"), F.coalesce(usable, F.lit(False)).alias("usable"))


def option_contracts(rows: DataFrame) -> DataFrame:
    """One contract per (underlying, trading_date, Ticker); a later expiry
    request overwrites an earlier one, and within one response the later row
    wins. Output: trading_date, Ticker, Underlying, Expiry, Strike, OptionType."""
    u = rows.where("usable")
    best = (u.groupBy("underlying", "trading_date", "Ticker")
             .agg(F.max_by(F.struct("expiry", "Strike", "OptionType"),
                           F.struct("expiry", "pos")).alias("c")))
    return best.select("trading_date", "Ticker", F.col("underlying").alias("Underlying"),
                       F.col("c.expiry").alias("Expiry"), F.col("c.Strike").alias("Strike"),
                       F.col("c.OptionType").alias("OptionType"))


DISCOVERED, NO_EXPIRIES, NO_CONTRACTS = "ok", "no_expiries", "no_contracts"


def discovery_status(index_days: DataFrame, targets: DataFrame, contracts: DataFrame,
                     failed: DataFrame | None = None) -> DataFrame:
    """Per (underlying, trading_date) of the run: expiries inside the window,
    contracts kept, rejected per-expiry requests and the status: no expiry in
    the window, no usable contract, or ok (the non-empty guards, as rows).

    ``index_days``: underlying, trading_date (the indexes and days the run was
    asked for); ``failed``: one row per rejected request.
    """
    keys = ["underlying", "trading_date"]
    # one tagged union and one grouped count instead of a count and a join per input
    parts = [targets.select(*keys, F.lit("e").alias("_kind")),
             contracts.select(F.col("Underlying").alias("underlying"), "trading_date", F.lit("c").alias("_kind"))]
    if failed is not None:
        parts.append(failed.select(*keys, F.lit("f").alias("_kind")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    kind = F.col("_kind")
    counts = u.groupBy(*keys).agg(F.count_if(kind == "e").alias("expiries"),
                                  F.count_if(kind == "c").alias("contracts"),
                                  F.count_if(kind == "f").alias("failed_requests"))
    j = index_days.select(*keys).distinct().join(counts, keys, "left")
    e = F.coalesce(F.col("expiries"), F.lit(0)).cast("bigint")
    n = F.coalesce(F.col("contracts"), F.lit(0)).cast("bigint")
    status = (F.when(e == 0, F.lit(NO_EXPIRIES)).when(n == 0, F.lit(NO_CONTRACTS))
               .otherwise(F.lit(DISCOVERED)))
    return j.select(*keys, e.alias("expiries"), n.alias("contracts"),
                    F.coalesce(F.col("failed_requests"), F.lit(0)).cast("bigint").alias("failed_requests"),
                    status.alias("status"))


def discovery_outcomes(discovery: DataFrame) -> DataFrame:
    """A discovery that found nothing to fetch is one failed options outcome
    of its day (no contract is counted for it)."""
    return (discovery.where(F.col("status") != DISCOVERED)
                     .select(F.col("trading_date").alias("date"), F.lit("options").alias("kind"),
                             F.lit(None).cast("string").alias("symbol"), F.lit("failed").alias("outcome"),
                             F.lit(0).cast("bigint").alias("rows")))


def expiry_stats(rows: DataFrame) -> DataFrame:
    """Per requested expiry: usable rows (duplicates included) and raw rows."""
    return (rows.groupBy("underlying", "trading_date", "expiry")
                .agg(F.count_if("usable").alias("usable"),
                     F.count_if("present").alias("raw")))


def contracts_per_expiry(contracts: DataFrame) -> DataFrame:
    return contracts.groupBy("Underlying", "Expiry").agg(F.count(F.lit(1)).alias("contracts"))


# ---------------------------------------------------------------- futures ---

def futures_spec_dim(spark: SparkSession, specs: dict | None = None) -> DataFrame:
    specs = FUTURES_SPECS if specs is None else specs
    return spark.createDataFrame([(k, r, e, s) for k, (r, e, s) in specs.items()],
                                 "underlying string, root string, exchange string, segment string")


def master_candidates(cells: DataFrame, specs: DataFrame | None = None) -> DataFrame:
    """Symbol-master rows (``cells`` array<string>) -> FUT symbol, parts and
    expiry by the fallback chain: the cell before the symbol, else the first
    cell holding a plausible epoch, else the symbol's month. Rows without a
    symbol or an expiry are dropped. Other input columns are passed through.

    The row is joined to one line, on which a compiled regular expression finds
    the first symbol cell and what stands before it. ``specs`` (root, exch and
    columns to add): only these roots on their exchanges are kept, before any
    epoch is read; the epochs are then parsed for the rows that are left.
    """
    extra = [c for c in cells.columns if c != "cells"]
    line = F.array_join("cells", _SEP, "")
    # one pass of the pattern a line gives what stands before the symbol and the symbol's
    # parts; a line without a symbol stays as it is, in one part. Generated rows, so that
    # the filter isn't pushed below the pattern, which would run it again
    parts = F.split(F.regexp_replace("line", _SYMBOL_LINE, _PART.join(("$1", "$2", "$3", "$4", "$5"))), _PART)
    p = F.col("p")
    b = (cells.select(*extra, F.translate(line, _PART, "\u0003").alias("line"))
         .where(F.col("line").contains("FUT"))
         .select(*extra, "line", F.explode(F.array(parts)).alias("p")).where(F.size("p") == 5)
         .select(*extra, "line", p[0].alias("before"), F.concat(p[1], F.lit(":"), p[2], p[3], p[4], F.lit("FUT"))
                 .alias("symbol"), p[1].alias("exch"), p[2].alias("root"), p[3].alias("yy"), p[4].alias("mon")))
    more = []
    if specs is not None:
        more = [c for c in specs.columns if c not in ("root", "exch")]
        b = b.join(specs, ["root", "exch"], "inner")
    preceding = plausible_seconds(stripped_epoch_digits(
        strip_ws(F.regexp_extract("before", _LAST_CELL, 1))))
    anywhere = F.try_element_at(F.filter(
        F.transform(F.regexp_extract_all("line", F.lit(_DIGIT_CELL), F.lit(1)),
                    lambda t: plausible_seconds(t.try_cast("bigint"))),
        lambda x: x.isNotNull()), F.lit(1))
    n_before = F.length("before") - F.length(F.replace(F.col("before"), F.lit(_SEP), F.lit("")))
    expiry = F.coalesce(seconds_to_market_date(F.coalesce(preceding, anywhere)),
                        month_expiry(F.col("yy"), F.col("mon")))
    return (b.select(*extra, *more, "symbol", (n_before + 1).cast("int").alias("symbol_pos"),
                     "exch", "root", expiry.alias("expiry"))
            .where(F.col("expiry").isNotNull()))


def resolve_futures(cells: DataFrame, trading_date, specs: DataFrame,
                    count: int = len(CONTRACT_SERIES)) -> DataFrame:
    """Near/next/far contracts per index for ``trading_date``.

    Exact root and exchange match (NIFTY != BANKNIFTY), expired contracts
    dropped, the earliest expiry kept per symbol, then the ``count`` nearest by
    (expiry, symbol) labelled I, II, III. Output: underlying, symbol, ticker,
    contract_series, expiry, rank.
    """
    d = _date_lit(trading_date)
    c = master_candidates(cells, specs.select("underlying", "root",
                                              F.col("exchange").alias("exch")))
    c = c.where(F.col("expiry") >= d)
    per_symbol = c.groupBy("underlying", "root", "symbol").agg(F.min("expiry").alias("expiry"))
    w = Window.partitionBy("underlying").orderBy(F.col("expiry").asc(), F.col("symbol").asc())
    ranked = per_symbol.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= count)
    labels = F.array(*[F.lit(s) for s in CONTRACT_SERIES[:count]])
    series = F.try_element_at(labels, F.col("rank"))
    return ranked.select("underlying", "symbol",
                         continuous_ticker(F.col("root"), series).alias("ticker"),
                         series.alias("contract_series"), "expiry", "rank")


def resolve_futures_range(cells: DataFrame, trading_dates: DataFrame, specs: DataFrame,
                          count: int = len(CONTRACT_SERIES)) -> DataFrame:
    """Near/next/far per index for every date of ``trading_dates`` (column
    ``trading_date``) in one job, with the same result as ``resolve_futures``
    run date by date.

    For a date d a symbol counts with its earliest expiry on or after d. Take
    all (symbol, expiry) pairs of an index sorted by (expiry, symbol): the
    answer for d is the first ``count`` distinct symbols of the suffix that
    starts at the first expiry >= d. So a pair can only be in the answer for
    the dates after (a) the previous expiry of its own symbol and (b) the
    expiry at which ``count`` other distinct symbols lie between it and the
    suffix start. (b) is found with window functions over symbol runs (a run
    is a stretch of consecutive pairs of one symbol; the third distinct
    symbol back is the last run before a two-symbol alternation). Each pair
    emits only those dates, so at most ``count`` rows per index and date are
    generated: no pairing of every date with every symbol.

    The windows are per index over its distinct contracts (a few dozen
    listed futures). Output: underlying, trading_date, symbol, ticker,
    contract_series, expiry, rank.
    """
    if count != 3:
        raise ValueError("the run/alternation bound is written for three series")
    c = master_candidates(cells, specs.select("underlying", "root",
                                              F.col("exchange").alias("exch")))
    span = trading_dates.agg(F.min("trading_date").alias("lo"), F.max("trading_date").alias("hi")).first()
    if span["lo"] is None:
        return trading_dates.sparkSession.createDataFrame(
            [], "underlying string, trading_date date, symbol string, ticker string, "
                "contract_series string, expiry date, rank int")
    lo, hi = F.lit(span["lo"]), F.lit(span["hi"])
    # pairs expiring before the range never count on a date of the range, and
    # they are never between a later pair and a suffix start inside the range
    pairs = (c.where(F.col("expiry") >= lo)
              .select("underlying", "root", "symbol", "expiry").distinct())
    by_index = Window.partitionBy("underlying").orderBy("expiry", "symbol")
    upto = by_index.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new_run = F.coalesce(F.lag("symbol").over(by_index) != F.col("symbol"), F.lit(True))
    pairs = (pairs
             .withColumn("prev", F.lag("expiry").over(
                 Window.partitionBy("underlying", "symbol").orderBy("expiry")))
             .withColumn("run", F.sum(new_run.cast("int")).over(upto)))
    # one row per run: its symbol and last expiry
    runs = (pairs.groupBy("underlying", "run", F.col("symbol").alias("run_symbol"))
                 .agg(F.max("expiry").alias("last_e")))
    by_run = Window.partitionBy("underlying").orderBy("run")
    alternates = F.coalesce(F.col("run_symbol") == F.lag("run_symbol", 2).over(by_run), F.lit(False))
    # for run r: last expiry of the latest run before the alternation that ends
    # at r (NULL inside the struct when that run does not exist)
    third = F.last(F.when(~alternates, F.struct(F.lag("last_e", 2).over(by_run).alias("z"))),
                   ignorenulls=True).over(by_run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = runs.withColumn("z_run", third["z"])
    runs = runs.select("underlying", "run", F.lag("z_run").over(by_run).alias("z"))
    pairs = pairs.join(runs, ["underlying", "run"], "inner")
    after = F.greatest(F.col("prev"), F.col("z"))          # NULLs are ignored
    first_day = F.greatest(F.coalesce(F.date_add(after, 1), lo), lo)
    last_day = F.least(F.col("expiry"), hi)
    active = pairs.select("underlying", "root", "symbol", "expiry",
                          F.explode(date_span(first_day, last_day)).alias("trading_date"))
    active = active.join(trading_dates.select("trading_date").distinct(), "trading_date", "left_semi")
    w = Window.partitionBy("underlying", "trading_date").orderBy(F.col("expiry").asc(), F.col("symbol").asc())
    ranked = active.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= count)
    labels = F.array(*[F.lit(x) for x in CONTRACT_SERIES[:count]])
    series = F.try_element_at(labels, F.col("rank"))
    return ranked.select("underlying", "trading_date", "symbol",
                         continuous_ticker(F.col("root"), series).alias("ticker"),
                         series.alias("contract_series"), "expiry", "rank")


def unresolved_indexes(specs: DataFrame, resolved: DataFrame) -> DataFrame:
    """Configured indexes with no active contract, with the reason."""
    return (specs.join(resolved.select("underlying").distinct(), "underlying", "left_anti")
                 .select("underlying", F.lit("no active futures on or after the date").alias("reason")))


def unresolved_by_day(days: DataFrame, specs: DataFrame, resolved: DataFrame) -> DataFrame:
    """(trading_date, underlying, reason) of the indexes that a run has to skip.
    The configured indexes are a short list: each day is exploded into them."""
    names = specs.agg(F.sort_array(F.collect_set("underlying"))).scalar()
    wanted = days.select("trading_date", F.explode(names).alias("underlying"))
    return (wanted.join(resolved.select("trading_date", "underlying").distinct(),
                        ["trading_date", "underlying"], "left_anti")
            .select("trading_date", "underlying",
                    F.lit("no active futures on or after the date").alias("reason")))
