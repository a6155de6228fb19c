"""Build a run's typed tables from landed payloads: every date of a backfill
in one job (calendar filter, contract discovery and resolution, flattening,
outcome counters), then exchange-split, date-partitioned outputs.

Inputs are DataFrames of landed responses (see ``sources.readers``):
option/futures/spot history payloads (BAR_PAYLOAD_SCHEMA), chain listings and
per-expiry chains (CHAIN_PAYLOAD_SCHEMA), and symbol-master cells.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.operators import bars as B
from marketbars.operators import contracts as C
from marketbars.operators.calendar import TRADING, classify_days, date_span, holidays
from marketbars.operators.quality import quality_report
from marketbars.operators.report import (
    KINDS, date_status, expected_kinds, outcome_counts, pending_kinds,
)
from marketbars.operators.routing import exchange_dim, route_exchange
from marketbars.schemas import (
    DEFAULT_UNDERLYINGS, FUTURES_COLUMNS, FUTURES_SOURCE_LABEL, OPTIONS_COLUMNS, UNDERLYINGS,
)
from marketbars.session import written_once
from marketbars.sinks.journal import staging_path
from marketbars.sinks.writers import PART_COL, stage_and_publish
from marketbars.sources.catalog import index_dim
from marketbars.sources.readers import partition_counts, partition_dirs, valid_table


def run_dates(spark: SparkSession, start: str, end: str, holiday_table: DataFrame | None = None) -> DataFrame:
    """Calendar of the run with its status (weekend / holiday / trading)."""
    s, e = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    if e < s:
        raise ValueError("end date cannot be before start date")
    dates = spark.range(1).select(F.explode(date_span(F.lit(s), F.lit(e))).alias("date"))
    return classify_days(dates, holiday_table if holiday_table is not None else holidays(spark))


def trading_dates(spark: SparkSession, start: str, end: str, holiday_table: DataFrame | None = None) -> DataFrame:
    return (run_dates(spark, start, end, holiday_table).where(F.col("status") == TRADING)
            .select(F.col("date").alias("trading_date")))


def _only(df: DataFrame, col: str, selected: Sequence[str] | None) -> DataFrame:
    return df if not selected else df.where(F.col(col).isin(*selected))


def build_run(spark: SparkSession, *, start: str, end: str,
              option_payloads: DataFrame, futures_payloads: DataFrame, spot_payloads: DataFrame,
              chain_listing: DataFrame, chains: DataFrame, master_cells: DataFrame,
              selected: Sequence[str] | None = None,
              source_label: str = FUTURES_SOURCE_LABEL,
              pending: DataFrame | None = None, keep_answers: bool = False) -> dict[str, DataFrame]:
    """All tables of a run. ``selected`` restricts every kind to those indexes, in
    the tables and in the counters. ``pending`` (trading_date, kind; see
    ``pending_work``): the days still to be collected of each kind; default all.
    ``keep_answers``: the run's parsed answers, contracts and futures are written once to
    the shared folder, and tables, outcomes and counts read them there: for a run that
    uses several of its tables."""
    keep = written_once if keep_answers else (lambda df, name: df)
    if selected:
        unknown = set(selected) - set(UNDERLYINGS)
        if unknown:
            raise ValueError(f"unknown underlyings: {sorted(unknown)}")
    days = trading_dates(spark, start, end)
    work = expected_kinds(days).withColumnRenamed("date", "trading_date")
    if pending is not None:
        work = work.join(pending.select("trading_date", "kind").distinct(),
                         ["trading_date", "kind"], "left_semi")
    days_of = {k: work.where(F.col("kind") == k).select("trading_date") for k in KINDS}
    first, last = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)

    def on_days(df: DataFrame, kind: str) -> DataFrame:
        # the literal range reaches the scan; the join drops days within it
        return (df.where(F.col("trading_date").between(first, last))
                .join(days_of[kind], "trading_date", "left_semi"))

    # options: expiry targets -> per-expiry chains -> contracts of each (index, date)
    targets = C.expiry_targets(on_days(_only(C.expiry_items(chain_listing), "underlying", selected),
                                       "options"))
    items = on_days(_only(C.chain_items(chains), "underlying", selected), "options")
    rows = C.chain_rows(C.tag_requested_expiry(items, targets), C.prefix_dim(spark))
    contracts = keep(C.option_contracts(rows), "contracts")
    option_answers = keep(on_days(option_payloads, "options"), "option-answers")
    options = B.options_bars(option_answers, contracts)

    # futures: near/next/far per (index, date), then bars of those symbols
    specs = _only(C.futures_spec_dim(spark), "underlying", selected)
    fut_contracts = keep(C.resolve_futures_range(master_cells, days_of["futures"], specs), "futures")
    future_answers = keep(on_days(futures_payloads, "futures"), "future-answers")
    futures = B.futures_bars(future_answers, fut_contracts, source_label)

    # spot: vendor index symbol -> index
    idx = _only(index_dim(spark), "index", selected).select("symbol", F.col("index").alias("Index"))
    spot_answers = keep(on_days(spot_payloads, "spot"), "spot-answers")
    spot = B.spot_bars(spot_answers, idx)

    # one discovery row per requested index and trading day (a generator over
    # the fixed index list, no join): days without expiries or contracts fail
    wanted = list(selected) if selected else list(DEFAULT_UNDERLYINGS)
    index_days = days_of["options"].select(
        "trading_date", F.explode(F.array(*[F.lit(u) for u in wanted])).alias("underlying"))
    discovery = C.discovery_status(index_days, targets, contracts, C.failed_requests(items))
    spot_symbols = [UNDERLYINGS[u][0] for u in (selected or UNDERLYINGS)]
    spot_asked = days_of["spot"].select(
        "trading_date", F.explode(F.array(*[F.lit(x) for x in spot_symbols])).alias("symbol"))

    # counted over what was asked for, and over the rows that the tables keep
    outcomes = (B.payload_outcomes(option_answers, "options", 7,
                                   contracts.select("trading_date", F.col("Ticker").alias("symbol")))
                .unionByName(C.discovery_outcomes(discovery))
                .unionByName(B.payload_outcomes(future_answers, "futures", 7,
                                                fut_contracts.select("trading_date", "symbol")))
                .unionByName(B.payload_outcomes(spot_answers, "spot", 6, spot_asked,
                                                B.spot_rows_kept(spot_answers, idx))))
    counts = outcome_counts(outcomes)
    off_date = (B.off_date_rows(B.explode_bars(option_answers, 7)).withColumn("kind", F.lit("options"))
                .unionByName(B.off_date_rows(B.explode_bars(future_answers, 7))
                             .withColumn("kind", F.lit("futures")))
                .unionByName(B.off_date_rows(B.explode_bars(spot_answers, 6))
                             .withColumn("kind", F.lit("spot"))))
    return {"options": options, "futures": futures, "spot": spot, "contracts": contracts,
            "futures_contracts": fut_contracts, "expiry_stats": C.expiry_stats(rows),
            "discovery": discovery, "outcomes": outcomes, "counts": counts,
            "unresolved": C.unresolved_by_day(days_of["futures"], specs, fut_contracts),
            "spot_rows": B.rows_per_index(spot, F.col("Index")), "off_date": off_date,
            "status": date_status(counts, work.withColumnRenamed("trading_date", "date"))}


class ValidationError(RuntimeError):
    pass


def options_verdicts(routed: DataFrame) -> DataFrame:
    """The quality verdict of every (exchange, date) subset, one row each."""
    return quality_report(routed.select(*OPTIONS_COLUMNS, "exchange"), group_by=["exchange", "Date"])


def check_options_split(routed: DataFrame) -> DataFrame:
    """Verdict per (exchange, date) subset; raises when a subset fails or when
    no exchange has any row. Only verdict rows reach the driver."""
    rep = options_verdicts(routed)
    verdicts = rep.select("exchange", "Date", "rows", "ok", "errors").collect()
    if not verdicts:
        raise ValidationError("no options rows to save for any exchange")
    bad = [v for v in verdicts if not v["ok"]]
    if bad:
        raise ValidationError("; ".join(f"{v['exchange']} {v['Date']}: {', '.join(v['errors'])}" for v in bad))
    return rep


WRITTEN_SCHEMA = "kind string, exchange string, date date, rows bigint, status string, message string"


def _write_options(spark: SparkSession, options: DataFrame, out_dir: str, validate: bool) -> list:
    """Stage all subsets, judge the staged rows, publish the subsets that pass."""
    routed = route_exchange(options, exchange_dim(spark))
    target, verdicts = f"{out_dir}/options", []

    def passed(staging: str) -> list[tuple[str, str]]:
        staged = spark.read.parquet(staging).drop(PART_COL)
        # a few exchanges times the days of the run
        verdicts.extend(options_verdicts(staged).select("exchange", "Date", "rows", "ok", "errors").collect())
        return [(f"exchange={v['exchange']}", f"{PART_COL}={v['Date']}")
                for v in verdicts if v["ok"] or not validate]
    if not stage_and_publish(
            spark, routed.select(*OPTIONS_COLUMNS, "exchange", F.col("Date").alias(PART_COL)),
            staging_path(spark, target, "options"), target, ["exchange", PART_COL],
            ["Underlying", "Expiry", "Strike", "OptionType", "Time"], only=passed):
        return [("options", None, None, 0, "empty", "no options rows for any exchange")]
    return [("options", v["exchange"], v["Date"], v["rows"],
             "written" if v["ok"] or not validate else "invalid", "; ".join(v["errors"]) or None)
            for v in verdicts]


def _write_days(spark: SparkSession, kind: str, rows: DataFrame, date, out_dir: str,
                partition_by, sort_within, fmt: str) -> list:
    dated = rows.withColumn(PART_COL, date)
    target = f"{out_dir}/{kind}"
    places: list[str] = []
    if not stage_and_publish(spark, dated, staging_path(spark, target, kind), target, partition_by,
                             sort_within, fmt, places=places):
        return [(kind, None, None, 0, "empty", f"no {kind} rows")]
    days: dict[str | None, int] = {}        # of all indexes, from the published files
    for *_, day, n in partition_counts(spark, target, places, partition_by, fmt):
        days[day] = days.get(day, 0) + n
    return [(kind, None, None if day is None else _dt.date.fromisoformat(day), n, "written", None)
            for day, n in sorted(days.items(), key=str)]


def write_outputs(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str,
                  validate: bool = True) -> DataFrame:
    """Options split by exchange and date, futures by date (Parquet, zstd);
    spot by index and date (CSV). Only the dates present are replaced.

    Every subset stands alone: with ``validate``, an options (exchange, date) subset
    that fails the quality report is not written, and the others are; a kind that
    fails does not keep the others from being written. Returns one row per
    subset: kind, exchange, date, rows, status (written, invalid, empty, error),
    message.
    """
    writers = {
        "options": lambda: _write_options(spark, tables["options"], out_dir, validate),
        "futures": lambda: _write_days(spark, "futures", tables["futures"], F.col("Date"), out_dir,
                                       [PART_COL], ["Underlying", "ContractSeries", "Time"], "parquet"),
        "spot": lambda: _write_days(spark, "spot", tables["spot"], F.to_date("timestamp"), out_dir,
                                    ["Index", PART_COL], ["timestamp"], "csv"),
    }
    out = []
    for kind, write in writers.items():
        try:
            out += write()
        except Exception as error:  # noqa: BLE001 - isolate this kind
            out.append((kind, None, None, None, "error", str(error)))
    return spark.createDataFrame(out, WRITTEN_SCHEMA)


def _valid_day(spark: SparkSession, path: str, columns: Sequence[str]) -> bool:
    """One day's files: readable, the exact columns, not empty."""
    try:
        return valid_table(spark.read.parquet(path), columns)
    except Exception:  # noqa: BLE001 - unreadable files are collected again
        return False


def produced_work(spark: SparkSession, out_dir: str, start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """(trading_date, kind, exchange, valid) of the outputs within ``start``..``end``.

    Only the ``exchange=`` and ``trade_date=`` directories are listed, and of the
    days in the range the footers and one row are read, so the check does not
    grow with the stored history.
    """
    def days(base: str) -> dict[str, str]:
        return {day: path for day, path in (partition_dirs(spark, base, PART_COL) or {}).items()
                if (start is None or day >= start) and (end is None or day <= end)}
    out = []
    for exchange, base in (partition_dirs(spark, f"{out_dir}/options", "exchange") or {}).items():
        out += [(_dt.date.fromisoformat(day), "options", exchange,
                 _valid_day(spark, path, OPTIONS_COLUMNS)) for day, path in days(base).items()]
    out += [(_dt.date.fromisoformat(day), "futures", None, _valid_day(spark, path, FUTURES_COLUMNS))
            for day, path in days(f"{out_dir}/futures").items()]
    for index, base in (partition_dirs(spark, f"{out_dir}/spot", "Index") or {}).items():
        out += [(_dt.date.fromisoformat(day), "spot", index, True) for day in days(base)]
    return spark.createDataFrame(out, "trading_date date, kind string, exchange string, valid boolean")


def pending_work(spark: SparkSession, start: str, end: str, out_dir: str) -> DataFrame:
    """(trading_date, kind) of the range that still need collecting."""
    return pending_kinds(trading_dates(spark, start, end), produced_work(spark, out_dir, start, end),
                         exchange_dim(spark).select("exchange"), index_dim(spark).select("index"))


def completed_dates(spark: SparkSession, out_dir: str, start: str | None = None,
                    end: str | None = None) -> DataFrame:
    """Dates (within ``start``..``end``) whose options output is valid for every exchange."""
    produced = produced_work(spark, out_dir, start, end)
    days = produced.select("trading_date").distinct()
    pending = pending_kinds(days, produced, exchange_dim(spark).select("exchange"),
                            index_dim(spark).select("index"))
    return days.join(pending.where("kind = 'options'"), "trading_date", "left_anti")


def pending_dates(spark: SparkSession, start: str, end: str, out_dir: str) -> DataFrame:
    """Trading dates of the range whose options still need collecting."""
    return (pending_work(spark, start, end, out_dir).where("kind = 'options'")
            .select("trading_date"))
