"""Ingest ledger ("which dates are already in a target") and the per-(target,
date) reconcile decision, computed for all targets and dates in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALREADY = "already_ingested"
EMPTY = "empty_source"
MISMATCH = "mismatch"
REPAIRED = "sidecar_repaired"
REPAIR_NEEDED = "sidecar_repair_needed"
MISSING_TARGET = "missing_target"
NOT_PRESENT = "not_present"
DRY_RUN = "dry_run"
CREATED = "created"
UPDATED = "updated"
UNDATED = "undated"              # rows without a date: quarantined
UNROUTED = "unrouted"            # rows that no target takes: dead letters
RELEASED = "released"            # quarantined rows, accepted and merged


def parse_ledger(ledger: DataFrame, text_col: str = "dates_json") -> DataFrame:
    """(target, dates_json) -> distinct (target, date) strings.

    Missing, malformed or non-list JSON reads as an empty set.
    """
    arr = F.coalesce(F.from_json(F.col(text_col), "array<string>"), F.array().cast("array<string>"))
    return (ledger.select("target", F.explode(arr).alias("date"))
                  .where(F.col("date").isNotNull()).distinct())


def ledger_todo(incoming: DataFrame, ledger_dates: DataFrame) -> DataFrame:
    """Incoming (target, date) rows not yet in the ledger."""
    return incoming.join(ledger_dates, ["target", "date"], "left_anti")


def ledger_done(incoming: DataFrame, ledger_dates: DataFrame) -> DataFrame:
    """Incoming (target, date) rows already in the ledger."""
    return incoming.join(ledger_dates, ["target", "date"], "left_semi")


def dump_ledger(ledger_dates: DataFrame) -> DataFrame:
    """(target, date) -> (target, dates_json) with sorted distinct dates."""
    quoted = F.transform(F.array_sort(F.collect_set("date")),
                         lambda d: F.concat(F.lit('"'), d, F.lit('"')))
    # same text as a sorted JSON list with ", " separators
    return (ledger_dates.groupBy("target")
            .agg(F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")).alias("dates_json")))


def reconcile(incoming_counts: DataFrame, history_counts: DataFrame,
              ledger_dates: DataFrame, targets: DataFrame | None = None,
              dry_run: bool = False, repair: bool = False,
              repair_only: bool = False) -> DataFrame:
    """Decision per (target, date), first matching rule wins:

    1 in ledger -> already_ingested; 2 no incoming rows -> empty_source;
    3 target has h>0 rows for the date and h != n -> mismatch (refuse);
    4 h == n -> sidecar_repaired (repair and not dry run) else sidecar_repair_needed;
    5 repair-only: no target -> missing_target, else not_present;
    6 dry run -> dry_run; 7 created (no target yet) or updated.

    incoming_counts: target, date, incoming_rows. history_counts: target, date,
    history_rows. ledger_dates: target, date. targets: target (existing
    targets; defaults to the targets that have history rows).
    """
    keys = ["target", "date"]
    none = F.lit(None).cast("bigint")
    # the full outer join of the two counts and the ledger lookup as one tagged
    # union and one grouped aggregate (a single shuffle on (target, date));
    # ledger-only dates are not facts of this run and are dropped
    parts = [incoming_counts.select(*keys, F.col("incoming_rows").cast("bigint").alias("n"),
                                    none.alias("h"), F.lit(False).alias("led"), F.lit(True).alias("fact")),
             history_counts.select(*keys, none.alias("n"), F.col("history_rows").cast("bigint").alias("h"),
                                   F.lit(False).alias("led"), F.lit(True).alias("fact")),
             ledger_dates.select(*keys, none.alias("n"), none.alias("h"),
                                 F.lit(True).alias("led"), F.lit(False).alias("fact"))]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    facts = (u.groupBy(*keys)
              .agg(F.sum("n").alias("incoming_rows"), F.sum("h").alias("history_rows"),
                   F.bool_or("led").alias("in_ledger"), F.bool_or("fact").alias("fact"))
              .where("fact"))
    if targets is None:
        targets = history_counts.select("target")
    exists = targets.select("target").distinct().withColumn("target_exists", F.lit(True))
    facts = facts.join(exists, "target", "left")
    n = F.coalesce(F.col("incoming_rows"), F.lit(0)).cast("bigint")
    h = F.coalesce(F.col("history_rows"), F.lit(0)).cast("bigint")
    t = F.coalesce(F.col("target_exists"), F.lit(False))
    in_ledger = F.coalesce(F.col("in_ledger"), F.lit(False))
    repair_status = F.lit(REPAIRED if (repair and not dry_run) else REPAIR_NEEDED)
    status = (F.when(in_ledger, F.lit(ALREADY))
               .when(n == 0, F.lit(EMPTY))
               .when(t & (h > 0) & (h != n), F.lit(MISMATCH))
               .when(t & (h > 0), repair_status))
    if repair_only:
        status = status.when(~t, F.lit(MISSING_TARGET)).otherwise(F.lit(NOT_PRESENT))
    elif dry_run:
        status = status.otherwise(F.lit(DRY_RUN))
    else:
        status = status.when(~t, F.lit(CREATED)).otherwise(F.lit(UPDATED))
    return facts.select("target", "date", n.alias("incoming_rows"), h.alias("history_rows"),
                        t.alias("target_exists"), in_ledger.alias("in_ledger"),
                        status.alias("status"))


def repaired_ledger(ledger_dates: DataFrame, decisions: DataFrame,
                    statuses=(REPAIRED, CREATED, UPDATED)) -> DataFrame:
    """Ledger after recording the decided dates: (target, dates_json)."""
    add = decisions.where(F.col("status").isin(*statuses)).select("target", "date")
    return dump_ledger(ledger_dates.select("target", "date").unionByName(add))
