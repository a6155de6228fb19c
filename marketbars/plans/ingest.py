"""Idempotent ingest of new bar rows into date-partitioned histories.

One job decides every (target, date) of the incoming rows (ledger check,
count reconcile), merges only the affected history partitions (existing rows
win, then the first arrival), stages and verifies them, publishes them under a journal,
and only then records the dates in the ledger. Before anything is read, what a crash
has left of an earlier publish is finished, its dates recorded, or taken back. A ledger that
lacks a day that history holds is detected ("rows present, ledger missing") and repaired.
Rows that can't be merged (no date, or a day that history holds differently) go to
quarantine, from which ``release`` takes them back, and rows that no target takes to the
dead letters: no incoming row is dropped without a row in the decisions and a copy on disk.

``ingest`` serves one target, ``ingest_targets`` any number of them in one table of
histories partitioned by target and day: one reconcile, one merge, one write.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.operators import ledger as L
from marketbars.operators.merge import merge_first_wins, resolve_keys
from marketbars.operators.routing import row_date
from marketbars.sinks import ledger_log
from marketbars.sinks.journal import recover, staging_path
from marketbars.sinks.storage import Storage, partitions
from marketbars.sinks.writers import PART_COL, archive_raw, stage_and_publish, write_parquet
from marketbars.sources.readers import (
    ARRIVAL, partition_counts, partition_dirs, path_exists, read_ledger,
)

TARGET = "target"
POSITION = "_position"          # a row's place in the incoming frame
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _as_dates(values):
    return [_dt.date.fromisoformat(v) for v in values if v is not None]


def conform_to(incoming: DataFrame, types: T.StructType, keep: Sequence[str]) -> DataFrame:
    """``incoming`` cast to the declared or stored types; columns that those don't
    have stay as they are, ``keep`` too."""
    declared = {f.name: f.dataType for f in types.fields if f.name not in keep}
    return incoming.select(*[F.col(c).cast(declared[c]).alias(c) if c in declared else F.col(c)
                             for c in incoming.columns])


def ingest(spark: SparkSession, incoming: DataFrame, history_path: str, ledger_path: str,
           target: str, keys: Sequence[str], dry_run: bool = False, repair: bool = False,
           repair_only: bool = False, archive_path: str | None = None,
           sort_within: Sequence[str] = (), date_of: Column | None = None,
           quarantine_path: str | None = None, order_by: Sequence[str] | None = None,
           schema: T.StructType | None = None, fmt: str = "parquet",
           merge_ledgered: bool = False, batch_id: str | None = None,
           accept: bool = False) -> DataFrame:
    """Ingest ``incoming`` into ``history_path``; returns one decision row per date.

    ``date_of``: the row's date (default: ``Date``, else the date of ``timestamp``).
    ``order_by``: columns that give the order of arrival; they are dropped on write.
    Default: ``ARRIVAL`` (see ``with_arrival``) if there, else the position of the row in
    the incoming frame.
    ``schema``: types to conform to (default: those of the history).
    ``merge_ledgered``: rows of a date that the ledger has are merged by key too
    (status ``updated`` if that adds rows): for streams, where a day can come in
    several batches.
    ``accept``: rows of a date that history holds differently are merged by key too
    (status ``released``): for quarantined rows that were judged right.
    ``quarantine_path`` (default: beside the history): incoming rows without a date
    (status ``undated``), and those of a date refused as ``mismatch`` (the history
    holds another number of rows for it), are written there under target, batch
    and date, with the reason and their order of arrival. ``batch_id`` names the batch:
    unique for every run unless given; a batch that is replayed under its name replaces
    its own rows and no others. History is untouched.
    """
    return _run(spark, incoming, history_path, ledger_path, target, keys, dry_run, repair,
                repair_only, archive_path, sort_within, date_of, quarantine_path, None, order_by,
                schema, fmt, merge_ledgered, batch_id, accept)


def ingest_targets(spark: SparkSession, incoming: DataFrame, history_path: str, ledger_path: str,
                   keys: Sequence[str], dry_run: bool = False, repair: bool = False,
                   repair_only: bool = False, archive_path: str | None = None,
                   sort_within: Sequence[str] = (), date_of: Column | None = None,
                   quarantine_path: str | None = None, dead_letter_path: str | None = None,
                   order_by: Sequence[str] | None = None, schema: T.StructType | None = None,
                   fmt: str = "parquet", merge_ledgered: bool = False,
                   batch_id: str | None = None, accept: bool = False,
                   keep_rows: bool = True) -> DataFrame:
    """``ingest`` for the many targets named by the column ``target``: histories are one
    table partitioned by target and date, in which a key is unique per target. One job
    each counts, reconciles, merges and writes all of them.

    Rows without a target (status ``unrouted``, one decision) are written to
    ``dead_letter_path`` (default: beside the history) under their batch.
    ``keep_rows``: False, if the rows are cheaper to read again than to keep: the counts
    then need no more than the targets and dates, and days that are ingested already
    no more than that."""
    dead_letter_path = dead_letter_path or f"{history_path.rstrip('/')}_dead_letter"
    return _run(spark, incoming, history_path, ledger_path, None, keys, dry_run, repair,
                repair_only, archive_path, sort_within, date_of, quarantine_path,
                dead_letter_path, order_by, schema, fmt, merge_ledgered, batch_id, accept, keep_rows)


def _run(spark, incoming, history_path, ledger_path, target, keys, dry_run, repair, repair_only,
         archive_path, sort_within, date_of, quarantine_path, dead_letter_path, order_by, schema,
         fmt, merge_ledgered, batch_id, accept, keep_rows=True) -> DataFrame:
    depth = 1 if target is not None else 2
    if path_exists(spark, history_path):
        recover(spark, history_path, depth, lambda note: _record(spark, note["ledger_path"], note["dates"]))
    quarantine_path = quarantine_path or f"{history_path.rstrip('/')}_quarantine"
    if order_by is None and ARRIVAL in incoming.columns:
        order_by = [ARRIVAL]
    if order_by is None:
        order_by = [POSITION]
        if POSITION not in incoming.columns:
            incoming = incoming.withColumn(POSITION, F.monotonically_increasing_id())
    order_by = list(order_by)
    incoming = incoming.withColumn(PART_COL, row_date(incoming) if date_of is None else date_of)
    if schema is not None:
        incoming = conform_to(incoming, schema, [TARGET, PART_COL, *order_by])
    # the rows are read for the counts, the merge and the archive: kept instead of
    # computed each time (a lost block is recomputed)
    if keep_rows:
        incoming = incoming.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _ingest(spark, incoming, history_path.rstrip("/"), ledger_path, target, keys, order_by,
                       schema, fmt, dry_run, repair, repair_only, archive_path, sort_within,
                       quarantine_path, dead_letter_path, merge_ledgered,
                       batch_id or uuid.uuid4().hex, accept)
    finally:
        if keep_rows:
            incoming.unpersist()


def _of(pairs: Iterable[tuple[str, str]], target: str | None) -> Column:
    """Rows of (target, date) pairs, as a filter on the partition columns: a few targets
    times the days of the run."""
    days: dict[str, list[str]] = {}
    for name, day in pairs:
        days.setdefault(name, []).append(day)
    if target is not None:
        return F.col(PART_COL).isin(_as_dates(days.get(target, [])))
    return reduce(or_, [(F.col(TARGET) == name) & F.col(PART_COL).isin(_as_dates(some))
                        for name, some in sorted(days.items())], F.lit(False))


def _history_dirs(spark: SparkSession, path: str, target: str | None, pairs) -> tuple[dict, dict]:
    """({(target, date): directory} of the pairs that are there, {target: a directory of
    it}). Lists the days of the run's targets, no files."""
    if target is not None:
        found = {target: partition_dirs(spark, path, PART_COL) or {}}
    else:
        wanted = {name for name, _ in pairs}
        found = {}
        for name, place in (partition_dirs(spark, path, TARGET) or {}).items():
            if unquote(name) in wanted:
                found[unquote(name)] = partition_dirs(spark, place, PART_COL) or {}
    some = {name: max(days.values()) for name, days in found.items() if days}
    return {(name, day): found[name][day] for name, day in pairs
            if day in found.get(name, {})}, some


def _load_history(spark, path, dirs: Sequence[str], fmt, schema, part_by) -> DataFrame:
    reader = spark.read.option("basePath", path)
    if fmt == "csv":
        reader = (reader.option("header", True)
                  .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"))
    if schema is not None:
        kinds = {TARGET: T.StringType(), PART_COL: T.DateType()}
        reader = reader.schema(T.StructType(
            [f for f in schema.fields if f.name not in part_by]
            + [T.StructField(c, kinds[c]) for c in part_by]))
    return reader.format(fmt).load(list(dirs))


def _ingest(spark, incoming, history_path, ledger_path, target, keys, order_by, schema, fmt,
            dry_run, repair, repair_only, archive_path, sort_within, quarantine_path,
            dead_letter_path, merge_ledgered, batch_id, accept) -> DataFrame:
    part_by = [PART_COL] if target is not None else [TARGET, PART_COL]
    name = F.lit(target).alias(TARGET) if target is not None else F.col(TARGET)
    # bounded: targets times the days of this run
    counted = (incoming.groupBy(name, F.col(PART_COL).cast("string").alias("date"))
               .agg(F.count(F.lit(1)).alias("incoming_rows")).collect())
    unrouted = sum(r["incoming_rows"] for r in counted if r[TARGET] is None)
    undated = {r[TARGET]: r["incoming_rows"] for r in counted
               if r["date"] is None and r[TARGET] is not None}
    counts = [tuple(r) for r in counted if r["date"] is not None and r[TARGET] is not None]
    pairs = [(t, d) for t, d, _ in counts]
    # only the days being ingested are read and counted in history, from their footers
    stored, targets = _history_dirs(spark, history_path, target, pairs + [(t, "") for t in undated])
    history_counts = {(r[0] if target is None else target, r[-2]): r[-1] for r in
                    partition_counts(spark, history_path, list(stored.values()), part_by, fmt)}
    counts_schema = "target string, date string, {} bigint"
    ledger = L.parse_ledger(read_ledger(spark, ledger_path)).where(
        F.col(TARGET).isin(sorted({t for t, _ in pairs})))
    decisions = L.reconcile(
        spark.createDataFrame(counts, counts_schema.format("incoming_rows")),
        spark.createDataFrame([(t, d, n) for (t, d), n in history_counts.items()],
                              counts_schema.format("history_rows")),
        ledger, spark.createDataFrame([(t,) for t in targets], "target string"),
        dry_run=dry_run, repair=repair, repair_only=repair_only)
    decided = [r.asDict() for r in decisions.collect()]      # one row per target and date
    held = {(r[TARGET], r["date"]) for r in decided if r["status"] == L.MISMATCH}
    if accept and not repair_only:
        for r in decided:
            if r["status"] in (L.MISMATCH, L.REPAIR_NEEDED, L.REPAIRED):
                r["status"] = L.RELEASED
        held = set()
    merging = [L.CREATED, L.UPDATED, L.RELEASED]
    if dry_run:
        merging.append(L.DRY_RUN)
    if merge_ledgered and not repair_only:
        merging.append(L.ALREADY)
    to_merge = [(r[TARGET], r["date"]) for r in decided if r["status"] in merging]
    repaired = [(r[TARGET], r["date"]) for r in decided if r["status"] == L.REPAIRED]

    if not dry_run and not repair_only:
        routed = incoming if target is not None else incoming.where(F.col(TARGET).isNotNull())
        if held or undated:
            _hold(routed.withColumn(TARGET, name), _of(held, None), quarantine_path, batch_id)
        if unrouted:
            write_parquet(incoming.where(F.col(TARGET).isNull()).drop(TARGET, *order_by)
                          .withColumn("batch", F.lit(batch_id)),
                          dead_letter_path, ["batch"], "overwrite")

    after: dict[tuple[str, str], int] = {}
    dates: dict[str, list[str]] = {}
    for t, d in to_merge + repaired:
        dates.setdefault(t, []).append(d)
    note = {"ledger_path": ledger_path, "dates": dates}
    if to_merge:
        merged = _merged(spark, incoming, history_path, stored, targets, to_merge, target, keys,
                         order_by, schema, fmt, part_by)
        if dry_run:       # compute the merge and its statistics, write nothing
            rows = (merged.groupBy(name, F.col(PART_COL).cast("string").alias("d"))
                    .agg(F.count(F.lit(1)).alias("n")).collect())
            after = {(r[0], r[1]): r[2] for r in rows}
        else:
            stage_and_publish(spark, merged, staging_path(spark, history_path), history_path, part_by,
                              sort_within, fmt, note,
                              lambda done: _record(spark, done["ledger_path"], done["dates"]))
            now, _ = _history_dirs(spark, history_path, target, to_merge)
            after = {(r[0] if target is None else target, r[-2]): r[-1] for r in
                     partition_counts(spark, history_path, list(now.values()), part_by, fmt)}
    elif repaired and not dry_run:
        _record(spark, ledger_path, dates)
    if archive_path is not None and to_merge and not dry_run:
        archive_raw(incoming.where(_of(to_merge, target)).drop(*order_by), archive_path)
    return _decision_rows(spark, decisions.schema, decided, after, undated, unrouted, targets)


def _merged(spark, incoming, history_path, stored, targets, to_merge, target, keys, order_by,
            schema, fmt, part_by) -> DataFrame:
    """The days to merge, history's rows first. Only their partitions are read; where
    none is there yet, one of another day gives the types."""
    todo = incoming.where(_of(to_merge, target))
    own = [stored[p] for p in to_merge if p in stored]
    if not own and not targets:
        columns = [c for c in todo.columns if c not in order_by]
        return merge_first_wins(None, todo, _with_target(keys, columns, part_by),
                                order_by=order_by).drop(*order_by)
    history = _load_history(spark, history_path, own or [max(targets.values())], fmt, schema, part_by)
    history = history.where(_of(to_merge, target)) if own else history.where(F.lit(False))
    if schema is None:
        todo = conform_to(todo, history.schema, [*part_by, *order_by])
    columns = list(history.columns)
    # the incoming frame orders its own rows; history rows come first anyway
    history = history.withColumns({c: F.lit(None).cast(todo.schema[c].dataType) for c in order_by})
    return merge_first_wins(history, todo, _with_target(keys, columns, part_by),
                            order_by=order_by).drop(*order_by)


def _with_target(keys, columns, part_by) -> list[str]:
    found = resolve_keys(keys, columns)
    return found + [c for c in part_by if c == TARGET and c not in found]


def _hold(rows: DataFrame, refused: Column, path: str, batch_id: str) -> None:
    """Rows without a date and those of refused days, to quarantine."""
    undated = F.col(PART_COL).isNull()
    write_parquet(rows.where(undated | refused)
                  .withColumn("reason", F.when(undated, F.lit(L.UNDATED)).otherwise(F.lit(L.MISMATCH)))
                  .withColumn("batch", F.lit(batch_id)),
                  path, [TARGET, "batch", PART_COL], "overwrite")


def _decision_rows(spark, schema, decided, after, undated, unrouted, targets) -> DataFrame:
    out = []
    for row in decided:
        rows_after = after.get((row[TARGET], row["date"]))
        added = None if rows_after is None else rows_after - row["history_rows"]
        if row["status"] == L.ALREADY and added:
            row["status"] = L.UPDATED           # late rows of a recorded day
        out.append((*row.values(), rows_after, added))
    lost = [(t, n, L.UNDATED) for t, n in sorted(undated.items())]
    lost += [(None, unrouted, L.UNROUTED)] if unrouted else []
    for name, n, status in lost:
        row = dict.fromkeys(schema.names) | {
            TARGET: name, "incoming_rows": n, "history_rows": 0,
            "target_exists": name in targets, "in_ledger": False, "status": status}
        out.append((*row.values(), None, None))
    result = T.StructType([*schema.fields, T.StructField("rows_after", T.LongType()),
                           T.StructField("rows_added", T.LongType())])
    return spark.createDataFrame(out, result)


def _record(spark: SparkSession, ledger_path: str, dates: dict[str, list[str]]) -> None:
    """Add the dates to the ledger."""
    if dates:
        ledger_log.append(spark, ledger_path, dates)


# ---- quarantine --------------------------------------------------------------

def quarantined(spark: SparkSession, quarantine_path: str) -> DataFrame:
    """(target, batch, trade_date, reason, rows) of what is held."""
    kind = "target string, batch string, trade_date date, reason string, rows bigint"
    if not partitions(Storage(spark, quarantine_path), quarantine_path.rstrip("/"), 3):
        return spark.createDataFrame([], kind)
    return (spark.read.option("mergeSchema", True).parquet(quarantine_path)
            .groupBy(F.col(TARGET).cast("string"), F.col("batch").cast("string"),
                     F.col(PART_COL).cast("date"), "reason")
            .agg(F.count(F.lit(1)).alias("rows")))


def release(spark: SparkSession, quarantine_path: str, history_path: str, ledger_path: str,
            target: str, keys: Sequence[str], batches: Sequence[str] | None = None,
            date_of: Column | None = None, **more) -> DataFrame:
    """Ingest the quarantined rows of ``target`` (of the ``batches`` that were accepted;
    default: all) and take them out of quarantine; returns the decisions.

    Rows of refused days are merged by key (status ``released``): history's rows win, as
    always. Rows without a date are released only with ``date_of``; those that it
    gives no date either stay, under a new batch. Every partition is moved to
    ``_released`` under the quarantine once it is merged; after a crash in between it is
    merged again, which adds nothing. ``more``: other arguments of ``ingest``.
    """
    storage, base = Storage(spark, quarantine_path), quarantine_path.rstrip("/")
    parts = []
    for names in partitions(storage, base, 3):
        owner, batch, day = (unquote(n.split("=", 1)[1]) for n in names)
        if (owner == target and (batches is None or batch in batches)
                and (date_of is not None or day != NO_DATE)):
            parts.append(names)
    decisions = "target string, date string, status string"
    if not parts:
        return spark.createDataFrame([], decisions)
    dirs = ["/".join([base, *names]) for names in parts]
    rows = spark.read.option("basePath", base).option("mergeSchema", True).parquet(*dirs)
    order = more.pop("order_by", None) or [c for c in (ARRIVAL, POSITION) if c in rows.columns][:1]
    dated = F.col(PART_COL).cast("date")
    out = ingest(spark, rows.drop(TARGET, "batch", "reason"), history_path, ledger_path, target, keys,
                 date_of=dated if date_of is None else F.coalesce(dated, date_of),
                 quarantine_path=quarantine_path, order_by=order or None, merge_ledgered=True,
                 accept=True, **more)
    done = uuid.uuid4().hex
    for names, place in zip(parts, dirs):
        storage.move(place, "/".join([base, "_released", done, *names]))
        for above in (names[:2], names[:1]):
            if not storage.names("/".join([base, *above])):
                storage.remove("/".join([base, *above]))
    return out


SYNC_SCHEMA = ("target string, date string, status string, rows_before bigint, rows_after bigint, "
               "rows_added bigint, archived boolean, message string")


def sync_date(spark: SparkSession, feeds: Sequence[dict], **flags) -> DataFrame:
    """Ingest every feed of a run, isolating failures per target.

    ``feeds``: dicts with incoming, history_path, ledger_path, target, keys and
    optionally any other argument of ``ingest`` (see ``plans.feeds.build_feeds``).
    A failing target is reported with status ``error`` and its message; the
    others proceed. Returns one row per decision (one per failed target) with its
    row statistics. Feeds that share a ledger are ingested one after the other,
    so each adds to what the one before has recorded.
    """
    out = []
    for feed in feeds:           # a handful of feeds per run; each is a Spark job
        try:
            if "dead_letter_path" in feed:
                if not flags.get("dry_run") and not flags.get("repair_only"):
                    write_parquet(feed["incoming"].withColumn("batch", F.lit(uuid.uuid4().hex)),
                                  feed["dead_letter_path"], ["batch"], "append")
                out.append((None, None, L.UNROUTED, None, None, 0, False,
                            f"{feed['rows']} rows that no target takes"))
                continue
            archived = feed.get("archive_path") is not None and not flags.get("dry_run", False)
            out += sync_rows(ingest(spark, **feed, **flags), archived)
        except Exception as error:  # noqa: BLE001 - isolate this target
            out.append((feed["target"], None, "error", None, None, None, False, str(error)))
    return spark.createDataFrame(out, SYNC_SCHEMA)


def sync_rows(decisions: DataFrame, archived: bool) -> list[tuple]:
    """Decisions as rows of ``SYNC_SCHEMA``."""
    out = []
    for r in decisions.collect():
        known = r["rows_after"] is not None
        out.append((r["target"], r["date"], r["status"], r["history_rows"],
                    r["rows_after"] if known else r["history_rows"],
                    r["rows_added"] if known else 0,
                    archived and r["status"] in (L.CREATED, L.UPDATED), None))
    return out
