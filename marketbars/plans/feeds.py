"""From the tables of a run to the feeds of their targets: options by exchange and
year, futures by year, spot by index."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.operators.routing import feed_target, row_date
from marketbars.plans.ingest import SYNC_SCHEMA, ingest_targets, sync_rows
from marketbars.schemas import DEDUP_KEYS, SCHEMAS, UNDERLYINGS

KINDS = ("options", "futures", "spot")


def routed(spark: SparkSession, kind: str, rows: DataFrame) -> DataFrame:
    """``rows`` with ``target``: null where no target takes them (an index that is
    not routed, or a row without a date in a feed of yearly targets)."""
    if kind == "options":
        # looked up in the row: a join with the few indexes would deal all rows by them
        exchanges = F.create_map(*[F.lit(x) for k, v in UNDERLYINGS.items() for x in (k, v[1])])
        feed = F.concat(F.lit("options_"), F.lower(F.try_element_at(exchanges, F.col("Underlying"))))
    else:
        feed = F.lit(kind)
    index = F.col("Index") if kind == "spot" else F.lit(None).cast("string")
    return rows.withColumn("target", feed_target(feed, row_date(rows), index))


def build_feeds(spark: SparkSession, tables: dict[str, DataFrame], root: str,
                archive: bool = False, **more) -> list[dict]:
    """One feed per target that has rows, ready for ``sync_date``. Spot histories
    are CSV, the others Parquet; every target has its own ledger. Rows that no target
    takes make a feed of dead letters per kind.

    The targets of a run are few (feeds times years): their names are collected.
    """
    feeds = []
    for kind in KINDS:
        if kind not in tables:
            continue
        rows = routed(spark, kind, tables[kind])
        found = {r["target"]: r["count"] for r in rows.groupBy("target").count().collect()}
        for name in sorted(n for n in found if n is not None):
            own = rows.where(F.col("target") == name).drop("target")
            feed = dict(incoming=own, target=name, keys=DEDUP_KEYS[kind],
                        history_path=f"{root}/{kind}/{name}", schema=SCHEMAS[kind],
                        ledger_path=f"{root}/ledger/{name}",
                        fmt="csv" if kind == "spot" else "parquet", **more)
            if archive:
                feed["archive_path"] = f"{root}/archive/{name}"
            feeds.append(feed)
        if None in found:
            feeds.append(dict(incoming=rows.where("target IS NULL").drop("target"),
                              target=None, rows=found[None],
                              dead_letter_path=f"{root}/dead_letter/{kind}"))
    return feeds


def sync_tables(spark: SparkSession, tables: dict[str, DataFrame], root: str,
                archive: bool = False, keep_rows: bool = True, **flags) -> DataFrame:
    """All targets of a run in one job a kind: ``root``/kind holds the histories of the
    kind's targets by target and day, ``root``/ledger one ledger. The rows of a kind are
    routed once, reconciled, merged and written once, whatever the number of targets;
    rows that no target takes go to ``root``/dead_letter. Returns the rows of
    ``SYNC_SCHEMA``: one per decision.

    ``keep_rows``: see ``ingest_targets``; False suits tables that are read straight from
    files.
    A kind that fails is done again target by target, so that only those that fail
    themselves are reported as ``error``; what was published before stays.
    """
    out = []
    for kind in KINDS:
        if kind not in tables:
            continue
        rows = routed(spark, kind, tables[kind])
        path = f"{root}/{kind}"
        own = dict(history_path=path, ledger_path=f"{root}/ledger", keys=DEDUP_KEYS[kind],
                   schema=SCHEMAS[kind], fmt="csv" if kind == "spot" else "parquet",
                   quarantine_path=f"{root}/quarantine/{kind}",
                   dead_letter_path=f"{root}/dead_letter/{kind}",
                   archive_path=f"{root}/archive/{kind}" if archive else None,
                   keep_rows=keep_rows, **flags)
        kept = archive and not flags.get("dry_run", False)
        try:
            out += sync_rows(ingest_targets(spark, rows, **own), kept)
        except Exception:  # noqa: BLE001 - find the targets that fail
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)       # read once a target
            try:
                out += _one_by_one(spark, kind, rows, own, kept)
            finally:
                rows.unpersist()
    return spark.createDataFrame(out, SYNC_SCHEMA)


def _one_by_one(spark: SparkSession, kind: str, rows: DataFrame, own: dict, kept: bool) -> list:
    out = []
    try:
        names = [r["target"] for r in rows.select("target").distinct().collect()]
    except Exception as error:  # noqa: BLE001 - the rows themselves can't be had
        return [(kind, None, "error", None, None, None, False, str(error))]
    for name in sorted(names, key=lambda n: (n is None, n)):
        try:
            some = rows.where(F.col("target").eqNullSafe(F.lit(name)))
            out += sync_rows(ingest_targets(spark, some, **own), kept)
        except Exception as error:  # noqa: BLE001 - isolate this target
            out.append((name, None, "error", None, None, None, False, str(error)))
    return out


def dead_letters(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The rows of ``kind`` that no target took, with their batch."""
    return spark.read.parquet(f"{root}/dead_letter/{kind}")

