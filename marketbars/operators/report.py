"""Run outcomes, per-date status, file summaries and catalog checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.functions.text import thousands

DOWNLOADED, PARTIAL, FAILED_DATE = "downloaded", "partial", "failed"


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Per (date, kind): contracts, successful, no_data, failed, rows.

    ``outcomes``: date, kind, symbol, outcome, rows (one row per response; a
    failed discovery is one row with outcome ``failed``)."""
    o = F.col("outcome")
    return outcomes.groupBy("date", "kind").agg(
        F.count_if(F.col("symbol").isNotNull()).alias("contracts"),
        F.count_if(o == "ok").alias("successful"),
        F.count_if(o == "no_data").alias("no_data"),
        F.count_if(o == "failed").alias("failed"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"))


def run_summary(counts: DataFrame) -> DataFrame:
    """Sums across dates per kind; missing values count as 0."""
    cols = ["contracts", "successful", "no_data", "failed", "rows"]
    return counts.groupBy("kind").agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c) for c in cols])


KINDS = ["options", "futures", "spot"]


def expected_kinds(days: DataFrame, kinds=KINDS, date_col: str = "trading_date") -> DataFrame:
    """(date, kind) of every kind on every day (a generator over a fixed list)."""
    return days.select(F.col(date_col).alias("date"),
                       F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind")).distinct()


def date_status(counts: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Per date: failed when no kind produced rows, partial when some kind
    produced nothing, else downloaded (failed contracts alone do not make a
    date partial). ``expected`` (date, kind): a kind that is expected and has no
    row in ``counts`` produced nothing either."""
    rows = counts.select("date", "kind", "rows")
    if expected is not None:
        rows = expected.select("date", "kind").join(rows, ["date", "kind"], "left")
    produced = F.coalesce(F.col("rows"), F.lit(0)) > 0
    s = rows.groupBy("date").agg(
        F.count_if(produced).alias("kinds_produced"),
        F.count_if(~produced).alias("kinds_with_errors"))
    status = (F.when(F.col("kinds_produced") == 0, F.lit(FAILED_DATE))
               .when(F.col("kinds_with_errors") > 0, F.lit(PARTIAL))
               .otherwise(F.lit(DOWNLOADED)))
    return s.withColumn("status", status)


def pending_kinds(days: DataFrame, produced: DataFrame, exchanges: DataFrame,
                  indexes: DataFrame) -> DataFrame:
    """(trading_date, kind) still to be collected. Options are done when every
    exchange has valid rows for the day, futures when the day has its file, spot when
    every index has its file of the day.

    ``produced``: trading_date, kind, exchange (of options; the index of spot, else
    null), valid. ``exchanges``: exchange. ``indexes``: index."""
    def whole(kind: str, parts: DataFrame, where: str) -> DataFrame:
        # the exchanges or indexes are a short fixed list: one array, as a scalar
        wanted = parts.agg(F.collect_set(parts.columns[0])).scalar()
        return (produced.where(f"kind = '{kind}' and {where}")
                .groupBy("trading_date").agg(F.collect_set("exchange").alias("have"))
                .where(F.size(F.array_except(wanted, "have")) == 0)
                .select("trading_date", F.lit(kind).alias("kind")))
    done = (whole("options", exchanges, "valid").union(whole("spot", indexes, "true"))
            .union(produced.where("kind = 'futures'").select("trading_date", "kind").distinct()))
    return (expected_kinds(days).withColumnRenamed("date", "trading_date")
            .join(done, ["trading_date", "kind"], "left_anti"))


def run_verdict(statuses: DataFrame) -> DataFrame:
    """Dates by status and the exit code (1 only when some date failed)."""
    st = F.col("status")
    return statuses.agg(
        F.count_if(st == DOWNLOADED).alias("dates_downloaded"),
        F.count_if(st == PARTIAL).alias("dates_partial"),
        F.count_if(st == FAILED_DATE).alias("dates_failed"),
    ).withColumn("exit_code", F.when(F.col("dates_failed") > 0, 1).otherwise(0))


def file_summary(df: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """rows, indexes (sorted distinct Underlying, when present), contracts
    (distinct Ticker, when present) and the caption text, in one aggregate."""
    group_by = group_by or []
    aggs = [F.count(F.lit(1)).alias("rows")]
    if "Underlying" in df.columns:
        aggs.append(F.array_join(F.array_sort(F.collect_set(F.col("Underlying").cast("string"))), ", ")
                    .alias("indexes"))
    if "Ticker" in df.columns:
        aggs.append(F.count_distinct("Ticker").alias("contracts"))
    s = df.groupBy(*group_by).agg(*aggs) if group_by else df.agg(*aggs)
    parts = [F.concat(thousands(F.col("rows")), F.lit(" rows"))]
    if "Underlying" in df.columns:
        parts.append(F.concat(F.lit("indexes: "), F.col("indexes")))
    if "Ticker" in df.columns:
        parts.append(F.concat(F.col("contracts").cast("string"), F.lit(" contracts")))
    return s.withColumn("summary", F.concat_ws(" | ", *parts))


def duplicate_targets(catalog: DataFrame, name_col: str = "target") -> DataFrame:
    """Target names that resolve to more than one live object (an error)."""
    return (catalog.groupBy(name_col).agg(F.count(F.lit(1)).alias("copies"))
                   .where(F.col("copies") > 1))


def feed_presence(expected: DataFrame, present: DataFrame, keys: list[str],
                  group_by: list[str]) -> DataFrame:
    """Expected ⟕ present: a ``present`` flag per expected item, and per group
    whether every expected item is present (relational division)."""
    flagged = expected.join(present.select(*keys).distinct().withColumn("present", F.lit(True)),
                            keys, "left").withColumn("present", F.coalesce("present", F.lit(False)))
    return flagged.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if("present").alias("present"),
        F.bool_and("present").alias("complete"))
