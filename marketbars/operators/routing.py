"""Where rows go: exchange split, per-year targets, per-date counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.functions.timefmt import lenient_date
from marketbars.schemas import OPTIONS_FILENAMES, SPOT_FILES, UNDERLYINGS, YEARLY_FILES


def exchange_dim(spark: SparkSession, mapping: dict[str, str] | None = None) -> DataFrame:
    """underlying -> exchange (one row per configured index)."""
    if mapping is None:
        mapping = {k: v[1] for k, v in UNDERLYINGS.items()}
    return spark.createDataFrame(list(mapping.items()), "Underlying string, exchange string")


def route_exchange(df: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Adds ``exchange`` by Underlying (inner: unknown indexes are not routed).
    The optimizer broadcasts the dimension when its size is small."""
    return df.join(exchanges, "Underlying", "inner")


def known_selected(df: DataFrame, dims: list, names: list[str], by: str, selected) -> DataFrame:
    """``df`` looked up in dimensions (table, own key, its key) one after the other,
    with ``known`` (every one of ``names`` was found) and ``selected`` (``by`` is one
    of the selection; an unknown row never is)."""
    for dim, left, right in dims:
        df = df.join(dim, F.col(left) == F.col(right), "left")
    known = F.lit(True)
    for name in names:
        known = known & F.col(name).isNotNull()
    return (df.withColumn("known", known)
            .withColumn("selected", F.coalesce(F.col(by).isin(*selected), F.lit(False))))


def exchange_split_counts(routed: DataFrame, date_col: str = "Date") -> DataFrame:
    """Rows per (exchange, date) and the per-day file each lands in."""
    names = F.create_map(*[x for k, v in OPTIONS_FILENAMES.items() for x in (F.lit(k), F.lit(v))])
    return (routed.groupBy("exchange", date_col).agg(F.count(F.lit(1)).alias("rows"))
                  .withColumn("file_name", F.try_element_at(names, F.col("exchange"))))


def year_target(kind: str, date: Column) -> Column:
    """Per-year target name of a feed kind, e.g. ``INDEX_FUTURES_2026.parquet``."""
    return F.format_string(YEARLY_FILES[kind], F.year(date))


def year_target_of(kind: Column, date: Column) -> Column:
    """Per-year target name when the feed kind is a column."""
    out = None
    for k in YEARLY_FILES:
        out = (F.when(kind == k, year_target(k, date)) if out is None
               else out.when(kind == k, year_target(k, date)))
    return out


def spot_target(index: Column) -> Column:
    names = F.create_map(*[x for k, v in SPOT_FILES.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(names, index)


def feed_target(feed: Column, date: Column, index: Column) -> Column:
    """Target of a row of ``feed`` (options_nse, options_bse, futures or spot):
    yearly by its date, or the index's cumulative file for spot."""
    return F.when(feed == "spot", spot_target(index)).when(
        date.isNotNull(), year_target_of(feed, date))


def row_date(df: DataFrame) -> Column:
    """The date a row belongs to: ``Date`` if present, else the date of
    ``timestamp``; NULL if neither column exists (decided at plan time)."""
    if "Date" in df.columns:
        if isinstance(df.schema["Date"].dataType, T.DateType):
            return F.col("Date")
        return lenient_date(F.col("Date"))
    if "timestamp" in df.columns:
        return lenient_date(F.col("timestamp"))
    return F.lit(None).cast("date")


def rows_per_date(df: DataFrame) -> DataFrame:
    """Row count of every date in one job."""
    return (df.select(row_date(df).alias("date")).groupBy("date")
              .agg(F.count(F.lit(1)).alias("rows")))
