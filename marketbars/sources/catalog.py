"""Static dimensions and the per-day feed catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.schemas import (
    DEDUP_KEYS, FUTURES_FILENAME, OPTIONS_FILENAMES, SPOT_FILENAME_PATTERN, SPOT_FILES,
    SPOT_STEMS, UNDERLYINGS, YEARLY_FILES,
)


def index_dim(spark: SparkSession) -> DataFrame:
    """index, vendor symbol, exchange, spot stem."""
    rows = [(k, sym, ex, SPOT_STEMS.get(k)) for k, (sym, ex, _) in UNDERLYINGS.items()]
    return spark.createDataFrame(rows, "index string, symbol string, exchange string, stem string")


def expected_files() -> list[str]:
    """Ordered per-day file names: NSE options, BSE options, futures, spot per index."""
    names = [OPTIONS_FILENAMES["NSE"], OPTIONS_FILENAMES["BSE"], FUTURES_FILENAME]
    names += [SPOT_FILENAME_PATTERN % stem for stem in SPOT_STEMS.values()]
    return names


def feed_catalog(spark: SparkSession) -> DataFrame:
    """One row per feed: order, kind, per-day file, format, target pattern, keys.

    ``target`` holds a ``%d`` year placeholder for per-year targets; spot
    targets are cumulative (no year)."""
    rows = [
        (1, "options", "options_nse", OPTIONS_FILENAMES["NSE"], "parquet", YEARLY_FILES["options_nse"], DEDUP_KEYS["options"]),
        (2, "options", "options_bse", OPTIONS_FILENAMES["BSE"], "parquet", YEARLY_FILES["options_bse"], DEDUP_KEYS["options"]),
        (3, "futures", "futures", FUTURES_FILENAME, "parquet", YEARLY_FILES["futures"], DEDUP_KEYS["futures"]),
    ]
    for i, (index, stem) in enumerate(SPOT_STEMS.items()):
        rows.append((4 + i, "spot", index, SPOT_FILENAME_PATTERN % stem, "csv", SPOT_FILES[index], DEDUP_KEYS["spot"]))
    return spark.createDataFrame(
        rows, "ord int, kind string, feed string, file_name string, fmt string, target string, keys array<string>")



def present_feeds(catalog: DataFrame, produced: DataFrame) -> DataFrame:
    """Expected feeds of the run flagged by whether their per-day file was
    produced (``produced``: file_name). Missing feeds are the ``present = false`` rows."""
    p = produced.select("file_name").distinct().withColumn("present", F.lit(True))
    return (catalog.join(p, "file_name", "left")
                   .withColumn("present", F.coalesce("present", F.lit(False))))
