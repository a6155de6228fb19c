"""Day report: one row per expected per-day file with presence, label and the
caption summary (rows | indexes | contracts), from one aggregate per kind."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.operators.report import file_summary
from marketbars.schemas import FILE_LABELS, OPTIONS_FILENAMES, SPOT_FILENAME_PATTERN, SPOT_STEMS
from marketbars.sinks.writers import PART_COL
from marketbars.sources.catalog import expected_files
from marketbars.sources.readers import partition_dirs


def _read_day(spark: SparkSession, base: str, outer: str | None, day: str,
              fmt: str = "parquet") -> DataFrame | None:
    """The ``trade_date=day`` partitions of one output (under each ``outer=``
    directory when the output has an outer partition column), or None. Only
    directories are listed; other days are never touched."""
    tops = {"": base} if outer is None else (partition_dirs(spark, base, outer) or {})
    dirs = []
    for top in tops.values():
        days = partition_dirs(spark, top, PART_COL) or {}
        if day in days:
            dirs.append(days[day])
    if not dirs:
        return None
    reader = spark.read.option("basePath", base)
    if fmt == "csv":
        return reader.option("header", True).csv(dirs)
    return reader.parquet(*dirs)


def day_report(spark: SparkSession, out_dir: str, day: str) -> DataFrame:
    d = _dt.date.fromisoformat(day)
    parts = []
    opts = _read_day(spark, f"{out_dir}/options", "exchange", day)
    if opts is not None:
        names = F.create_map(*[x for k, v in OPTIONS_FILENAMES.items() for x in (F.lit(k), F.lit(v))])
        o = opts.withColumn("file_name", names[F.col("exchange")])
        parts.append(file_summary(o.select("file_name", "Underlying", "Ticker"), ["file_name"]))
    fut = _read_day(spark, f"{out_dir}/futures", None, day)
    if fut is not None:
        f = fut.withColumn("file_name", F.lit("futures.parquet"))
        parts.append(file_summary(f.select("file_name", "Underlying", "Ticker"), ["file_name"]))
    spot = _read_day(spark, f"{out_dir}/spot", "Index", day, "csv")
    if spot is not None:
        stems = F.create_map(*[x for k, v in SPOT_STEMS.items() for x in (F.lit(k), F.lit(v))])
        s = spot.withColumn("file_name", F.format_string(SPOT_FILENAME_PATTERN, stems[F.col("Index")]))
        parts.append(file_summary(s.select("file_name"), ["file_name"]))
    expected = spark.createDataFrame(list(enumerate(expected_files(), 1)), "ord int, file_name string")
    labels = F.create_map(*[x for k, v in FILE_LABELS.items() for x in (F.lit(k), F.lit(v))])
    label = F.coalesce(labels[F.col("file_name")],
                       F.concat(F.lit("Spot: "), F.regexp_extract("file_name", r"^spot_(.*)\.csv$", 1)))
    out = expected
    if parts:
        summ = parts[0]
        for p in parts[1:]:
            summ = summ.unionByName(p, allowMissingColumns=True)
        out = expected.join(summ, "file_name", "left")
    else:
        out = out.withColumn("rows", F.lit(None).cast("bigint")).withColumn("summary", F.lit(None).cast("string"))
    return (out.withColumn("present", F.coalesce(F.col("rows"), F.lit(0)) > 0)
               .withColumn("label", label).withColumn("date", F.lit(d)).orderBy("ord"))
