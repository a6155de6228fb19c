"""Trading calendar: date span, weekends, exchange holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.schemas import HOLIDAYS_2026

WEEKEND, HOLIDAY, TRADING = "weekend", "holiday", "trading"


def holidays(spark: SparkSession, rows=HOLIDAYS_2026) -> DataFrame:
    """Holiday calendar table (date, holiday_name)."""
    return (spark.createDataFrame(list(rows), "d string, holiday_name string")
                 .select(F.to_date("d").alias("date"), "holiday_name"))


def date_span(start: Column, end: Column) -> Column:
    """Inclusive calendar dates from ``start`` to ``end`` (use with ``explode``).
    An empty array when ``end < start``."""
    return F.when(end >= start, F.sequence(start, end, F.expr("INTERVAL 1 DAY"))) \
            .otherwise(F.array().cast("array<date>"))


def classify_days(dates: DataFrame, holiday_table: DataFrame, date_col: str = "date") -> DataFrame:
    """Adds weekday (0 = Monday), status and holiday_name.

    A weekend is tested before a holiday, so a holiday that falls on a
    Saturday or Sunday counts as a weekend.
    """
    h = holiday_table.withColumnRenamed("date", date_col)
    j = dates.join(h, date_col, "left")
    wd = F.weekday(F.col(date_col))
    status = (F.when(wd >= 5, F.lit(WEEKEND))
               .when(F.col("holiday_name").isNotNull(), F.lit(HOLIDAY))
               .otherwise(F.lit(TRADING)))
    return j.withColumn("weekday", wd).withColumn("status", status)


def trading_days(dates: DataFrame, holiday_table: DataFrame, date_col: str = "date") -> DataFrame:
    return (classify_days(dates, holiday_table, date_col)
            .where(F.col("status") == TRADING).select(*dates.columns))


def skipped_days(dates: DataFrame, holiday_table: DataFrame, date_col: str = "date") -> DataFrame:
    return classify_days(dates, holiday_table, date_col).where(F.col("status") != TRADING)
