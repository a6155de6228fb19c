"""The operator catalogue run against the benchmark tables.

Each entry is ``name -> (build(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
The builders read the given tables (or data Spark derives from them) in full;
the SQL is an independent statement of the same result for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> dict:
    # importing the modules fills REGISTRY
    from marketbars.queries import (  # noqa: F401
        q_merge, q_quality, q_payloads, q_calendar, q_contracts, q_ledger, q_reports, q_io,
        q_plans, q_sync,
    )
    return REGISTRY
