"""marketbars: a Spark-native engine for one-minute market-bar tables.

Everything is expressed as DataFrame transformations (``DataFrame -> DataFrame``)
built from Spark SQL built-in functions, so Catalyst does pruning, pushdown and
join planning and whole-stage codegen runs the expressions. There are no Python
UDFs anywhere in the package.

Sub-packages:
  sources    readers for landed payloads, symbol masters, ledgers, calendars, dims
  functions  Column-level helpers (time zone, epoch, symbol and number parsing)
  operators  bars, contracts, quality, merge, ledger, routing, reports
  sinks      partitioned zstd Parquet / CSV writers with read-back verification
  plans      composed batch jobs (collect a day, ingest into history, day report)
  streaming  incremental ingest with Structured Streaming
  queries    the operator catalogue run against the benchmark tables
"""

__version__ = "0.1.0"
