"""Declared-schema readers. Nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.schemas import (
    BAR_PAYLOAD_RAW_SCHEMA, BAR_PAYLOAD_SCHEMA, CHAIN_PAYLOAD_SCHEMA, LEDGER_SCHEMA, SCHEMAS,
)

# one cell and what ends it: a quoted cell (doubled quotes inside) with blanks
# around, else everything up to the next comma, stray quotes included
_CELL = r'\s*"(?:[^"]|"")*"\s*(?=,|$)|[^,]*'
_QUOTED = r'(?s)^\s*"(.*)"\s*$'


def parse_candles(raw: DataFrame) -> DataFrame:
    """Payload rows with ``candles`` as JSON text -> as a list of lists of cell
    texts, and ``readable``: false where there is a text that isn't such a list."""
    kind = BAR_PAYLOAD_SCHEMA["candles"].dataType
    text = F.col("candles")
    parsed = F.from_json(text, kind)
    missing = text.isNull() | (F.btrim(text) == "null")
    return (raw.withColumn("_parsed", parsed)
            .withColumn("readable", missing | F.col("_parsed").isNotNull())
            .withColumn("candles", F.col("_parsed")).drop("_parsed"))


def read_bar_payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, one history response per line (request columns + payload)."""
    return parse_candles(spark.read.schema(BAR_PAYLOAD_RAW_SCHEMA).json(path))


def read_chain_payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, one option-chain response per line."""
    return spark.read.schema(CHAIN_PAYLOAD_SCHEMA).json(path)


def csv_cells(line):
    """A CSV text line -> array of cells of any width (quotes respected, doubled
    quotes unescaped; a quote inside an unquoted cell is an ordinary character).
    One pass over the line: every match starts where the last one ended."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({_CELL})"), F.lit(1))
    return F.transform(raw, lambda c: F.when(
        c.rlike(_QUOTED),
        F.replace(F.regexp_extract(c, _QUOTED, 1), F.lit('""'), F.lit('"'))
    ).otherwise(c))


def read_symbol_master(spark: SparkSession, path: str) -> DataFrame:
    """Header-less, ragged CSV -> ``cells`` array<string>; empty lines dropped.
    Undecodable bytes become U+FFFD (the text reader decodes UTF-8 leniently)."""
    lines = spark.read.text(path)
    return (lines.where(F.length("value") > 0)
                 .select(csv_cells(F.col("value")).alias("cells")))


ARRIVAL = "_arrival"            # a row's place in the order of arrival, dropped on write


def with_arrival(df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """``df``, read from files, with ``ARRIVAL``: when its file was written, the file's
    path, and the row's place in the file. Spark deals files to tasks by size, so the order
    of its rows says nothing about that of their arrival.

    Parquet tells a row's place in its file; for other formats it is that of the
    block, and ``place_in_block`` adds the place there."""
    file = F.col("_metadata")
    place = F.lit(0).cast("bigint") if fmt != "parquet" else file["row_index"]
    return df.select("*", F.struct(
        file["file_modification_time"].alias("time"), file["file_path"].alias("path"),
        (F.lit(0).cast("bigint") if fmt == "parquet" else file["file_block_start"]).alias("block"),
        place.alias("place")).alias(ARRIVAL))


def place_in_block(df: DataFrame) -> DataFrame:
    """``df`` of ``with_arrival``, straight from its files, with the rows of a block in
    their order (a block is read by one task from its start to its end)."""
    return df.withColumn(ARRIVAL, F.col(ARRIVAL).withField("place", F.monotonically_increasing_id()))


@contextmanager
def footer_counts(spark: SparkSession) -> Iterator[None]:
    """Parquet tables read and counted in here, grouped by their partition columns or not
    at all, are counted from the files' footers: Spark's newer Parquet reader takes
    aggregates, and no column is read."""
    own = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
           "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def partition_counts(spark: SparkSession, path: str, dirs: list[str], columns: list[str],
                     fmt: str = "parquet") -> list[tuple]:
    """(partition values as text..., rows) of the partition directories ``dirs`` of the
    table at ``path``, which is partitioned by ``columns``."""
    if not dirs:
        return []
    kinds = ", ".join(f"`{c}` {'date' if c == 'trade_date' else 'string'}" for c in columns)
    reader = spark.read.option("basePath", path).option("header", fmt == "csv").schema(kinds)
    with footer_counts(spark):
        rows = (reader.format(fmt).load(dirs)
                .groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).collect())
    return [(*(None if v is None else str(v) for v in r[:-1]), r["n"]) for r in rows]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(target, dates_json) rows; a missing ledger is an empty table. Any other
    failure is raised: a ledger that can't be read must not pass for an empty one."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).json(path)


def read_bars(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """Bar table with its declared schema (Parquet, or CSV with header)."""
    schema = SCHEMAS[kind]
    if fmt == "parquet":
        df = spark.read.schema(schema).parquet(path)
    else:
        df = (spark.read.schema(schema).option("header", True)
              .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    return df.select(*[f.name for f in schema.fields])


def valid_table(df: DataFrame, expected_columns) -> bool:
    """Readable, exact ordered columns, and not empty (one row fetched at most)."""
    return list(df.columns) == list(expected_columns) and not df.isEmpty()


def parse_bar_payload_text(text: Column) -> Column:
    """A landed JSON payload held in a string column -> BAR_PAYLOAD_RAW_SCHEMA
    struct, whose ``candles`` ``parse_candles`` reads (as ``read_bar_payloads`` does)."""
    return F.from_json(text, BAR_PAYLOAD_RAW_SCHEMA)


def path_exists(spark: SparkSession, path: str) -> bool:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)


def partition_dirs(spark: SparkSession, path: str, column: str) -> dict[str, str] | None:
    """``{value: directory}`` of the ``column=value`` directories directly under
    ``path`` (one directory listing, no file listing); None when ``path`` does
    not exist. Works on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    prefix = f"{column}="
    out = {}
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            out[name[len(prefix):]] = f"{path.rstrip('/')}/{name}"
    return out
