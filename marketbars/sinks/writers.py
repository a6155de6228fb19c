"""Partitioned writers with read-back verification.

Publishing follows stage -> verify -> publish: rows are written once, to a
staging path under the shared checkpoint folder; the staged rows are read back, and their
number and content checksum compared with those observed while writing; then the verified
partition directories are moved into the target under a journal (``sinks.journal``),
compared again there, and the staging removed.

The checksum is a sum over the rows' hashes, so it doesn't depend on their order, and
values that change, or change places between rows, change it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.functions.timefmt import bar_timestamp_text
from marketbars.session import remove_path
from marketbars.sinks.journal import WriteError, publish, staging_path

PART_COL = "trade_date"


def _hashed(schema: T.StructType, fmt: str, partition_by: Sequence[str]) -> Column:
    """The hash of a row. In CSV, a value is its text, and a missing one is the empty
    text; time stamps with a zone have a format of their own there and are left out."""
    out = []
    for f in schema.fields:
        value = F.col(f"`{f.name}`")
        if fmt == "csv" and f.name not in partition_by:
            if f.dataType == T.TimestampType():
                continue
            value = F.coalesce(value.cast("string"), F.lit(""))
        elif isinstance(f.dataType, T.MapType):
            value = F.array_sort(F.map_entries(value))
        out.append(value)
    return F.xxhash64(*out) if out else F.lit(0).cast("bigint")


def content_sum(schema: T.StructType, fmt: str = "parquet",
                partition_by: Sequence[str] = ()) -> list[Column]:
    """Aggregates that give a table's rows and its checksum: the sums of the three
    parts of 21 bits and more of each row's hash (no sum of fewer than 2^42 rows
    overflows)."""
    h = _hashed(schema, fmt, partition_by)
    part = (1 << 21) - 1
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(h.bitwiseAND(F.lit(part))), F.lit(0)).alias("low"),
            F.coalesce(F.sum(F.shiftright(h, 21).bitwiseAND(F.lit(part))), F.lit(0)).alias("middle"),
            F.coalesce(F.sum(F.shiftrightunsigned(h, 42)), F.lit(0)).alias("high")]


def _layout(df: DataFrame, partition_by: Sequence[str], sort_within: Sequence[str],
            observe: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows laid out for a partitioned write.

    ``rebalance`` on the partition columns (not ``repartition``): a day that
    holds a third of all rows is split over several tasks by AQE instead of
    landing in one, and small days are merged. Each task then sorts by the
    partition columns first, which is the order the file writer needs (so it
    adds no sort of its own that would undo ``sort_within``).

    ``observe`` sees the rows behind that shuffle, in the tasks that write: map tasks
    that a lost executor has repeated would be observed twice.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if observe is not None:
        df = observe(df)
    order = [*partition_by, *sort_within]
    return df.sortWithinPartitions(*order) if order else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  mode: str = "errorifexists", sort_within: Sequence[str] = (),
                  observe: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """zstd Parquet. ``errorifexists`` is the no-clobber guard; ``overwrite``
    with dynamic partition overwrite replaces only the partitions written.
    ``sort_within`` clusters rows inside each file (better row-group stats)."""
    writer = (_layout(df, partition_by, sort_within, observe).write.mode(mode)
              .option("compression", "zstd")
              .option("partitionOverwriteMode", "dynamic"))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _csv_text(df: DataFrame) -> DataFrame:
    """NTZ timestamps as ``yyyy-MM-dd HH:mm:ss``."""
    return df.select(*[bar_timestamp_text(F.col(f.name)).alias(f.name)
                       if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name)
                       for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (),
              mode: str = "errorifexists", sort_within: Sequence[str] = (),
              observe: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """CSV with header; NTZ timestamps as ``yyyy-MM-dd HH:mm:ss``; blanks around a
    value are kept."""
    out = _csv_text(_layout(df, partition_by, sort_within, observe))
    writer = (out.write.mode(mode).option("header", True)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
              .option("partitionOverwriteMode", "dynamic"))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


_WRITERS = {"parquet": write_parquet, "csv": write_csv}


def read_back(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
              partition_by: Sequence[str] = (), dirs: Sequence[str] | None = None) -> tuple:
    """Rows and checksum of what is stored under ``path`` (of ``dirs`` only, if given)."""
    reader = spark.read.option("basePath", path)
    if fmt == "csv":
        # the file's columns are texts, in the order of the table without its partitions
        schema = T.StructType(
            [T.StructField(f.name, T.StringType()) for f in schema.fields if f.name not in partition_by]
            + [f for f in schema.fields if f.name in partition_by])
        reader = reader.option("header", True)
    stored = reader.schema(schema).format(fmt).load(list(dirs) if dirs else path)
    return tuple(stored.agg(*content_sum(_hash_order(schema, partition_by), fmt, partition_by)).first())


def _hash_order(schema: T.StructType, partition_by: Sequence[str]) -> T.StructType:
    """The order in which files give columns back: partition columns last."""
    return T.StructType([f for f in schema.fields if f.name not in partition_by]
                        + [schema[c] for c in partition_by])


def _observed_write(spark: SparkSession, df: DataFrame, path: str, partition_by, mode,
                    sort_within, fmt: str) -> tuple:
    """Write; rows and checksum as the writing tasks saw them."""
    seen = Observation("written")
    texts = _csv_text(df).schema if fmt == "csv" else df.schema
    sums = content_sum(_hash_order(texts, partition_by), fmt, partition_by)

    def observe(rows: DataFrame) -> DataFrame:
        if fmt != "csv":
            return rows.observe(seen, *sums)
        # the sums are over the texts that are written
        plain = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
        named = rows.withColumns({f"_text_{i}": bar_timestamp_text(F.col(c)) for i, c in enumerate(plain)})
        fields = [T.StructField(f"_text_{plain.index(f.name)}", T.StringType())
                  if f.name in plain and f.name not in partition_by else f
                  for f in _hash_order(df.schema, partition_by).fields]
        return (named.observe(seen, *content_sum(T.StructType(fields), fmt, partition_by))
                .select(*rows.columns))
    _WRITERS[fmt](df, path, partition_by, mode, sort_within, observe)
    try:
        return tuple(seen.get[c] for c in ("rows", "low", "middle", "high"))
    except Py4JError:           # an input known to be empty is planned without it
        return 0, 0, 0, 0


def _compare(what: str, path: str, stored: tuple, written: tuple) -> None:
    if stored[0] != written[0]:
        raise WriteError(f"{what} mismatch for {path}: {stored[0]} rows, not {written[0]}")
    if stored != written:
        raise WriteError(f"{what} mismatch for {path}: the rows' contents differ")


def verified_write(spark: SparkSession, df: DataFrame, path: str,
                   partition_by: Sequence[str] = (), mode: str = "errorifexists",
                   sort_within: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Write while observing the rows' number and checksum, read back, compare. Returns
    the number of rows.

    Replacing partitions goes through staging, so that the read-back covers the
    partitions of this write and nothing else of the target."""
    if mode == "overwrite" and partition_by:
        return stage_and_publish(spark, df, staging_path(spark, path), path, partition_by,
                                 sort_within, fmt)
    written = _observed_write(spark, df, path, partition_by, mode, sort_within, fmt)
    if mode != "append" and written[0]:
        _compare("read-back", path, read_back(spark, path, df.schema, fmt, partition_by), written)
    return written[0]


def stage_and_publish(spark: SparkSession, df: DataFrame, staging: str, target: str,
                      partition_by: Sequence[str] = (PART_COL,),
                      sort_within: Sequence[str] = (), fmt: str = "parquet",
                      note: dict | None = None, record: Callable[[dict], None] | None = None,
                      only: Callable[[str], Iterable[tuple[str, ...]]] | None = None,
                      places: list[str] | None = None) -> int:
    """Stage, verify, then replace only the staged partitions in ``target`` and verify
    them there; whatever a crash leaves, ``journal.recover`` finishes or takes back.

    ``only(staging)``: which of the staged partitions to publish (default: all; the
    others are dropped with the staging). ``places`` gets the published directories.
    ``note`` and ``record``: see ``journal.publish``.
    Returns the number of staged rows."""
    written = _observed_write(spark, df, staging, partition_by, "errorifexists", sort_within, fmt)
    if not written[0]:
        remove_path(spark, staging)
        return 0
    _compare("read-back", staging, read_back(spark, staging, df.schema, fmt, partition_by), written)
    some = None if only is None else list(only(staging))
    expected = written
    if some is not None:
        dirs = ["/".join([staging.rstrip("/"), *names]) for names in some]
        expected = (read_back(spark, staging, df.schema, fmt, partition_by, dirs) if dirs
                    else (0, 0, 0, 0))

    def verify(published: list[str]) -> None:
        if published:
            _compare("published", target,
                     read_back(spark, target, df.schema, fmt, partition_by, published), expected)
    done = publish(spark, staging, target, len(partition_by), some, note, verify, record)
    if places is not None:
        places += done
    return written[0]


def archive_raw(df: DataFrame, archive_path: str, date_col: str = PART_COL) -> None:
    """The incoming rows unchanged under ``ingest_date=YYYY-MM-DD``, their trading
    date: a day that is delivered again replaces its archive."""
    named = df.withColumn("ingest_date", F.col(date_col).cast("string")).drop(date_col)
    write_parquet(named, archive_path, ["ingest_date"], "overwrite")
