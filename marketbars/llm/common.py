"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketbars.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# byte tables: A-Z to a-z, and every byte that separates words to a space;
# bytes from 0x80 on (parts of non-ASCII characters) belong to words
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can
    import it wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(target))       # Spark's own file server hands it out
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so
    a lost executor costs the tasks at hand and nothing upstream."""
    path = scratch_path(df.sparkSession, name)
    with arrow_rows(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROW = "_row_id"
_AFTER = 1 << 62        # row ids from here on are those of rows without an id of their own


def row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, and at most a struct ``row``: other names might clash with
    those used here) with ``ROW``, a long that tells rows apart, so that what is decided of
    one row isn't done to another: the doc_id, if no other row has it. Of rows that share a
    doc_id, one keeps it; the others, and rows without a doc_id, get ids behind all
    others, made from doc_id, text and, for rows that agree in both, their number.

    Only rows that share an id or have none are shuffled with their texts. Tables of
    unique ids cost one count of the ids."""
    own = docs.withColumn(ROW, F.col("doc_id").cast("long"))
    tag = F.xxhash64("text")
    shared = stage(own.groupBy(ROW).agg(F.count(F.lit(1)).alias("_n"), F.min(tag).alias("_first"))
                   .where(F.col(ROW).isNull() | (F.col("_n") > 1)), "shared-ids")
    if shared.isEmpty():
        return own
    # a null id is written as another long that no id of a shared one is: joins drop nulls
    none = F.lit(-1 << 63)
    names = shared.select(F.coalesce(ROW, none).alias("_id"), F.col(ROW).isNull().alias("_null"), "_first")
    keyed = own.withColumn("_id", F.coalesce(ROW, none)).withColumn("_null", F.col(ROW).isNull())
    alone = keyed.join(names, ["_id", "_null"], "left_anti")
    equal = Window.partitionBy("_id", "_null", "_tag").orderBy(F.lit(0))
    others = (keyed.join(names, ["_id", "_null"]).withColumn("_tag", tag)
              .withColumn("_copy", F.row_number().over(equal)))
    made = (F.xxhash64(ROW, "_tag", "_copy").bitwiseAND(F.lit(_AFTER - 1)).bitwiseOR(F.lit(_AFTER)))
    keeps = ~F.col("_null") & (F.col("_tag") == F.col("_first")) & (F.col("_copy") == 1)
    others = others.withColumn(ROW, F.when(keeps, F.col(ROW)).otherwise(made))
    return (alone.drop("_id", "_null")
            .unionByName(others.drop("_id", "_null", "_first", "_tag", "_copy")))


ARROW_ROWS = 2_000
ARROW_BYTES = 4 << 20


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = ARROW_ROWS,
               size: int = ARROW_BYTES) -> Iterator[None]:
    """Python gets whole texts in batches of fewer rows and bytes than usual: with long
    texts, a batch and what is made of it would take most of a small executor's memory.
    A row of any size still comes whole."""
    own = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows,
           "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {key: spark.conf.get(key) for key in own}
    for key, most in own.items():
        old = int(before[key].rstrip("b")) if before[key] else 0
        spark.conf.set(key, str(min(most, old) if old > 0 else most))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def alnum_words(text: bytes) -> list[bytes]:
    """The runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z."""
    return text.translate(WORD_BYTES).split()


def space_words(text: bytes) -> list[bytes]:
    """The runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z."""
    return text.translate(LOWER_BYTES).split()


def binary_rows(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    """The string column ``name`` as UTF-8 bytes, one row at a time."""
    column = batch.column(batch.schema.get_field_index(name))
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type)
                             else pa.binary()):
        yield value.as_py()


def record_batches(rows: Iterable[tuple], schema: pa.Schema,
                   size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """``rows`` in record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(zip(*rows), schema)],
        schema=schema)
