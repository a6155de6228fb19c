"""Incremental ingest of newly landed bar files.

A file-source stream picks up only files it has not seen (tracked in the
checkpoint), ``trigger(availableNow=True)`` processes everything landed so
far and stops, and each micro-batch runs the exact batch merge (existing rows
win, history-wide per natural key) through ``foreachBatch``. Running the
stream twice adds nothing the second time.

The first arrival wins: the stream takes files in the order in which they were written,
earlier batches are history to later ones, and inside a batch rows are ordered by their
file's time of writing, its path, and their place in it (``with_arrival``), not by
the order in which Spark deals files to tasks.

A day may come in any number of files and batches: rows of a day that the ledger has are
merged by key like the first ones. Rows without a date, and those of a day that history
holds with another row count while the ledger lacks it (``mismatch``), go to
``quarantine_path`` under the stream's id and the batch's number. A batch that is replayed
after its rows were published, but not recorded, is recorded from the publish's journal.
Executor loss is covered by the checkpoint: a batch that did not commit is replayed, and
the merge is idempotent.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketbars.plans.ingest import ingest
from marketbars.sinks.storage import Storage
from marketbars.sources.readers import ARRIVAL, place_in_block, with_arrival

_CONTENT, _SEEN = "_content", "_seen"


def drop_redelivered(stream: DataFrame, keys: Sequence[str], within: str) -> DataFrame:
    """``stream`` without rows that repeat one of the last ``within`` ("2 hours") in all
    columns (``ARRIVAL`` apart), from keyed state that forgets older ones.

    The guarantee is weaker than the merge's, in front of which this stands: repeats that
    come later pass, to be dropped by the merge; so do rows that share the key only, whose
    order decides there. Which of several equal rows of one micro-batch passes is open, so
    among such rows and another one of their key in the same batch, any may come first.
    Time is that of processing, not a column's: no row is ever too late for the
    watermark, which would drop it.
    """
    own = [c for c in stream.columns if c not in (ARRIVAL, *keys)]
    content = F.xxhash64(*[F.col(c) for c in own]) if own else F.lit(0).cast("bigint")
    return (stream.withColumn(_CONTENT, content).withColumn(_SEEN, F.current_timestamp())
            .withWatermark(_SEEN, within)
            .dropDuplicatesWithinWatermark([*keys, _CONTENT]).drop(_CONTENT, _SEEN))


def stream_ingest(spark: SparkSession, source_path: str, schema: StructType,
                  history_path: str, ledger_path: str, checkpoint_path: str,
                  target: str, keys: Sequence[str], fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, date_of=None,
                  quarantine_path: str | None = None, processed_dir: str | None = None,
                  redelivered_within: str | None = None) -> list[dict]:
    """``processed_dir``: committed source files are moved there (the file
    source's ``cleanSource=archive``), so the landing folder, and the listing
    the stream repeats on every trigger, stays the size of the unprocessed
    backlog instead of growing with everything ever landed.
    ``redelivered_within``: drop rows that repeat one of that time before the merge
    sees them (``drop_redelivered``). Returns the batches' progress reports."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if processed_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", processed_dir)
    stream = with_arrival(reader.load(source_path), fmt)
    if redelivered_within is not None:
        stream = drop_redelivered(stream, keys, redelivered_within)

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        if fmt != "parquet" and redelivered_within is None:
            batch = place_in_block(batch)
        # evaluated once, by the ingest, which keeps it: state is not read again.
        # The stream's own id, from its checkpoint: no two streams share a batch
        meta = Storage(spark, checkpoint_path).read(f"{checkpoint_path.rstrip('/')}/metadata")
        ingest(spark, batch, history_path, ledger_path, target, keys, date_of=date_of,
               quarantine_path=quarantine_path, repair=True, merge_ledgered=True,
               batch_id=f"{json.loads(meta)['id']}-{epoch_id}")

    q = (stream.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return [json.loads(p.json) for p in q.recentProgress]
