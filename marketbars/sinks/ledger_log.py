"""The ingest ledger as a log: one small file per recorded batch, never rewritten.

A ledger is the union of the dates in its folder's files, so writers only ever add a file
(complete or not there at all), and two of them lose nothing of each other's. ``compact``
adds a snapshot of everything recorded so far; the files that a snapshot holds are
deleted when the next one stands, so whoever listed the folder before a snapshot
was written still finds every file, and a crash at any step leaves files twice, which
the union doesn't mind, but never a date not at all.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from marketbars.operators.ledger import dump_ledger, parse_ledger
from marketbars.session import remove_path, scratch_path
from marketbars.sinks.storage import Storage
from marketbars.sources.readers import read_ledger

COVERED = "_covered"        # lists of the files that a snapshot holds; hidden from readers
COMPACT_AT = 200            # files


def _files(storage: Storage, path: str) -> list[str]:
    return [n for n in storage.names(path, folders=False) if not n.startswith(("_", "."))]


def append(spark: SparkSession, path: str, dates: Mapping[str, Sequence[str]],
           compact_at: int = COMPACT_AT) -> str:
    """Record the dates of each target: one new file, whose name is returned."""
    storage, path = Storage(spark, path), path.rstrip("/")
    name = f"batch-{uuid.uuid4().hex}.json"
    storage.write(f"{path}/{name}", "".join(
        json.dumps({"target": target, "dates_json": json.dumps(sorted(set(days)))}) + "\n"
        for target, days in sorted(dates.items())))
    if len(_files(storage, path)) > compact_at:
        compact(spark, path)
    return name


def compact(spark: SparkSession, path: str) -> str:
    """Add a snapshot of all that is recorded; delete what the one before holds."""
    storage, path = Storage(spark, path), path.rstrip("/")
    old = storage.names(f"{path}/{COVERED}")
    files = _files(storage, path)
    version = 1 + max((int(n.split("-")[1]) for n in files if n.startswith("snapshot-")), default=0)
    name = f"snapshot-{version:08d}-{uuid.uuid4().hex}.json"
    staged = scratch_path(spark, "ledger")
    rows = dump_ledger(parse_ledger(read_ledger(spark, path)))
    rows.coalesce(1).write.json(staged)     # a date per target and day
    # the listed files were all read, maybe newer ones too
    storage.write(f"{path}/{COVERED}/{name}", json.dumps(files))
    parts = [n for n in Storage(spark, staged).names(staged, folders=False) if n.startswith("part-")]
    text = "".join(Storage(spark, staged).read(f"{staged}/{n}") for n in parts)
    storage.write(f"{path}/{name}", text)
    for listed in old:
        cover = f"{path}/{COVERED}/{listed}"
        # without its snapshot it covers nothing; another compaction may have been here
        if storage.exists(f"{path}/{listed}") and storage.exists(cover):
            for covered in json.loads(storage.read(cover)):
                storage.remove(f"{path}/{covered}")
        storage.remove(cover)
    remove_path(spark, staged)
    return name
