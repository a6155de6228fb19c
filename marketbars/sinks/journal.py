"""Publishing staged partitions under a journal.

A folder can't be replaced in one step: the old one moves aside, then the staged one
into its place. So a publish first writes down what it is about to do
(``_publish/<id>/intent.json`` under the target: the staged folder, its partitions, which
of them replace an old one, and a note of the caller's), then moves partition by
partition, keeping the old ones under ``_publish/<id>/old``, then lets the caller verify
and record, and only then renames the intent to ``done.json`` and clears up.

``recover`` runs before anything reads or changes the target. It clears up after a
publish that was done, finishes one whose staged partitions are all still there or
moved (and has the caller's note acted on), and takes back every other one: each old
partition returns to its place. Whatever step a crash stops, readers' partitions are
whole after ``recover``, the old rows or the new.

Folders that start with ``_`` and hold no ``=`` are not read as data by Spark, so a crash
leaves nothing that readers stumble on but a partition that is missing until ``recover``.
A target has one writer at a time. Renames must be atomic for a folder (HDFS, local
disks, object stores with real folders).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from marketbars.session import scratch_path
from marketbars.sinks.storage import Storage, partitions

JOURNAL = "_publish"
MOVES = 16              # partitions moved at once
_ASIDE = "_old."        # how earlier versions set partitions aside, beside their place


class WriteError(RuntimeError):
    pass


def staging_path(spark: SparkSession, target: str, name: str = "stage") -> str:
    """A fresh folder for rows to be published into ``target``: in the shared folder, or
    beside the journal where that is on another file system (nothing can be moved
    from one to another)."""
    shared = scratch_path(spark, name)
    if Storage(spark, target).same_as(shared):
        return shared
    return f"{target.rstrip('/')}/{JOURNAL}/{name}-{uuid.uuid4().hex}"


class _Publish:
    """One journalled publish: ``entry`` is its folder in the journal."""

    def __init__(self, storage: Storage, target: str, entry: str, intent: dict):
        self.storage, self.target, self.entry = storage, target, entry
        self.staging, self.note = intent["staging"], intent.get("note")
        self.parts = [(tuple(names), had) for names, had in intent["partitions"]]

    def _paths(self, names) -> tuple[str, str, str]:
        return tuple("/".join([base, *names])
                     for base in (self.staging, self.target, f"{self.entry}/old"))

    def _moved(self, names, had: bool) -> bool:
        """The staged partition stands in its place (an old one lies aside, if there was
        one)."""
        staged, place, old = self._paths(names)
        return (not self.storage.exists(staged) and self.storage.exists(place)
                and (not had or self.storage.exists(old)))

    def can_finish(self) -> bool:
        return all(self.storage.exists(self._paths(names)[0]) or self._moved(names, had)
                   for names, had in self.parts)

    def move(self) -> list[str]:
        """Move what isn't moved yet; the places of all partitions."""
        def one(names) -> None:
            staged, place, old = self._paths(names)
            if not self.storage.exists(staged):
                return                          # moved before a crash
            if self.storage.exists(place):
                self.storage.move(place, old)
            self.storage.move(staged, place)
        with ThreadPoolExecutor(MOVES) as pool:     # waits for all, then raises
            for done in [pool.submit(one, names) for names, _ in self.parts]:
                done.result()
        return [self._paths(names)[1] for names, _ in self.parts]

    def take_back(self) -> None:
        for names, had in self.parts:
            staged, place, old = self._paths(names)
            if self.storage.exists(old):
                if self.storage.exists(place):
                    self.storage.remove(place)
                self.storage.move(old, place)
            elif not had and self._moved(names, had):
                self.storage.remove(place)
        self.close()

    def close(self) -> None:
        """Done: the rest is clearing up, which ``recover`` repeats after a crash."""
        if self.storage.exists(f"{self.entry}/intent.json"):
            self.storage.move(f"{self.entry}/intent.json", f"{self.entry}/done.json")
        self.storage.remove(self.staging)
        self.storage.remove(self.entry)


def publish(spark: SparkSession, staging: str, target: str, depth: int,
            only: Iterable[tuple[str, ...]] | None = None, note: dict | None = None,
            verify: Callable[[list[str]], None] | None = None,
            record: Callable[[dict], None] | None = None) -> list[str]:
    """Move the staged ``column=value`` folders (``depth`` levels; those in ``only``) into
    ``target`` in place of the old ones. Returns their places.

    ``verify(places)`` raises to have the old partitions back; ``record(note)`` acts on the
    note: if it raises, the publish stays in the journal, and ``recover`` records it.
    """
    storage, target, staging = Storage(spark, target), target.rstrip("/"), staging.rstrip("/")
    if not storage.same_as(staging):
        raise WriteError(f"{staging} and {target} are on different file systems")
    recover(spark, target, depth, record, keep=staging)
    wanted = None if only is None else set(only)
    parts = [(names, storage.exists("/".join([target, *names])))
             for names in partitions(storage, staging, depth)
             if wanted is None or names in wanted]
    intent = {"staging": staging, "partitions": parts, "note": note}
    entry = f"{target}/{JOURNAL}/{uuid.uuid4().hex}"
    storage.write(f"{entry}/intent.json", json.dumps(intent))
    own = _Publish(storage, target, entry, intent)
    places = own.move()
    if verify is not None:
        try:
            verify(places)
        except WriteError:
            own.take_back()
            raise
    if record is not None and note is not None:
        record(note)
    own.close()
    return places


def recover(spark: SparkSession, target: str, depth: int = 1,
            record: Callable[[dict], None] | None = None,
            keep: str | None = None) -> list[tuple[str, str]]:
    """Finish or take back what a crash has left of earlier publishes into ``target``
    (``keep``: staged rows that are about to be published).
    Returns (what was done, place) pairs: ``finished``, ``taken back``, ``restored``."""
    storage, target = Storage(spark, target), target.rstrip("/")
    out = []
    for name in storage.names(f"{target}/{JOURNAL}", folders=True):
        entry = f"{target}/{JOURNAL}/{name}"
        if entry == keep:
            continue
        if not storage.exists(f"{entry}/intent.json"):
            storage.remove(entry)       # done, or staged rows without an intent
            continue
        own = _Publish(storage, target, entry, json.loads(storage.read(f"{entry}/intent.json")))
        if own.can_finish():
            out += [("finished", place) for place in own.move()]
            if record is not None and own.note is not None:
                record(own.note)
            own.close()
        else:
            out += [("taken back", "/".join([target, *names])) for names, _ in own.parts]
            own.take_back()
    out += [("restored", place) for place in _restore(storage, target, depth)]
    return out


def _restore(storage: Storage, path: str, depth: int) -> list[str]:
    """Partitions set aside beside their place: back, if the place is empty."""
    out = []
    for name in storage.names(path, folders=True):
        if name.startswith(_ASIDE):
            place = f"{path}/{name[len(_ASIDE):]}"
            if storage.exists(place):
                storage.remove(f"{path}/{name}")
            else:
                storage.move(f"{path}/{name}", place)
                out.append(place)
        elif depth > 1 and "=" in name:
            out += _restore(storage, f"{path}/{name}", depth - 1)
    return out
