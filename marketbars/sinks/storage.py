"""A few file operations on any Hadoop file system, for small files and folders."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Storage:
    """The file system of ``path``. Paths are full; results are full paths too."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at(path).getFileSystem(self._conf)

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def same_as(self, path: str) -> bool:
        other = self._at(path).getFileSystem(self._conf)
        return other.getUri().toString() == self._fs.getUri().toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._at(path))

    def names(self, path: str, folders: bool | None = None) -> list[str]:
        """Names directly under ``path``; of folders or of files only, if said."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(path))
                      if folders is None or s.isDirectory() == folders)

    def move(self, source: str, target: str) -> None:
        """Move a file or folder to a place that is free."""
        place = self._at(target)
        self._fs.mkdirs(place.getParent())
        if self._fs.exists(place) or not self._fs.rename(self._at(source), place):
            raise OSError(f"could not move {source} to {target}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._at(path), True)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A small new file, complete or not there: written aside, then renamed."""
        folder, name = path.rsplit("/", 1)
        aside = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self._fs.mkdirs(self._at(folder))
        stream = self._fs.create(self._at(aside), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        self.move(aside, path)


def partitions(storage: Storage, path: str, depth: int) -> list[tuple[str, ...]]:
    """Names of the ``column=value`` folders ``depth`` levels down."""
    if not depth:
        return [()]
    return [(name, *rest) for name in storage.names(path, folders=True)
            if "=" in name and not name.startswith(("_", "."))
            for rest in partitions(storage, f"{path}/{name}", depth - 1)]
