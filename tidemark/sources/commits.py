"""A small log of committed states in a folder of any file system that Spark reaches.

Every commit is a numbered file, written under another name and renamed, with a checksum of what
it says. A reader takes the newest entry that is whole; what a crash or a damaged disk leaves is
passed over. One writer at a time is assumed, as for a stream's checkpoint.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

from pyspark.sql import SparkSession

#: Entries that stay in the log.
KEEP = 20


class Folder:
    """The few file operations that need no DataFrame."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str = ""):
        target = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return target.getFileSystem(self._conf), target

    def names(self) -> list[str]:
        """Files and folders directly below, sorted; none where the folder does not exist."""
        fs, target = self._at()
        if not fs.exists(target):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(target))

    def stamps(self) -> list[tuple[str, int, int]]:
        """Path, bytes and time of change of every file here and below, sorted."""
        fs, target = self._at()
        if not fs.exists(target):
            return []
        found, files = [], fs.listFiles(target, True)
        while files.hasNext():
            status = files.next()
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
        return sorted(found)

    def read(self, name: str) -> str:
        fs, target = self._at(name)
        stream = fs.open(target)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The whole file or none: written as a hidden file, then renamed."""
        fs, hidden = self._at(f".{name}.tmp")
        stream = fs.create(hidden, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        _, target = self._at(name)
        if not fs.rename(hidden, target):
            raise OSError(f"{self.path}/{name} cannot be written: it exists")

    def delete(self, name: str) -> None:
        fs, target = self._at(name)
        fs.delete(target, True)


def _seal(state: dict) -> str:
    text = json.dumps(state, sort_keys=True)
    return json.dumps({"state": state, "crc32": zlib.crc32(text.encode())}, sort_keys=True)


def _open(text: str) -> dict | None:
    try:
        entry = json.loads(text)
        state = entry["state"]
        whole = zlib.crc32(json.dumps(state, sort_keys=True).encode()) == entry["crc32"]
    except (ValueError, KeyError, TypeError):
        return None
    return state if whole and isinstance(state, dict) else None


def _entries(folder: Folder) -> list[str]:
    return [n for n in folder.names() if n.endswith(".json") and n[:-5].isdigit()]


def commit(spark: SparkSession, path: str, state: dict) -> int:
    """Append ``state`` to the log at ``path``; returns its number."""
    folder = Folder(spark, path)
    known = _entries(folder)
    number = int(known[-1][:-5]) + 1 if known else 0
    folder.write(f"{number:020d}.json", _seal(state))
    for name in known[:max(0, len(known) + 1 - KEEP)]:
        folder.delete(name)
    return number


def committed(spark: SparkSession, path: str) -> Iterator[dict]:
    """The whole entries of the log at ``path``, newest first."""
    folder = Folder(spark, path)
    for name in reversed(_entries(folder)):
        state = _open(folder.read(name))
        if state is not None:
            yield state
