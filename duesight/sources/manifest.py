"""Numbered manifests: which files of a folder count, switched at one moment.

A writer puts its files where no reader looks, then publishes a manifest that names them. Manifest ``n`` is created under a
name that must not exist yet, so of two writers that start from the same state only one succeeds. A manifest cut
off by a crash does not end with its check sum and is passed over: readers stay with the one before it.
"""

from __future__ import annotations

import json
import zlib
from typing import Any

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published first."""


class Manifests:
    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._root = folder.rstrip("/")
        self._folder = f"{self._root}/_manifests"
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{name}" if name else self._folder)

    def has(self, name: str) -> bool:
        """Is there such a folder beside the manifests?"""
        return self._files.exists(self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}"))

    def sweep(self, folder: str, keep: set[str]) -> list[str]:
        """Delete what lies in ``folder`` and isn't in ``keep`` (names under the folder of the manifests), when no writer is at work."""
        if not self.has(folder):
            return []
        gone = []
        for status in self._files.listStatus(self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{folder}")):
            name = f"{folder}/{status.getPath().getName()}"
            if name not in keep:
                self._files.delete(status.getPath(), True)
                gone.append(name)
        return gone

    def _numbers(self) -> list[int]:
        if not self._files.exists(self._path("")):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._path(""))]
        return sorted((int(name) for name in names if name.isdigit()), reverse=True)

    def _read(self, number: int) -> dict[str, Any] | None:
        stream = self._files.open(self._path(f"{number:012d}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        body, _, check = text.rpartition("\n")
        return json.loads(body) if check == str(zlib.crc32(body.encode())) else None

    def latest(self) -> tuple[int, dict[str, Any] | None]:
        """The highest number in use, and what the last whole manifest says (None if there is none)."""
        numbers = self._numbers()
        for number in numbers:
            state = self._read(number)
            if state is not None:
                return numbers[0], state
        return (numbers[0] if numbers else 0), None

    def publish(self, after: int, state: dict[str, Any]) -> int:
        """Make ``state`` the latest one, if ``after`` is still the highest number in use."""
        body = json.dumps(state, sort_keys=True)
        path = self._path(f"{after + 1:012d}")
        if self._numbers()[:1] not in ([], [after]):
            raise Conflict(f"manifest {after + 1} exists")
        try:
            stream = self._files.create(path, False)
        except Exception as error:
            if self._files.exists(path):
                raise Conflict(f"manifest {after + 1} exists") from error
            raise
        stream.write(f"{body}\n{zlib.crc32(body.encode())}".encode())
        stream.close()
        return after + 1
