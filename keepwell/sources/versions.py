"""A log of a table's versions: one small file for each, named by its number.

A version exists from the moment its file does, complete and for good. Writers name the version they
started from; of two that started from the same one, the second is refused. What a writer
stored before it died is named by no version and therefore seen by nobody.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession

from keepwell.sources.files import SharedFiles

DIGITS = 12


class ConcurrentUpdate(RuntimeError):
    """Somebody else has added a version since this update began."""


class VersionLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.files = SharedFiles(spark)
        self.folder = folder.rstrip("/")

    def _path(self, version: int) -> str:
        return f"{self.folder}/{version:0{DIGITS}d}.json"

    def versions(self) -> list[int]:
        names = (name.removesuffix(".json") for name in self.files.names(self.folder) if name.endswith(".json"))
        return sorted(int(name) for name in names if name.isdigit())

    def latest(self) -> int:
        """Number of the newest version, 0 if there is none."""
        return max(self.versions(), default=0)

    def entry(self, version: int) -> dict[str, Any]:
        return json.loads(self.files.read(self._path(version)))

    def entries(self) -> dict[int, dict[str, Any]]:
        return {version: self.entry(version) for version in self.versions()}

    def commit(self, entry: dict[str, Any], after: int) -> int:
        """Add the version that follows `after`."""
        version = after + 1
        if self.latest() != after or not self.files.write_new(self._path(version), json.dumps(entry, sort_keys=True)):
            raise ConcurrentUpdate(f"{self.folder}: version {version} is there already or {after} is not the newest")
        return version

    def forget(self, version: int) -> None:
        self.files.delete(self._path(version))
