"""Small files and folders in the cluster's shared storage, through the file systems Spark is configured with."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SharedFiles:
    def __init__(self, spark: SparkSession):
        self._context = spark.sparkContext

    @property
    def _hadoop(self):
        return self._context._jvm.org.apache.hadoop.fs

    def _open(self, path: str):
        at = self._hadoop.Path(path)
        return at.getFileSystem(self._context._jsc.hadoopConfiguration()), at

    def listing(self, folder: str) -> list[tuple[str, int, int]]:
        """Name, size and time of change of what a folder holds; nothing for a missing one."""
        system, at = self._open(folder)
        if not system.exists(at):
            return []
        return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in system.listStatus(at))

    def names(self, folder: str) -> list[str]:
        return [name for name, _, _ in self.listing(folder)]

    def read(self, path: str) -> str:
        system, at = self._open(path)
        stream = system.open(at)
        try:
            return self._context._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Make a file with this content at once, or return False because there is one.

        The content is complete before it gets its name, and the renaming refuses a name in use.
        """
        system, at = self._open(path)
        draft = self._hadoop.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
        stream = system.create(draft, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        kind = getattr(self._hadoop, "Options$Rename")
        careful = self._context._gateway.new_array(kind, 1)
        careful[0] = getattr(kind, "NONE")
        context = self._hadoop.FileContext.getFileContext(system.getUri(), self._context._jsc.hadoopConfiguration())
        try:
            context.rename(draft, at, careful)
        except Exception as refused:
            system.delete(draft, False)
            if "FileAlreadyExistsException" in str(refused):
                return False
            raise
        return True

    def exists(self, path: str) -> bool:
        system, at = self._open(path)
        return system.exists(at)

    def rename(self, path: str, new: str) -> None:
        """Give a file or folder a name that is not in use, at once."""
        system, at = self._open(path)
        place = self._hadoop.Path(new)
        system.mkdirs(place.getParent())
        if system.exists(place) or not system.rename(at, place):
            raise FileExistsError(new)

    def delete(self, path: str) -> None:
        system, at = self._open(path)
        system.delete(at, True)
