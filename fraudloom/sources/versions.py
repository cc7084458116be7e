"""Numbered versions of a stored table, each a small JSON file that names its folders.

The newest file is the pointer. A version is written next to its target and
renamed without overwriting: readers see the version before or the whole new
one, and of two writers of the same number one fails.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Folder:
    """A folder of the shared file system, through Spark's own file system classes."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._at().getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """What the folder holds; nothing if it is not there."""
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def holds(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """Write a file that must not be there yet."""
        waiting = self._at(f".{name}.tmp")
        stream = self._fs.create(waiting, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        no_options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        self._context.rename(waiting, self._at(name), no_options)


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        """All published versions, oldest first."""
        return [int(n.removesuffix(".json")) for n in self.folder.names() if n.endswith(".json") and n[0] != "."]

    def newest(self) -> int | None:
        return max(self.numbers(), default=None)

    def read(self, number: int) -> dict:
        return json.loads(self.folder.read(f"{number:010d}.json"))

    def publish(self, number: int, content: dict) -> None:
        self.folder.write_new(f"{number:010d}.json", json.dumps(content, sort_keys=True))

    def forget(self, number: int) -> None:
        self.folder.delete(f"{number:010d}.json")
