"""Folders as Spark sees them: the few file operations that tables of the library need, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder at a path that any of Spark's file systems reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._make = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._make(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def names(self, pattern: str = "*") -> list[str]:
        """Sorted names in the folder that fit a glob pattern; none if there is no folder."""
        found = self._fs.globStatus(self._make(self.at(pattern)))
        return sorted(f.getPath().getName() for f in found or ())

    def has(self, name: str) -> bool:
        return self._fs.exists(self._make(self.at(name)))

    def rename(self, old: str, new: str) -> bool:
        return self._fs.rename(self._make(self.at(old)), self._make(self.at(new)))

    def remove(self, name: str) -> None:
        self._fs.delete(self._make(self.at(name)), True)

    def make(self) -> None:
        self._fs.mkdirs(self._make(self.path))
