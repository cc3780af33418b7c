"""A table as a folder of batches: writers only ever add whole batches, so any number of them may write at once.

A batch is written under a name that readers skip and then renamed, so readers see all of it or nothing.  Merging writes what several batches
hold as a new batch and removes those alone that it has read; a batch that arrives meanwhile stays, and rows that
are read twice between the two steps are the same rows, which readers that take the latest row of a key don't notice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .hadoop import Folder


class BatchLog:
    """Rows of one schema in a folder; each has ``_at``, when it was written, and ``_batch``."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.folder = spark, Folder(spark, path)
        self.schema = f"{schema}, _at timestamp, _batch string"
        self.columns = spark.createDataFrame([], schema).columns

    def batches(self) -> list[str]:
        return self.folder.names("batch=*")

    def append(self, rows: DataFrame) -> str:
        """Add the rows as a batch; gives its name."""
        name = uuid.uuid4().hex
        return self._add(rows.select(*self.columns).withColumns({"_at": F.current_timestamp(), "_batch": F.lit(name)}), name)

    def _add(self, rows: DataFrame, name: str) -> str:
        self.folder.make()
        rows.write.parquet(self.folder.at(f"_writing-{name}"))
        if not self.folder.rename(f"_writing-{name}", f"batch={name}"):
            raise OSError(f"batch {name} couldn't be put in its place")
        return f"batch={name}"

    def read(self, batches: list[str] | None = None) -> DataFrame:
        """All rows, or those of the batches named."""
        found = self.batches() if batches is None else batches
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("ignoreMissingFiles", True).parquet(*[self.folder.at(b) for b in found])

    def latest(self, keys: list[str], batches: list[str] | None = None) -> DataFrame:
        """The row of each key that was written last; of rows written at once that of the greatest batch, then the greatest row."""
        rows = self.read(batches)
        rest = [c for c in self.columns if c not in keys]
        order = F.struct("_at", "_batch", *rest)
        last = rows.groupBy(*keys).agg(F.max(order).alias("l"))
        return last.select(*keys, *[F.col(f"l.{c}").alias(c) for c in rest], "l._at", "l._batch")

    def merge(self, keys: list[str]) -> str | None:
        """Put the batches there are into one that holds the latest row of each key; gives its name."""
        found = self.batches()
        if len(found) < 2:
            return None
        name = self._add(self.latest(keys, found).select(*self.columns, "_at", "_batch"), uuid.uuid4().hex)
        for b in found:
            self.folder.remove(b)
        return name
