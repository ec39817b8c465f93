"""Versioned folders that make a micro-batch repeatable.

Everything a batch writes goes below its own number and replaces what an earlier
attempt of the same batch left there; everything it reads comes from lower
numbers. Running a batch twice therefore gives the same result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Store:
    root: str

    def path(self, table: str, batch: int | None = None) -> str:
        base = f"{self.root}/{table}"
        return base if batch is None else f"{base}/batch={batch}"

    def batches(self, spark: SparkSession, table: str) -> list[int]:
        """Numbers of the complete batches of a table."""
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(table))
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        marks = fs.globStatus(
            spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/batch=*/_SUCCESS")
        )
        return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in marks)

    def before(self, spark: SparkSession, table: str, batch: int) -> list[int]:
        return [b for b in self.batches(spark, table) if b < batch]

    def latest_before(self, spark: SparkSession, table: str, batch: int) -> int | None:
        earlier = self.before(spark, table, batch)
        return earlier[-1] if earlier else None

    def write(self, rows: DataFrame, table: str, batch: int) -> DataFrame:
        """Write a batch and read it back, which also cuts the lineage."""
        rows.write.mode("overwrite").parquet(self.path(table, batch))
        return rows.sparkSession.read.parquet(self.path(table, batch))

    def read_before(self, spark: SparkSession, table: str, batch: int) -> DataFrame | None:
        """All rows of a table from complete batches below ``batch``."""
        known = self.before(spark, table, batch)
        return self._read(spark, table, known).drop("batch") if known else None

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """All rows of a table's complete batches, with their ``batch``."""
        return self._read(spark, table, self.batches(spark, table))

    def _read(self, spark: SparkSession, table: str, batches: list[int]) -> DataFrame:
        reader = spark.read.option("basePath", self.path(table))
        return reader.parquet(*[self.path(table, b) for b in batches])


#: Runs of one size that are merged into one of the next.
FAN = 8


@dataclass(frozen=True)
class Levels:
    """A table that each batch adds a run to, kept in few runs of growing size.

    A batch writes its own rows. When ``fan`` runs of one level are there, they are
    merged into one of the next, so a row is written again once a level, and a reader
    meets at most ``fan - 1`` runs of each of a few levels. What is merged when follows
    from the batch's number alone; numbers have to follow each other from 0.
    """

    store: Store
    table: str
    fan: int = FAN

    def _level(self, level: int) -> str:
        return f"{self.table}/level={level}"

    def write(
        self, rows: DataFrame, batch: int, merge: Callable[[list[DataFrame]], DataFrame] | None
    ) -> DataFrame:
        """Write a batch's run, and the runs that it completes."""
        spark = rows.sparkSession
        own = self.store.write(rows, self._level(0), batch)
        level, size = 1, self.fan
        while merge and (batch + 1) % size == 0:
            ends = range(batch - size + size // self.fan, batch + 1, size // self.fan)
            parts = [spark.read.parquet(self.store.path(self._level(level - 1), b)) for b in ends]
            self.store.write(merge(parts), self._level(level), batch)
            level, size = level + 1, size * self.fan
        return own

    def runs(self, before: int) -> list[tuple[int, int]]:
        """Level and last batch of each run that holds batches below ``before``, oldest first."""
        found, at, size, level = [], 0, 1, 0
        while size * self.fan <= before:
            size, level = size * self.fan, level + 1
        while size:
            while at + size <= before:
                at += size
                found.append((level, at - 1))
            size, level = size // self.fan, level - 1
        return found

    def read_before(self, spark: SparkSession, batch: int) -> list[DataFrame]:
        return [spark.read.parquet(self.store.path(self._level(k), b)) for k, b in self.runs(batch)]
