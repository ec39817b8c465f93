"""What the operators share: reading tables and storing intermediate frames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicsieve.session import scratch_path

#: The white space of the contracts, space and code points 9 to 13.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file, the same on every machine."""
    return public_tokenizers.path(name)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


#: Folders that the innermost open ``scratch`` has to free, with a table's name if any.
_made: ContextVar[dict[str, str | None] | None] = ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Free the tables stored within at the end.

    ``with scratch(spark) as keep: ... result = keep(df, label)`` stores ``df`` for the
    scratch around, if any. Frames that read freed tables cannot be used any more.
    """
    made: dict[str, str | None] = {}
    token = _made.set(made)

    def keep(df: DataFrame, label: str) -> DataFrame:
        inner = _made.set(token.old_value if token.old_value is not token.MISSING else None)
        try:
            return stored(df, label)
        finally:
            _made.reset(inner)

    try:
        yield keep
    finally:
        _made.reset(token)
        for path, name in made.items():
            if name:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _noted(path: str, name: str | None = None) -> str:
    """``path``, which the innermost open ``scratch`` frees."""
    made = _made.get()
    if made is not None:
        made[path] = name
    return path


#: Whether Spark deletes an execution's shuffle files at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Executions within leave no shuffle files; for those that are not run again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table below the shared scratch folder and read back.

    Cuts the lineage like a checkpoint, survives the loss of any executor, and
    gives later joins plain scans, whose skewed partitions Spark can split. What was
    shuffled for it is freed once it is written.
    """
    path = _noted(scratch_path(df.sparkSession, label))
    with _shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` stored in buckets of ``key``, so that joins on it do not shuffle it again.

    The files are below the shared scratch folder; a surrounding ``scratch`` frees them
    and the catalog entry. Rows are dealt by ``key`` first, so a task writes few files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "buckets")
    name = "buckets_" + path.rpartition("-")[2]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _shuffles_freed(spark):
        df.repartition(n, key).write.bucketBy(n, key).option("path", _noted(path, name)).saveAsTable(name)
    return spark.table(name)


def slices(
    batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` (texts, bytes or lists of numbers) has few bytes in each part, or one row."""
    for batch in batches:
        cut = batch[column]
        listed = pa.types.is_list(cut.type)
        sizes = pc.list_value_length(cut) if listed else pc.binary_length(cut)
        width = cut.type.value_type.bit_width // 8 if listed else 1
        ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64) * width
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
            # copied, so that offsets begin at the part's own first row
            yield pa.Table.from_batches([batch.slice(start, end - start)]).take(
                pa.array(range(end - start), pa.int64())
            ).combine_chunks().to_batches()[0]
            start = end
