"""Exact deduplication by a tree-merge of sorted digest runs, in DataFrame operations only.

Each task sorts the digests of its texts and folds equal neighbours to one entry with
the smallest identifier and the number of rows: a run. Runs are merged in binomial
rounds, ``FAN_IN`` at a time: tasks exchange their runs by digest, sort what came in and
fold equal neighbours again, so the smallest identifier is kept at every level. The last
round leaves one run, spread over all tasks by digest. A digest that fills a third of the
table is one entry of a run from the first sort on.

The smallest identifier is taken of a structure, which Spark folds in sort order
(``SortAggregate``) before and after each exchange; there are no hash tables.

A digest is verified at every level: only rows whose SHA-256, length and a second,
independent 64-bit hash agree are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicsieve.llm.frames import BLANKS, stored, text_or_empty

RUNS = 64
FAN_IN = 4
KEY = ("text_sha256", "text_length", "text_check")


def text_digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the digest of each normalised text (null counts as empty)."""
    text = F.regexp_replace(text_or_empty(), BLANKS, " ")
    return docs.select(
        "doc_id",
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
        F.length(text).alias("text_length"),
        F.xxhash64(text).alias("text_check"),
    )


def folded(entries: DataFrame) -> DataFrame:
    """Sorted runs with equal neighbours folded to one entry."""
    return entries.groupBy("run", *KEY).agg(
        F.min("keep").alias("keep"), F.sum("group_size").alias("group_size")
    )


def merged_digests(digests: DataFrame, runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct digest: smallest identifier and number of rows."""
    level = folded(
        digests.select(
            F.pmod(F.spark_partition_id(), F.lit(runs)).cast("long").alias("run"),
            *KEY,
            F.struct(F.col("doc_id").alias("keep_id")).alias("keep"),
            F.lit(1).cast("long").alias("group_size"),
        ).withColumn("keep", F.when(F.col("keep.keep_id").isNotNull(), F.col("keep")))
    )
    while runs > 1:
        level = folded(level.withColumn("run", F.floor(F.col("run") / fan_in)))
        runs = -(-runs // fan_in)
    return level.select(*KEY, F.col("keep.keep_id").alias("keep_id"), "group_size")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the group of equal texts it belongs to.

    Returns ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.
    Null texts count as empty ones. Rows repeated with the smallest identifier are
    all kept; rows without an identifier are dropped if a row with one has their
    text, and kept otherwise. Texts of any length are read whole; an empty table gives
    an empty one. Other columns of ``docs`` are not looked at.
    """
    digests = stored(text_digests(docs), "digests")
    groups = stored(merged_digests(digests), "digest-groups")
    return digests.join(groups, list(KEY)).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
