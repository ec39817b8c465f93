"""Comparing pairs of records, and pairs within groups, without listing a group's pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicsieve.llm.components import connected_components
from topicsieve.llm.frames import scratch, slices, stored

T = TypeVar("T")
#: Right records that a left one meets in a task, about.
PARTNERS = 256
#: Blocks that a bucket fills before it gets more than one star round.
STAR_BLOCKS = 8
#: Bytes of a block's values, about; a task holds two blocks.
BLOCK_BYTES = 8 << 20
LINK = "`left` bigint, `right` bigint"


def links_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
    left, right = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_pydict(
        {"left": pa.array(left, pa.int64()), "right": pa.array(right, pa.int64())}
    )


def matching(
    pairs: DataFrame, records: DataFrame, load: Callable[[bytes], T], keep: Callable[[T, T], bool]
) -> DataFrame:
    """The rows (``left``, ``right``) of ``pairs`` whose records ``keep`` takes.

    ``records`` has a ``value`` (binary) for each ``node``. A left record meets its right
    ones in sorted order in a task, one at a time. Where it has more than ``PARTNERS``, the
    right nodes are salted and the left record goes to each salt that occurs, so the
    partners of one node spread over many tasks.
    """
    many = pairs.groupBy("left").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("salts")).where("salts > 1")
    salt = F.coalesce(F.pmod(F.xxhash64("right"), F.col("salts")), F.lit(0).cast("long"))
    salted = pairs.select("left", "right").join(stored(many, "hubs"), "left", "left").withColumn("salt", salt)
    lefts = salted.select("left", "salt").distinct()
    roles = lefts.select("left", "salt", F.lit(None).cast("long").alias("right"), F.col("left").alias("node"))
    roles = roles.union(salted.select("left", "salt", "right", F.col("right").alias("node")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine = None, None
        for batch in slices(batches, "value"):
            found: list[tuple[int, int]] = []
            columns = (batch[c] for c in ("left", "salt", "right", "value"))
            for left, salt, right, value in zip(*columns, strict=True):
                key = (left.as_py(), salt.as_py())
                if not right.is_valid:
                    at, mine = key, load(value.as_py())
                elif at == key and keep(mine, load(value.as_py())):
                    found.append((key[0], right.as_py()))
            yield links_of(found)

    together = roles.join(records, "node").select("left", "salt", "right", "value")
    return (
        together.repartition("left", "salt")
        .sortWithinPartitions("left", "salt", F.col("right").asc_nulls_first())
        .mapInArrow(run, LINK)
    )


def unsettled(led: DataFrame, components: DataFrame, per_block: int) -> DataFrame:
    """The members of buckets that hold more than one component, with theirs.

    ``led`` has ``bucket``, its ``leader`` and ``node``. ``star`` says whether another star
    round may spare comparing the bucket in blocks: it fills more than ``STAR_BLOCKS`` of
    them, and nine tenths of its members are in the leader's component.
    """
    known = led.drop("component").join(components, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    known = known.join(components.toDF("leader", "leads"), "leader", "left")
    # read twice, by bucket
    known = stored(known.withColumn("leads", F.coalesce("leads", "leader")), "bucket-components")
    members, joined = F.count(F.lit(1)), F.count_if(F.col("component") == F.col("leads"))
    open_buckets = (
        known.groupBy("bucket")
        .agg(
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            ((members > STAR_BLOCKS * per_block) & (10 * joined >= 9 * members)).alias("star"),
        )
        .where("least != most")
        .select("bucket", "star")
    )
    return known.drop("leader", "leads").join(stored(open_buckets, "open-buckets"), "bucket")


def star_rounds(
    members: DataFrame, linked: Callable[[DataFrame], DataFrame], rounds: int, per_block: int
) -> tuple[DataFrame, DataFrame]:
    """What up to ``rounds`` star rounds leave of ``members`` (``bucket``, ``node``), and all components.

    In a round, one member of each bucket is compared with all others of other components;
    ``linked`` takes these pairs and returns the links among them. Only buckets for which
    ``unsettled`` says so get another round: blocks take small ones at one go, and many
    members that are not linked have to meet there anyway.
    """
    spark = members.sparkSession
    members = members.withColumn("component", F.col("node"))
    components = members.select("node", "component").limit(0)
    left: list[DataFrame] = []
    for turn in range(rounds):
        with scratch(spark) as keep:
            # the smallest member first; then another one in each bucket, as good as random
            order = F.col("node") if turn == 0 else F.xxhash64("node", "bucket", F.lit(turn))
            leaders = stored(members.groupBy("bucket").agg(F.min_by("node", order).alias("leader")), "leaders")
            # a leader has met all others of its bucket by then
            others = stored(members.join(leaders, "bucket").where("node != leader"), "led-members")
            led = others
            if turn:
                led = led.join(components.toDF("leader", "leads"), "leader", "left").where(
                    "component != coalesce(leads, leader)"
                )
            pairs = led.select(F.col("leader").alias("left"), F.col("node").alias("right")).distinct()
            links = stored(linked(stored(pairs, "pairs")), "links")
            if not links.isEmpty():
                components = keep(
                    connected_components(components.toDF("left", "right").union(links)), "components"
                )
            still = keep(unsettled(others, components, per_block), "open-members")
        left.append(still.where("NOT star").drop("star"))
        members = still.where("star").drop("star")
        if members.isEmpty():
            break
    for part in left:
        members = members.unionByName(part)
    return members, components


def in_blocks(
    members: DataFrame, records: DataFrame, per_block: int, compare: Callable[[int, list[tuple]], list[tuple[int, int]]]
) -> DataFrame:
    """Links found by comparing all members of each bucket, a pair of blocks at a time.

    ``members`` has ``bucket``, ``node`` and ``component``. A bucket is cut into blocks of
    about ``per_block`` nodes, so that a task's work is bounded however large the bucket,
    and of about ``BLOCK_BYTES`` if ``members`` has the ``bytes`` of the nodes' values.
    ``compare`` takes a bucket and rows (block, node, component, value) of two blocks, or
    of one with itself, and returns links.
    """
    blocks: Column = F.ceil(F.count(F.lit(1)) / per_block)
    if "bytes" in members.columns:
        blocks = F.greatest(blocks, F.ceil(F.sum("bytes") / BLOCK_BYTES))
    placed = members.join(members.groupBy("bucket").agg(blocks.alias("blocks")), "bucket")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    paired = placed.select("bucket", "node", "component", "block", other).select(
        "bucket",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "node",
        "component",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in slices(batches, "value"):
            found: list[tuple[int, int]] = []
            names = ("bucket", "low", "high", "block", "node", "component", "value")
            for bucket, low, high, *row in zip(*(batch[c].to_pylist() for c in names), strict=True):
                if (bucket, low, high) != at:
                    if len(rows) > 1:
                        found += compare(at[0], rows)
                    at, rows = (bucket, low, high), []
                rows.append(tuple(row))
            yield links_of(found)
        if len(rows) > 1:
            yield links_of(compare(at[0], rows))

    together = paired.join(records, "node").repartition("bucket", "low", "high")
    return (
        together.select("bucket", "low", "high", "block", "node", "component", "value")
        .sortWithinPartitions("bucket", "low", "high")
        .mapInArrow(run, LINK)
    )
