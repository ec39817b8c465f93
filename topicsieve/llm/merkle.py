"""Merkle manifest of a dataset: a root per group, a root of all, a proof per row.

The nodes of a level are hexadecimal digests; parents hash their children's text. Rows
take their places in a group by range partitioning, so no group is sorted or numbered
in one task. An aligned block of ``BLOCK`` neighbours keeps each of its levels as one
hexadecimal string: a parent is the hash of a substring of fixed width, and what flanks
a node in its run are the siblings a proof needs. The roots of blocks are the nodes of
the next tier, and so on until a group has one; the groups' roots are built up alike.
Proofs come down the same way, a block's path being passed to its nodes. Only digests
are shuffled, and each text is read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicsieve.llm.frames import stored

FAN = 2
#: Nodes of a block, a power of the fan.
BLOCK = 256
#: Fixed value: characters of a digest.
WIDTH = 64
NO_PATH = "CAST(array() AS array<struct<before: string, after: string>>)"


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(*fields: Column) -> Column:
    """Digest of a row's fields: ``-`` for null, else bytes, a colon and the value."""

    def told(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(told, fields))


def group_key(group: Column) -> Column:
    """A text that is never null and sorts like ``group``, null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``place`` (from 0, in order within ``tree``) and ``size`` of the tree.

    Rows are sorted by range over all partitions; a partition's rows of a tree take
    numbers after those of the partitions before. Ties take any order.
    """
    spark = nodes.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # stored first, as the sampling of range bounds would read the texts twice; the number
    # of a partition is above 33 bits, of a row in it below
    ranged = stored(
        stored(nodes, "nodes")
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranged-nodes",
    ).withColumn("_part", F.shiftright("_at", 33))
    # a row for each partition of a tree
    counts = ranged.groupBy("tree", "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    own = Window.partitionBy("tree")
    upto = F.sum("_rows").over(own.orderBy("_part"))
    starts = stored(
        counts.select(
            "tree", "_part", "_first", (upto - F.col("_rows")).alias("_before"),
            F.sum("_rows").over(own).alias("size"),
        ),
        "starts",
    )
    place = F.col("_at") - F.col("_first") + F.col("_before")
    joined = ranged.join(starts, ["tree", "_part"]).withColumn("place", place)
    return joined.drop("_at", "_part", "_first", "_before")


def _width(level: Column) -> Column:
    """Nodes of a level's string."""
    return (F.length(level) / WIDTH).cast("int")


def _parents(level: Column, fan: int) -> Column:
    runs = F.sequence(F.lit(0), F.ceil(_width(level) / fan).cast("int") - 1)
    return F.array_join(
        F.transform(runs, lambda i: digest(F.substring(level, i * WIDTH * fan + 1, F.lit(WIDTH * fan)))), ""
    )


def _levels(bottom: Column, size: Column, block: int, fan: int) -> Column:
    """All levels of a block from its lowest one, as strings.

    A tree of several blocks has them hashed up to their one root whatever their width;
    a tree of one block ends where one node remains.
    """
    powers = [1]
    while powers[-1] < block:
        powers.append(powers[-1] * fan)
    needed = reduce(Column.__add__, [(size > p).cast("int") for p in powers[:-1]])
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(len(powers) - 1)),
        F.array(bottom),
        lambda levels, i: F.when(
            i <= needed, F.concat(levels, F.array(_parents(F.element_at(levels, -1), fan)))
        ).otherwise(levels),
    )


def _path(levels: Column, at: Column, fan: int) -> Column:
    """What flanks node ``at`` and its parents in their runs, level by level."""
    steps = F.slice(levels, 1, F.size(levels) - 1)  # the root has no siblings

    def flanks(level: Column, height: Column) -> Column:
        node = F.floor(at / F.pow(F.lit(float(fan)), height)).cast("int")
        run = node - node % fan
        before = F.substring(level, run * WIDTH + 1, (node - run) * WIDTH)
        after = F.substring(level, (node + 1) * WIDTH + 1, (run + fan - node - 1) * WIDTH)
        return F.struct(before.alias("before"), after.alias("after"))

    return F.transform(steps, flanks)


def _blocks(nodes: DataFrame, block: int, fan: int) -> DataFrame:
    """``tree``, ``block``, ``size``, the block's ``nodes`` in order and its ``levels``.

    ``nodes`` has ``tree``, ``place``, ``size``, ``digest`` and ``carried``.
    """
    member = F.struct("place", "digest", "carried")
    gathered = nodes.groupBy("tree", F.floor(F.col("place") / block).alias("block")).agg(
        F.first("size").alias("size"), F.array_sort(F.collect_list(member)).alias("nodes")
    )
    bottom = F.array_join(F.transform("nodes", lambda n: n["digest"]), "")
    return stored(
        gathered.withColumn("levels", _levels(bottom, F.col("size"), block, fan)), "merkle-blocks"
    )


def _tiers(nodes: DataFrame, block: int, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each tier, and ``tree`` and ``digest`` of each tree's root."""
    tiers = [_blocks(nodes, block, fan)]
    largest = tiers[0].agg(F.max("size")).first()[0] or 0
    while True:
        root = F.element_at("levels", -1).alias("digest")
        above = tiers[-1].select(
            "tree", F.col("block").alias("place"), F.ceil(F.col("size") / block).alias("size"), root,
            F.lit(None).cast("string").alias("carried"),
        )
        if largest <= block:
            return tiers, above.select("tree", "digest")
        tiers.append(_blocks(above, block, fan))
        largest = -(-largest // block)


def _down(blocks: DataFrame, above: DataFrame, fan: int) -> DataFrame:
    """The nodes of ``blocks`` with their paths to the top.

    ``above`` has ``tree``, ``place`` (of the block), ``path``, ``subroot`` and ``root``.
    """
    joined = blocks.join(above.withColumnRenamed("place", "block"), ["tree", "block"])
    nodes = F.transform(
        "nodes",
        lambda n, i: F.struct(
            n["place"].alias("place"), n["digest"].alias("digest"), n["carried"].alias("carried"),
            F.concat(_path(F.col("levels"), i, fan), F.col("path")).alias("path"),
        ),
    )
    return joined.select("tree", "subroot", "root", F.inline(nodes))


def _proofs(tiers: list[DataFrame], tops: DataFrame, fan: int) -> DataFrame:
    """Paths of the lowest tier's nodes; ``tops`` has each tree's path, subroot and root."""
    above = tops.withColumn("place", F.lit(0).cast("long"))
    for blocks in reversed(tiers[1:]):
        above = stored(
            _down(blocks, above, fan).select("tree", "place", "path", "subroot", "root"), "merkle-paths"
        )
    return _down(tiers[0], above, fan)


def manifest(
    rows: DataFrame, group: str, order: Sequence[str], digest: str, block: int = BLOCK, fan: int = FAN
) -> DataFrame:
    """Every row of ``rows`` with its proof of belonging to the dataset.

    Within a ``group`` leaves (the digests in column ``digest``) ascend by the columns
    ``order``, nulls first, ties by digest; while several nodes remain, every ``fan``
    consecutive ones become their digest. The groups' roots, null group first, then
    bytewise, likewise become the root. Returns the columns of ``rows`` with
    ``subroot``, ``root`` and ``path``, which replace columns so named: the
    digests before and after the row's node in its run, from leaf to root.

    Every row is a leaf, repeated ones too: each of them has a place, and any of them may
    have any of the places. An empty table gives none. ``block`` is a power of ``fan``.
    """
    own = [c for c in rows.columns if c.lower() not in ("subroot", "root", "path")]
    leaves = rows.select(
        group_key(F.col(group)).alias("tree"),
        *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)],
        F.col(digest).alias("digest"),
        F.struct(*own).alias("carried"),
    )
    orders = [f"_order{i}" for i in range(len(order))]
    placed = numbered(leaves, [*orders, "digest"]).drop(*orders)
    tiers, roots = _tiers(placed, block, fan)

    subroots = roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("_group"), "digest", F.struct("tree").alias("carried")
    )
    top_tiers, top = _tiers(numbered(subroots, ["_group"]).drop("_group"), block, fan)
    root = top.select("tree", F.expr(NO_PATH).alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    tops = stored(
        _proofs(top_tiers, root, fan).select(
            F.col("carried.tree").alias("tree"), "path", F.col("digest").alias("subroot"), "root"
        ),
        "merkle-tops",
    )
    return _proofs(tiers, tops, fan).select("carried.*", "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from leaf to root and left to right."""
    siblings = F.transform(path, lambda step: F.concat(step["before"], step["after"]))
    return digest(F.array_join(siblings, ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))
