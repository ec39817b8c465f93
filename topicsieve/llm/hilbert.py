"""Approximate nearest neighbours on shifted Hilbert curves.

Each of several curves has its own random projection and shift. Vectors are projected
to a few dimensions, spread evenly by the normal distribution, and keyed by their place
on the curve. Spark range-partitions all vectors by curve and key; a query is compared
with its own partition and the neighbouring ones within ``WINDOW`` of the curve to both
sides, and the finds of all curves merge into one list, scored on the whole vectors.

Equal vectors are one node of the index, with its smallest identifiers: however often a
vector occurs, it has one place on each curve.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicsieve.llm.frames import slices, stored

#: Vectors that scale the projections (documented bound; all vectors are indexed).
SAMPLE_ROWS = 20_000
#: Queries compared with a block at a time, a bound on a worker's memory.
QUERY_BATCH = 256


@dataclass(frozen=True)
class Index:
    curves: int = 12
    dimensions: int = 8
    bits: int = 7
    block_rows: int = 4096
    window: float = 1 / 24  # of a curve, to each side


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points (rows) with ``bits`` bits per dimension.

    From the highest bit down, the lower bits of the first coordinate are inverted
    where a coordinate's bit is set, and exchanged with that coordinate's where it is
    not. The Gray code of the result, its bits interleaved, is the place.
    """
    axes = cells.T.astype(np.int64).copy()
    for level in range(bits - 1, 0, -1):
        lower = (1 << level) - 1
        for i in range(len(axes)):
            is_set = (axes[i] >> level) & 1 == 1
            swap = np.where(is_set, 0, (axes[0] ^ axes[i]) & lower)
            axes[0] ^= np.where(is_set, lower, swap)
            if i:
                axes[i] ^= swap
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    axes ^= flip
    keys = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            keys = (keys << 1) | ((axis >> level) & 1)
    return keys


def projections(index: Index, width: int) -> tuple[np.ndarray, np.ndarray]:
    """An orthonormal projection and a shift for each curve, the same on every call."""
    rng = np.random.default_rng(11)
    n = min(index.dimensions, width)
    bases = [np.linalg.qr(rng.normal(size=(width, width)))[0][:, :n] for _ in range(index.curves)]
    return np.stack(bases), rng.random((index.curves, n))


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components, and is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def usual_width(vectors: DataFrame) -> int:
    """The width that most identifiers have, the smaller one of equals; 0 without rows."""
    widths = vectors.groupBy(F.size("vector").alias("w")).agg(F.count_distinct("vec_id").alias("n"))
    usual = widths.orderBy(F.desc("n"), "w").first()
    return usual["w"] if usual else 0


def vector_classes(vectors: DataFrame, k: int) -> DataFrame:
    """``node``, ``vector`` and ``members``: each different vector with its ``k + 1``
    smallest identifiers, the smallest of which is the node."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    return (
        vectors.distinct()
        # limited before the shuffle, so a very common vector stays small
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
        .select(F.col("members")[0].alias("node"), "vector", "members")
    )


def curve_keys(nodes: DataFrame, index: Index) -> DataFrame:
    """``curve``, ``key``, ``node`` and ``vector`` (bytes), a row for each node and curve."""
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE_ROWS).select("vector").collect()
    some = np.array([r["vector"] for r in sample], float)
    bases, shifts = projections(index, some.shape[1])
    projected = np.einsum("nw,cwd->cnd", some, bases)
    centres, scales = projected.mean(1), projected.std(1)
    scales[scales == 0] = 1
    top = (1 << index.bits) - 1
    spread = np.vectorize(lambda z: 0.5 * math.erfc(-z / math.sqrt(2)), otypes=[float])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "vector"):
            values = batch["vector"].flatten().to_numpy(zero_copy_only=False)
            matrix = values.reshape(batch.num_rows, -1)
            raw = pa.array([row.tobytes() for row in matrix], pa.binary())
            for curve, (base, shift) in enumerate(zip(bases, shifts, strict=True)):
                even = spread((matrix.astype(float) @ base - centres[curve]) / scales[curve])
                # shifted on a grid of twice the width, so nothing wraps around
                cells = np.minimum((even + shift) / 2 * (top + 1), top).astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "curve": pa.array(np.full(batch.num_rows, curve, np.int32)),
                        "key": pa.array(hilbert_keys(cells, index.bits)),
                        "node": batch["node"],
                        "vector": raw,
                    }
                )

    return nodes.select("node", "vector").mapInArrow(
        run, "curve int, key bigint, node bigint, vector binary"
    )


def best_of_block(
    queries: np.ndarray, block: np.ndarray, nodes: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` best nodes of a block for each query, and their inner products.

    Of equal products, those of smaller nodes are best, however many there are.
    """
    near = queries @ block.T
    n = min(n, len(block))
    # some more than needed, as rounding in the product depends on its shape
    some = min(n + 4, len(block))
    chosen = np.argpartition(-near, some - 1, axis=1)[:, :some]
    # summed in the same order wherever a pair meets
    exact = (queries[:, None, :] * block[chosen]).sum(2)
    order = np.lexsort((nodes[chosen], -exact), axis=1)[:, :n]
    best = np.take_along_axis(nodes[chosen], order, 1)
    scores = np.take_along_axis(exact, order, 1)
    # where the last one chosen may equal the last one needed, others may as well
    top = -np.sort(-np.take_along_axis(near, chosen, 1), axis=1)
    sizes = np.linalg.norm(queries, axis=1) * np.linalg.norm(block, axis=1).max()
    limits = top[:, n - 1] - 4 * block.shape[1] * np.finfo(float).eps * sizes
    for i in np.flatnonzero(top[:, -1] >= limits) if some < len(block) else ():
        tied = np.flatnonzero(near[i] >= limits[i])
        exact = (queries[i] * block[tied]).sum(1)
        order = np.lexsort((nodes[tied], -exact))[:n]
        best[i], scores[i] = nodes[tied][order], exact[order]
    return best, scores


def block_finds(together: DataFrame, dtype: str, n: int) -> DataFrame:
    """``query``, ``node`` and ``score``: the best of each block for its queries.

    ``together`` has ``block``, ``is_query``, ``node`` and ``vector``, sorted by the
    first two within partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, rows = None, [], []
        block = ids = None

        def finds(queries: list[int], vectors: list[bytes]) -> pa.RecordBatch:
            matrix = np.frombuffer(b"".join(vectors), dtype).reshape(len(queries), -1)
            found, scores = best_of_block(matrix.astype(float), block, ids, n)
            return pa.RecordBatch.from_pydict(
                {
                    "query": pa.array(np.repeat(np.array(queries), found.shape[1])),
                    "node": pa.array(found.ravel()),
                    "score": pa.array(scores.ravel()),
                }
            )

        waiting: tuple[list[int], list[bytes]] = ([], [])
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("block", "is_query", "node", "vector"))
            for part, is_query, node, vector in zip(*columns, strict=True):
                if part != at:
                    if waiting[0] and block is not None:
                        yield finds(*waiting)
                    at, nodes, rows, block, waiting = part, [], [], None, ([], [])
                if not is_query:
                    nodes.append(node)
                    rows.append(vector)
                    continue
                if block is None and nodes:
                    block = np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1).astype(float)
                    ids = np.array(nodes)
                waiting[0].append(node)
                waiting[1].append(vector)
                if len(waiting[0]) == QUERY_BATCH:
                    if block is not None:
                        yield finds(*waiting)
                    waiting = ([], [])
        if waiting[0] and block is not None:
            yield finds(*waiting)

    return together.select("block", "is_query", "node", "vector").mapInArrow(
        run, "query bigint, node bigint, score double"
    )


def node_neighbours(nodes: DataFrame, query_nodes: DataFrame, n: int, index: Index) -> DataFrame:
    """``query``, ``node`` and ``score``: ``n`` nearest nodes (the query's own among them)."""
    blocks = max(1, -(-nodes.count() // index.block_rows))
    ranged = stored(
        curve_keys(nodes, index)
        .repartitionByRange(index.curves * blocks, "curve", "key", "node")
        .select("node", "vector", F.spark_partition_id().alias("block")),
        "curve-blocks",
    )
    last = ranged.agg(F.max("block")).first()[0]
    reach = math.ceil((last + 1) / index.curves * index.window)
    around = F.sequence(
        F.greatest(F.col("block") - reach, F.lit(0)), F.least(F.col("block") + reach, F.lit(last))
    )
    asked = ranged.join(query_nodes, "node", "left_semi").select(
        "node", "vector", F.explode(around).alias("block")
    )
    together = ranged.withColumn("is_query", F.lit(False)).unionByName(
        # a query near the end of two curves asks a block once
        asked.dropDuplicates(["node", "block"]).withColumn("is_query", F.lit(True))
    )
    dtype = "<f8" if "double" in nodes.schema["vector"].dataType.simpleString() else "<f4"
    found = block_finds(
        together.repartition(index.curves * blocks, "block").sortWithinPartitions("block", "is_query"),
        dtype,
        n,
    )
    merged = found.groupBy("query", "node").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    return merged.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")


def nearest(
    embeddings: DataFrame, is_query: Column, k: int = 20, index: Index = Index()
) -> DataFrame:
    """The ``k`` rows found nearest to each query row, by inner product.

    ``embeddings`` has ``vec_id`` and ``embedding``; other columns are not looked at.
    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``; equal scores rank
    by smaller identifier, and a row is no neighbour of itself. Rows without an
    identifier, and vectors that are null, zero, or hold null or non-finite components
    take no part, nor do those of another width than most of the others have. Repeated
    rows count once.
    """
    given = embeddings.select("vec_id", F.col("embedding").alias("vector")).where("vec_id IS NOT NULL")
    fine = given.where(usable(F.col("vector")))
    width = usual_width(fine)
    vectors = stored(fine.where(F.size("vector") == width), "vectors")
    nodes = stored(vector_classes(vectors, k), "vector-classes")
    spark = embeddings.sparkSession
    if nodes.isEmpty():
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    queries = stored(
        vectors.where(is_query)
        .distinct()
        .join(nodes.select("vector", F.col("node").alias("query")), "vector")
        .select(F.col("vec_id").alias("query_id"), "query"),
        "query-rows",
    )
    query_nodes = queries.select(F.col("query").alias("node")).distinct()
    found = node_neighbours(nodes, query_nodes, k + 1, index)
    one = F.struct((-F.col("score")).alias("minus"), F.col("member").alias("vec_id"))
    # a query leaves out at most one of these, itself
    lists = stored(
        found.join(nodes.select("node", F.explode("members").alias("member")), "node")
        .groupBy("query")
        .agg(F.slice(F.sort_array(F.collect_list(one)), 1, k + 1).alias("near")),
        "neighbour-lists",
    )
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        queries.join(lists, "query")
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "x"))
        .select(
            "query_id",
            (F.col("place") + 1).cast("int").alias("rank"),
            F.col("x.vec_id").alias("vec_id"),
            (-F.col("x.minus")).alias("score"),
        )
    )
