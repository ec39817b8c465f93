"""Near-duplicate documents by MinHash banding, verified on full shingle sets.

Documents with equal shingle sets are one class, which its smallest identifier stands
for. Classes whose minima agree in a whole band share a bucket. Buckets are searched
for links without listing their pairs: in a star round, one member of a bucket is
compared with all others. Members that are in one component by then need no more
comparison, as further links between them change nothing; so only buckets that still
hold several components are left. Large ones that are nearly one component get up to
``STAR_ROUNDS`` rounds; in the others all pairs across components are compared in
blocks, of which only links come out. Every comparison
checks the sketches first, with a margin of many standard deviations, and then the
full sets.

The number of bands follows from the threshold: a pair exactly at it shares no bucket
with a probability below ``MISS``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicsieve.llm.components import connected_components
from topicsieve.llm.frames import bucketed, scratch, slices, stored, text_or_empty
from topicsieve.llm.pairs import in_blocks, matching, star_rounds
from topicsieve.llm.shingles import WORDS, tokens

MISS = 1e-7
MARGIN = 6.5  # standard deviations
STAR_ROUNDS = 3
BLOCK_NODES = 1536
#: Shingles hashed at a time, a bound on a worker's memory.
BLOCK = 2048


@dataclass(frozen=True)
class Rule:
    """What counts as a link: ``100 * intersection >= percent * union``."""

    percent: int = 80
    band_rows: int = 4

    @property
    def bands(self) -> int:
        agreeing = (self.percent / 100) ** self.band_rows
        return math.ceil(math.log(MISS) / math.log1p(-agreeing))

    @property
    def minima(self) -> int:
        return self.bands * self.band_rows

    @property
    def least_agreeing(self) -> float:
        """Minima of two sketches that agree at least, if their documents are linked."""
        p = self.percent / 100
        return self.minima * p - MARGIN * math.sqrt(self.minima * p * (1 - p))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@cache
def universal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of ``n`` hash functions of the multiply-shift family."""
    rng = np.random.default_rng(20_240_229)
    factors = rng.integers(0, 1 << 64, n, np.uint64, endpoint=False) | np.uint64(1)
    return factors[:, None], rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)[:, None]


def sketch(hashes: np.ndarray, n: int) -> np.ndarray:
    """The minima of a set under ``n`` universal hash functions, 32 bits of each."""
    factors, summands = universal(n)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), BLOCK):
        values = factors * hashes[None, start : start + BLOCK]
        values += summands
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def buckets(sketches: np.ndarray, rule: Rule) -> np.ndarray:
    """The bucket of each band: a hash of the band's number and minima."""
    bands = sketches.reshape(len(sketches), rule.bands, rule.band_rows).astype(np.uint64)
    keys = np.tile(np.arange(1, rule.bands + 1, dtype=np.uint64), (len(sketches), 1))
    for i in range(rule.band_rows):
        keys = mixed(keys * np.uint64(0xA24BAED4963EE407) + bands[:, :, i])
    return keys.view(np.int64)


def shingle_sets(docs: DataFrame, rule: Rule, whole: bool = False) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_key`` and ``sketch`` of each text.

    With ``whole``, ``shingles`` too: the set, as sorted 64-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, keys, sketches, sets = [], [], [], []
            for text in batch["text"]:
                hashes = tokens(text.as_py(), WORDS)
                raw = hashes.tobytes()
                sizes.append(len(hashes))
                keys.append(hashlib.blake2b(raw, digest_size=16).digest())
                sketches.append(sketch(hashes, rule.minima).tobytes())
                if whole:
                    sets.append(raw)
            columns = {
                "doc_id": batch["doc_id"],
                "n_shingles": pa.array(sizes, pa.int64()),
                "set_key": pa.array(keys, pa.binary()),
                "sketch": pa.array(sketches, pa.binary()),
            }
            if whole:
                columns["shingles"] = pa.array(sets, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles bigint, set_key binary, sketch binary"
    chosen = docs.select("doc_id", text_or_empty().alias("text"))
    return chosen.mapInArrow(run, schema + ", shingles binary" * whole)


def bucket_rows(classes: DataFrame, rule: Rule) -> DataFrame:
    """``bucket``, ``node`` and ``bytes`` of its sketch and set, a row for each class and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "sketch"):
            raw = b"".join(x.as_py() for x in batch["sketch"])
            keys = buckets(np.frombuffer(raw, "<u4").reshape(batch.num_rows, rule.minima), rule)
            nodes = np.repeat(batch["node"].to_numpy(), rule.bands)
            held = np.repeat(4 * rule.minima + 8 * batch["n_shingles"].to_numpy(), rule.bands)
            yield pa.RecordBatch.from_pydict({"bucket": keys.ravel(), "node": nodes, "bytes": held})

    chosen = classes.select("node", "n_shingles", "sketch")
    return chosen.mapInArrow(run, "bucket bigint, node bigint, bytes bigint")


class Sketch:
    """Sketch and number of shingles of a document, as they were stored in one value."""

    __slots__ = ("minima", "size")

    def __init__(self, value: bytes, rule: Rule):
        self.minima = np.frombuffer(value, "<u4", rule.minima)
        self.size = int(value[4 * rule.minima :])

    def fits(self, other: Sketch, rule: Rule) -> bool:
        """Whether sizes and sketches leave room for a link."""
        small, large = sorted((self.size, other.size))
        if 100 * small < rule.percent * large:
            return False
        return int((self.minima == other.minima).sum()) >= rule.least_agreeing


def linked(a: np.ndarray, b: np.ndarray, rule: Rule) -> bool:
    """Whether the full sets are similar enough."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= rule.percent * (len(a) + len(b) - shared)


def block_links(bucket: int, rows: list[tuple[int, int, int, bytes]], rule: Rule) -> list[tuple[int, int]]:
    """Links that join components within a block of a bucket, or between its two halves.

    ``rows`` have block number, node, component, and sketch and shingles in one value. Pairs that met in a bucket
    of an earlier band are left to it, and pairs that links found here have joined are
    passed over, so there are fewer links than rows.
    """
    sketches = np.stack([np.frombuffer(value, "<u4", rule.minima) for *_, value in rows])
    sets = [np.frombuffer(value, "<u8", offset=4 * rule.minima) for *_, value in rows]
    sizes = np.array([len(x) for x in sets])
    half = np.array([r[0] for r in rows])
    crossing = half.min() != half.max()
    keys = buckets(sketches, rule)
    band = int(np.flatnonzero(keys[0] == bucket)[0])
    joined = {r[2]: r[2] for r in rows}

    def root(component: int) -> int:
        while joined[component] != component:
            joined[component] = component = joined[joined[component]]
        return component

    roots = np.array([r[2] for r in rows])
    found = []
    for i in range(len(rows) - 1):
        rest = slice(i + 1, None)
        likely = roots[rest] != roots[i]
        if crossing:
            likely &= half[rest] != half[i]
        likely &= 100 * np.minimum(sizes[rest], sizes[i]) >= rule.percent * np.maximum(sizes[rest], sizes[i])
        if not likely.any():
            continue
        others = i + 1 + np.flatnonzero(likely)
        met = (keys[others, :band] == keys[i, :band]).any(axis=1)
        agree = (sketches[others] == sketches[i]).sum(axis=1) >= rule.least_agreeing
        for j in others[agree & ~met].tolist():
            a, b = root(rows[i][2]), root(rows[j][2])
            if a != b and linked(sets[i], sets[j], rule):
                found.append((rows[i][1], rows[j][1]))
                joined[max(a, b)] = min(a, b)
                roots[roots == max(a, b)] = min(a, b)
    return found


def near_links(docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """``node`` and ``component`` of every class that is linked with another one."""
    spark = docs.sparkSession
    rows = bucket_rows(classes, rule)
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = stored(rows.join(stored(shared, "shared-buckets"), "bucket"), "members")
    needed = stored(members.select(F.col("node").alias("doc_id")).distinct(), "needed")
    nodes = bucketed(
        shingle_sets(docs.join(needed, "doc_id", "left_semi"), rule, whole=True).select(
            F.col("doc_id").cast("long").alias("node"),
            "n_shingles",
            "sketch",
            "shingles",
        ),
        "node",
    )
    # as text, so that a sketch and its size are one value
    size = F.col("n_shingles").cast("string").cast("binary")
    briefs = nodes.select("node", F.concat("sketch", size).alias("value"))
    sets = nodes.select("node", F.col("shingles").alias("value"))

    def links(pairs: DataFrame) -> DataFrame:
        likely = matching(pairs, briefs, lambda v: Sketch(v, rule), lambda a, b: a.fits(b, rule))
        return matching(
            stored(likely, "likely-pairs"), sets, lambda v: np.frombuffer(v, "<u8"), lambda a, b: linked(a, b, rule)
        )

    members, components = star_rounds(members, links, STAR_ROUNDS, BLOCK_NODES)
    if members.isEmpty():
        return components
    whole = nodes.select("node", F.concat("sketch", "shingles").alias("value"))
    across = in_blocks(members, whole, BLOCK_NODES, lambda bucket, rows: block_links(bucket, rows, rule))
    across = stored(across, "links")
    return components if across.isEmpty() else connected_components(components.toDF("left", "right").union(across))


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Every row with its component of linked documents.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (the smallest identifier that
    links lead to, its own included) and ``kept`` (whether it is that one). Null and
    empty texts have no shingles and no links. Rows repeated with one identifier are
    one document, whose text is taken to be the same; all of them are returned. Rows
    without an identifier link to nothing, have no component and are kept. Other
    columns are not looked at.
    """
    docs = docs.select("doc_id", "text")
    with scratch(docs.sparkSession) as keep:
        sets = stored(shingle_sets(docs, rule), "shingle-sets")
        classes = stored(
            sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
            .groupBy("set_key")
            .agg(
                F.min("doc_id").cast("long").alias("node"),
                F.first("n_shingles").alias("n_shingles"),
                F.first("sketch").alias("sketch"),
            ),
            "classes",
        )
        components = near_links(docs, classes, rule)
        of_class = stored(
            classes.select("set_key", "node")
            .join(components, "node", "left")
            .select("set_key", F.coalesce("component", "node").alias("component_id")),
            "class-components",
        )
        linked = keep(
            sets.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left"), "linked"
        )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return linked.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
