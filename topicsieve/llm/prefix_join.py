"""Jaccard join of word n-grams by prefix filters under several global orders.

Under any order of all tokens (n-gram hashes), two sets that are similar enough share a
token of their prefixes: the first ``n - ceil(t * n) + 1`` of each in that order. One
order gives the index, a bucket for each prefix token; pairs that meet in a bucket are
candidates only if they share a prefix token under each of the other orders too, and
only these are verified on their full sets.

All orders put tokens that several documents hold last, so that what documents share by
a passage or by chance hardly gets into a prefix; apart from that they are independent. A
common token is one whose bit is set in a bitmap of fixed size, counted over all texts:
whatever the bitmap says, it says it to every document, so each order is the same
everywhere and no link is lost.

Documents with equal sets are one class, which its smallest identifier stands for.
Buckets are searched without listing their pairs: in a star round one member is
compared with the others of its bucket. Members that are in one component by then need no
further comparison, so only buckets that still hold several components are left, and are
compared block by block; large ones that are nearly one component get more rounds first.

Families of texts that share much, but less than the threshold, pass all prefix filters.
A parity bitmap of a few bits a token keeps them from being verified: where two bitmaps
differ, the sets do, so the bits that differ are a lower bound of the symmetric
difference. It drops no link. Full sets are fetched only of nodes in pairs it leaves.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicsieve.llm.components import connected_components
from topicsieve.llm.frames import bucketed, scratch, slices, stored, text_or_empty
from topicsieve.llm.pairs import in_blocks, matching, star_rounds
from topicsieve.llm.shingles import WORDS, spread_bits, tokens

ORDERS = 3
STAR_ROUNDS = 3
BLOCK_NODES = 256
#: Bits of the bitmap of common tokens, four megabytes; at most an eighth of them are set.
COMMON_BITS = 1 << 25
#: Part of a prefix beyond it whose tokens are counted, as they follow common ones.
COUNTED_BEYOND = 0.25
#: Tokens counted at a time in a task, a bound on its memory.
COUNTED = 1 << 21


@dataclass(frozen=True)
class Join:
    """What counts as a link: ``100 * intersection >= percent * union`` of n-gram sets."""

    percent: int = 80
    n_words: int = WORDS
    orders: int = ORDERS

    def prefix(self, size: int) -> int:
        """Tokens of a set's prefix."""
        return size - -(-self.percent * size // 100) + 1 if size else 0

    def may_fit(self, a: int, b: int) -> bool:
        """Whether sets of these sizes can be similar enough."""
        return 100 * min(a, b) >= self.percent * max(a, b)

    def may_differ(self, differ, sizes):
        """Whether sets of so many tokens together can be linked if they differ in so many."""
        return differ * (100 + self.percent) <= sizes * (100 - self.percent)


def set_key(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


# orders


def _salt(order: int) -> np.uint64:
    return spread_bits(np.array([order + 1], np.uint64))[0]


def is_common(found: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Whether each token's bit is set."""
    bits = found & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 == 1


def prefixes(found: np.ndarray, bitmap: np.ndarray, join: Join) -> list[np.ndarray]:
    """A set's prefix under each order, first tokens first."""
    size = join.prefix(len(found))
    common = is_common(found, bitmap)
    rare, often = found[~common], found[common]
    out = []
    for order in range(join.orders):
        salt = _salt(order)
        taken = []
        need = size
        for part in (rare, often):
            ranks = spread_bits(part ^ salt)
            taken.append(part[np.argsort(ranks)[:need]])
            need -= len(taken[-1])
        out.append(np.concatenate(taken))
    return out


def _counted(found: np.ndarray, join: Join) -> np.ndarray:
    """Which tokens of a set come first under the first order, were no token common."""
    size = min(len(found), math.ceil(join.prefix(len(found)) * (1 + COUNTED_BEYOND)))
    first = np.zeros(len(found), bool)
    if size:
        first[np.argpartition(spread_bits(found ^ _salt(0)), size - 1)[:size]] = True
    return first


def common_tokens(docs: DataFrame, join: Join) -> Broadcast:
    """Bitmap of the tokens that several documents hold, over all texts.

    Tasks count the tokens of many texts at a time and tell those that come first in a
    text, and others that occur in several of its texts; these counts are added up. The
    bitmap has ``COMMON_BITS`` bits whatever the size of the corpus; it takes the most
    frequent tokens, down to a frequency (a power of two) at which an eighth of its bits
    would be set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        held: list[np.ndarray] = [np.zeros(0, np.uint64)]
        marks: list[np.ndarray] = [np.zeros(0, bool)]

        def counts() -> pa.RecordBatch:
            flat, first = np.concatenate(held), np.concatenate(marks)
            seen.clear()
            del held[1:], marks[1:]
            order = np.argsort(flat)
            flat, first = flat[order], first[order]
            starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else order
            n = np.diff(np.append(starts, len(flat)))
            told = n > 1
            if len(flat):
                told |= np.logical_or.reduceat(first, starts)
            return pa.RecordBatch.from_pydict({"token": flat[starts[told]].view(np.int64), "n": n[told]})

        total = 0
        for batch in slices(batches, "text"):
            for text in batch["text"]:
                found = tokens(text.as_py(), join.n_words)
                key = set_key(found)
                if key not in seen:
                    seen.add(key)
                    held.append(found)
                    marks.append(_counted(found, join))
                    total += len(found)
            if total >= COUNTED:
                yield counts()
                total = 0
        yield counts()

    spark = docs.sparkSession
    counts = (
        docs.select(text_or_empty().alias("text"))
        .mapInArrow(run, "token bigint, n bigint")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
    )
    with scratch(spark):
        counts = stored(counts, "common-tokens")
        scale = F.floor(F.log2("n")).cast("int")
        # a row for each power of two
        by_scale = {r["scale"]: r["n"] for r in counts.groupBy(scale.alias("scale")).agg(F.count(F.lit(1)).alias("n")).collect()}
        least, total = 63, 0
        for s in sorted(by_scale, reverse=True):
            if total + by_scale[s] > COMMON_BITS // 8:
                break
            least, total = s, total + by_scale[s]
        bit = f"(token & {COMMON_BITS - 1})"
        word = F.expr(f"shiftright({bit}, 6) AS word")
        flag = F.expr(f"shiftleft(1L, CAST({bit} & 63 AS int))")
        # as many rows as the bitmap has 64-bit words, at most
        rows = counts.where(scale >= least).groupBy(word).agg(F.bit_or(flag).alias("bits")).toArrow()
    bitmap = np.zeros(COMMON_BITS // 64, np.int64)
    bitmap[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return spark.sparkContext.broadcast(bitmap.astype("<i8").view(np.uint8))


# index


def indexed(docs: DataFrame, common: Broadcast, join: Join) -> DataFrame:
    """A row for each text, and a row for each token of its prefix under the first order.

    Rows of texts have ``n_shingles`` and ``set_key``, rows of tokens have ``bucket``. A
    task tells the tokens of equal sets among neighbours once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in slices(batches, "text"):
            if len(seen) > 100_000:
                seen.clear()
            sizes, keys, ids, buckets = [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                found = tokens(text.as_py(), join.n_words)
                key = set_key(found)
                sizes.append(len(found))
                keys.append(key)
                if len(found) and doc_id is not None and key not in seen:
                    seen.add(key)
                    first = prefixes(found, common.value, Join(join.percent, join.n_words, 1))[0]
                    ids.append(np.full(len(first), doc_id, np.int64))
                    buckets.append(first.view(np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "set_key": pa.array(keys, pa.binary()),
                    "bucket": pa.nulls(len(sizes), pa.int64()),
                }
            )
            if ids:
                both = pa.array(np.concatenate(ids)).cast(batch["doc_id"].type)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": both,
                        "n_shingles": pa.nulls(len(both), pa.int64()),
                        "set_key": pa.nulls(len(both), pa.binary()),
                        "bucket": pa.array(np.concatenate(buckets)),
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", text_or_empty().alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, n_shingles bigint, set_key binary, bucket bigint")


class Prefixes:
    """A set's size and its prefixes under the orders after the first, 32 bits a token."""

    __slots__ = ("size", "orders")

    def __init__(self, value: bytes, join: Join):
        raw = np.frombuffer(value, np.uint32)
        self.size = int(raw[0])
        self.orders = raw[1:].reshape(join.orders - 1, -1)

    @staticmethod
    def packed(size: int, orders: list[np.ndarray]) -> bytes:
        head = np.array([size], np.uint32)
        return np.concatenate([head, *(p.astype(np.uint32) for p in orders)]).tobytes()

    def candidate(self, other: Prefixes, join: Join) -> bool:
        """Whether sizes fit and prefixes meet under each of the orders."""
        return join.may_fit(self.size, other.size) and all(
            np.isin(a, b).any() for a, b in zip(self.orders, other.orders, strict=True)
        )


def similar(a: np.ndarray, b: np.ndarray, join: Join) -> bool:
    """Whether two full sets, sorted, are linked."""
    if not join.may_fit(len(a), len(b)):
        return False
    both = np.sort(np.concatenate([a, b]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= join.percent * (len(both) - shared)


def parity(found: np.ndarray) -> bytes:
    """A set's size, and for each value of some bits of its tokens whether their number is odd.

    The bitmap has two to four bits a token.
    """
    width = max(64, 1 << (2 * max(len(found), 1) - 1).bit_length())
    odd = np.bincount((found & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    head = np.array([len(found)], "<u4").tobytes()
    return head + np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class Parity:
    """A size and a parity bitmap, as they were stored."""

    __slots__ = ("size", "words")

    def __init__(self, value: bytes):
        self.size = int.from_bytes(value[:4], "little")
        self.words = np.frombuffer(value, np.uint64, (len(value) - 4) // 8, 4)

    def folded(self, n: int) -> np.ndarray:
        """The bitmap of ``n`` words, no more than it has."""
        words = self.words
        while len(words) > n:
            words = words[: len(words) // 2] ^ words[len(words) // 2 :]
        return words

    def may_link(self, other: Parity, join: Join) -> bool:
        """Whether sizes and bitmaps leave room for a link."""
        n = min(len(self.words), len(other.words))
        differ = int(np.bitwise_count(self.folded(n) ^ other.folded(n)).sum())
        return join.may_fit(self.size, other.size) and join.may_differ(differ, self.size + other.size)


class Filters:
    """All that a set is filtered by before it is verified."""

    __slots__ = ("prefixes", "parity")

    def __init__(self, value: bytes, join: Join):
        size = int.from_bytes(value[:4], "little")
        cut = 4 * (1 + (join.orders - 1) * join.prefix(size))
        self.prefixes, self.parity = Prefixes(value[:cut], join), Parity(value[cut:])

    def candidate(self, other: Filters, join: Join) -> bool:
        return self.prefixes.candidate(other.prefixes, join) and self.parity.may_link(other.parity, join)


def profiles(docs: DataFrame, needed: DataFrame, common: Broadcast, join: Join) -> DataFrame:
    """The documents ``needed``, in buckets of ``node``.

    Returns ``node``, ``first`` (the prefix under the first order), ``others`` (size and
    the prefixes under the other orders), ``parity`` and ``shingles`` (the full set).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            first, others, parities, sets = [], [], [], []
            for text in batch["text"]:
                found = tokens(text.as_py(), join.n_words)
                orders = prefixes(found, common.value, join)
                first.append(orders[0].tobytes())
                others.append(Prefixes.packed(len(found), orders[1:]))
                parities.append(parity(found))
                sets.append(found.tobytes())
            columns = {"first": first, "others": others, "parity": parities, "shingles": sets}
            yield pa.RecordBatch.from_pydict(
                {"node": batch["node"]} | {k: pa.array(v, pa.binary()) for k, v in columns.items()}
            )

    own = docs.select(F.col("doc_id").cast("long").alias("node"), text_or_empty().alias("text"))
    chosen = own.join(needed, "node", "left_semi")
    rows = chosen.mapInArrow(run, "node bigint, first binary, others binary, parity binary, shingles binary")
    return bucketed(rows, "node")


# links


def _met(tokens_of: np.ndarray, upto: np.ndarray | None = None) -> np.ndarray:
    """Which rows share a token, as a square of booleans; only tokens before ``upto`` count."""
    n, width = len(tokens_of), [len(t) for t in tokens_of]
    rows = np.repeat(np.arange(n), width)
    flat = np.concatenate(list(tokens_of))
    if upto is not None:
        early = np.concatenate([np.arange(w) < u for w, u in zip(width, upto, strict=True)])
        rows, flat = rows[early], flat[early]
    order = np.argsort(flat, kind="stable")
    rows, flat = rows[order], flat[order]
    out = np.zeros((n, n), bool)
    if not len(flat):
        return out
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    for start, end in zip(starts, [*starts[1:], len(flat)], strict=True):
        if end - start > 1:
            out[np.ix_(rows[start:end], rows[start:end])] = True
    return out


def _candidates(rows: list[tuple], known: list[Prefixes], join: Join) -> np.ndarray:
    """Which pairs of a block, or of its two halves, pass the filters of all later orders."""
    sizes = np.array([k.size for k in known])
    likely = 100 * np.minimum.outer(sizes, sizes) >= join.percent * np.maximum.outer(sizes, sizes)
    half, component = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    likely &= np.not_equal.outer(component, component)
    if half.min() != half.max():
        likely &= np.not_equal.outer(half, half)
    for order in range(join.orders - 1):
        if likely.any():
            likely &= _met([k.orders[order] for k in known])
    return likely


def block_nodes(bucket: int, rows: list[tuple[int, int, int, bytes]], join: Join) -> list[tuple[int, int]]:
    """The bucket and each node of it that sizes and bitmaps leave in a pair with another component."""
    known = [Parity(value) for *_, value in rows]
    sizes, words = np.array([k.size for k in known]), np.array([len(k.words) for k in known])
    half, component = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    crossing = half.min() != half.max()
    kept = np.zeros(len(rows), bool)
    # linked sets have bitmaps of one width, or of one and twice that
    for width in np.unique(words):
        own = np.flatnonzero((words == width) | (words == 2 * width))
        maps = np.stack([known[i].folded(width) for i in own])
        for at, i in enumerate(own):
            if words[i] != width:
                continue
            others = own[component[own] != component[i]]
            likely = 100 * np.minimum(sizes[others], sizes[i]) >= join.percent * np.maximum(sizes[others], sizes[i])
            if crossing:
                likely &= half[others] != half[i]
            others = others[likely]
            if len(others):
                differ = np.bitwise_count(maps[np.searchsorted(own, others)] ^ maps[at]).sum(axis=1, dtype=np.int64)
                met = others[join.may_differ(differ, sizes[others] + sizes[i])]
                if len(met):
                    kept[i] = kept[met] = True
    return [(bucket, rows[i][1]) for i in np.flatnonzero(kept).tolist()]


def block_links(bucket: int, rows: list[tuple[int, int, int, bytes]], join: Join) -> list[tuple[int, int]]:
    """Links that join components within a block of a bucket, or between its two halves.

    Pairs that meet in a bucket of an earlier token are left to it, and pairs that links
    found here have joined are passed over, so there are fewer links than rows.
    """
    known, first, sets = [], [], []
    for *_, value in rows:
        size = int.from_bytes(value[:4], "little")
        prefix = join.prefix(size)
        cut = 4 * (1 + (join.orders - 1) * prefix)
        known.append(Prefixes(value[:cut], join))
        # whole tokens: what met in an earlier bucket must have done so
        first.append(np.frombuffer(value, np.uint64, prefix, cut))
        sets.append(np.frombuffer(value, np.uint64, size, cut + 8 * prefix))
    token = np.int64(bucket).view(np.uint64)
    upto = np.array([int(np.flatnonzero(f == token)[0]) for f in first])
    likely = _candidates(rows, known, join)
    if likely.any():
        likely &= ~_met(first, upto)

    joined = {r[2]: r[2] for r in rows}

    def root(component: int) -> int:
        while joined[component] != component:
            joined[component] = component = joined[joined[component]]
        return component

    found = []
    for i, j in np.argwhere(np.triu(likely, 1)).tolist():
        a, b = root(rows[i][2]), root(rows[j][2])
        if a != b and similar(sets[i], sets[j], join):
            found.append((rows[i][1], rows[j][1]))
            joined[max(a, b)] = min(a, b)
    return found


def _components(members: DataFrame, nodes: DataFrame, join: Join) -> DataFrame:
    """``node`` and ``component`` of every class that is linked with another one."""
    # the size, with which both begin, tells where the bitmap starts
    filters = nodes.select("node", F.concat("others", "parity").alias("value"))
    bitmaps = nodes.select("node", F.col("parity").alias("value"))
    sets = nodes.select("node", F.col("shingles").alias("value"))

    def links(pairs: DataFrame) -> DataFrame:
        candidates = matching(pairs, filters, lambda v: Filters(v, join), lambda a, b: a.candidate(b, join))
        return matching(
            stored(candidates, "candidates"), sets, lambda v: np.frombuffer(v, np.uint64),
            lambda a, b: similar(a, b, join),
        )

    members, components = star_rounds(members, links, STAR_ROUNDS, BLOCK_NODES)
    if members.isEmpty():
        return components
    # bitmaps are small, so more of them fit a block
    paired = in_blocks(members, bitmaps, 4 * BLOCK_NODES, lambda bucket, rows: block_nodes(bucket, rows, join))
    paired = stored(paired.toDF("bucket", "node").distinct(), "paired-members")
    whole = nodes.select("node", F.concat("others", "first", "shingles").alias("value"))
    across = in_blocks(
        members.join(paired, ["bucket", "node"], "left_semi"), whole, BLOCK_NODES,
        lambda bucket, rows: block_links(bucket, rows, join),
    )
    across = stored(across, "links")
    return components if across.isEmpty() else connected_components(components.toDF("left", "right").union(across))


def similar_documents(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """Every row with its component of documents that links lead to.

    Returns ``doc_id``, ``n_shingles`` and ``component_id`` (the smallest identifier that
    links lead to, its own included). Null and empty texts, and those of white space
    alone, have no n-grams and no links. Texts are taken whole, however long. Rows repeated
    with one identifier are one document, whose text is taken to be the same; all of them
    are returned. Rows without an identifier link to nothing and have no component. Other
    columns are not looked at; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    with scratch(spark) as keep:
        common = common_tokens(docs, join)
        rows = stored(indexed(docs, common, join), "index")
        texts = stored(rows.where("set_key IS NOT NULL").drop("bucket"), "set-keys")
        named = texts.where("n_shingles > 0 AND doc_id IS NOT NULL")
        classes = stored(
            named.groupBy("set_key").agg(F.min("doc_id").cast("long").alias("node")), "classes"
        )
        index = rows.where("bucket IS NOT NULL").select("bucket", F.col("doc_id").cast("long").alias("doc_id"))
        shared = index.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = stored(index.join(shared, "bucket", "left_semi"), "shared-buckets")
        node_of = named.select("set_key", F.col("doc_id").cast("long").alias("doc_id")).distinct()
        node_of = stored(node_of.join(classes, "set_key").select("doc_id", "node"), "nodes")
        members = stored(met.join(node_of, "doc_id").select("bucket", "node").distinct(), "all-members")
        several = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = stored(members.join(several, "bucket", "left_semi"), "members")
        nodes = profiles(docs, members.select("node").distinct(), common, join)
        components = _components(members, nodes, join)
        of_class = classes.join(components, "node", "left").select(
            "set_key", F.coalesce("component", "node").alias("component_id")
        )
        linked = keep(texts.join(stored(of_class, "class-components"), "set_key", "left"), "linked")
        common.unpersist()
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"))
