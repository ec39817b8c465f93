"""Token ids as binary shards with Elias-Fano coded document boundaries.

A shard image is, in little-endian order::

    header          magic, documents, documents without identifier, tokens,
                    tokens before it in its part, smallest identifier, id width
    boundaries      Elias-Fano list of the documents' ends
    identifiers     Elias-Fano list of the documents' identifiers, less the smallest
    ids             all token ids, 2 or 4 bytes each

An Elias-Fano list of n ascending values below u stores the low log2(u / n) bits of
each value in a packed array and the rest in unary in a bit string, about
2 + log2(u / n) bits a value in all. Value i is found by the place of the i-th one in
the bit string; every ``SAMPLE``-th place is kept in 32 bits, and the bits from there
on are counted, so no table of 64-bit offsets exists in the file.

Shards are rows of a Parquet table (``part``, ``shard``, counts, ``image``), so Spark's
own committer puts them into any store and repeats lost tasks. Parts follow each other
in ascending order of identifiers, and shards within their part.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicsieve.llm.bpe import word_bpe
from topicsieve.llm.frames import slices, text_or_empty

#: A shard is closed once it has so many ids; a longer document is a shard of its own.
SHARD_TOKENS = 2_000_000
SAMPLE = 256
END_ID = 2
MAGIC = b"EFTOKEN1"
HEADER = struct.Struct("<8sQQQQqQ")
LIST_HEADER = struct.Struct("<QQQQ")
SHARDS = (
    "part int, shard int, n_documents bigint, n_tokens bigint, first_token bigint, image binary"
)


@dataclass
class EliasFano:
    """An ascending list of whole numbers."""

    n: int
    low_bits: int
    low: np.ndarray  # packed bits
    high: np.ndarray  # bit string, one bit set for each value
    samples: np.ndarray  # place of every SAMPLE-th bit that is set

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = (values[:, None] >> shifts) & np.uint64(1)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        return cls(
            n,
            low_bits,
            np.packbits(low.astype(np.uint8).ravel(), bitorder="little"),
            np.packbits(bits, bitorder="little"),
            places[::SAMPLE].astype(np.uint32),
        )

    def to_bytes(self) -> bytes:
        head = LIST_HEADER.pack(self.n, self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def read(cls, image: memoryview, at: int) -> tuple[EliasFano, int]:
        """The list at a place of an image, and the place after it."""
        n, low_bits, n_low, n_high = LIST_HEADER.unpack_from(image, at)
        at += LIST_HEADER.size
        low = np.frombuffer(image, np.uint8, n_low, at)
        high = np.frombuffer(image, np.uint8, n_high, at + n_low)
        n_samples = -(-n // SAMPLE)
        samples = np.frombuffer(image, "<u4", n_samples, at + n_low + n_high)
        return cls(n, low_bits, low, high, samples), at + n_low + n_high + 4 * n_samples

    def _low(self, first: int, count: int) -> np.ndarray:
        width = self.low_bits
        start = first * width
        some = self.low[start // 8 : (start + count * width + 7) // 8]
        bits = np.unpackbits(some, bitorder="little")[start % 8 :][: count * width]
        weights = np.uint64(1) << np.arange(width, dtype=np.uint64)
        return (bits.reshape(count, width) * weights).sum(1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """Value ``i``, from the sampled place before it."""
        place = int(self.samples[i // SAMPLE])
        byte, ones = place // 8, i % SAMPLE
        skip = place % 8
        while True:
            # a window that holds the value unless values are far apart
            bits = np.unpackbits(self.high[byte : byte + SAMPLE], bitorder="little")
            bits[:skip] = 0
            set_places = np.flatnonzero(bits)
            if len(set_places) > ones:
                high = byte * 8 + int(set_places[ones]) - i
                return (high << self.low_bits) | int(self._low(i, 1)[0])
            byte, ones, skip = byte + SAMPLE, ones - len(set_places), 0

    def select_run(self, first: int, count: int) -> np.ndarray:
        """Values ``first`` to ``first + count - 1``, between the sampled places around them."""
        if count <= 0:
            return np.zeros(0, np.int64)
        place, after = int(self.samples[first // SAMPLE]), -(-(first + count) // SAMPLE)
        byte = place // 8
        last = (int(self.samples[after]) + 7) // 8 if after < len(self.samples) else len(self.high)
        bits = np.unpackbits(self.high[byte:last], bitorder="little")
        bits[: place % 8] = 0
        places = np.flatnonzero(bits)[first % SAMPLE :][:count] + byte * 8
        high = (places - np.arange(first, first + count)).astype(np.uint64) << np.uint64(self.low_bits)
        return (high | self._low(first, count)).astype(np.int64)

    def all(self) -> np.ndarray:
        """All values in order."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        return (high | self._low(0, self.n)).astype(np.int64)


def shard_image(doc_ids: list[int | None], ids: list[bytes], first_token: int) -> bytes:
    """The image of documents in ascending order of identifiers, those without first."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    smallest = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(x) // 4 for x in ids])
    tokens = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if len(tokens) == 0 or int(tokens.max()) < 1 << 16 else 4
    head = HEADER.pack(
        MAGIC, len(ids), len(ids) - len(known), len(tokens), first_token, smallest, width
    )
    lists = EliasFano.of(ends).to_bytes() + EliasFano.of(known - smallest).to_bytes()
    return head + lists + tokens.astype(f"<u{width}").tobytes()


@dataclass
class Shard:
    """A view of a shard image; documents are read by their place in it."""

    first_token: int
    n_null: int
    smallest: int
    ends: EliasFano
    known: EliasFano
    tokens: np.ndarray

    @classmethod
    def read(cls, image: bytes) -> Shard:
        view = memoryview(image)
        magic, _, n_null, n_tokens, first, smallest, width = HEADER.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        ends, at = EliasFano.read(view, HEADER.size)
        known, at = EliasFano.read(view, at)
        return cls(first, n_null, smallest, ends, known, np.frombuffer(view, f"<u{width}", n_tokens, at))

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i``."""
        start = self.ends.select(i - 1) if i else 0
        return self.tokens[start : self.ends.select(i)]

    def bounds(self, i: int, count: int) -> np.ndarray:
        """Where ``count`` documents from ``i`` on start, and the last one of them ends."""
        if i:
            return self.ends.select_run(i - 1, count + 1)
        return np.concatenate([np.zeros(1, np.int64), self.ends.select_run(0, count)])

    def doc_ids(self, i: int, count: int) -> list[int | None]:
        """Identifiers of ``count`` documents from ``i`` on."""
        nulls = min(max(0, self.n_null - i), count)
        first = max(0, i - self.n_null)
        return [None] * nulls + (self.known.select_run(first, count - nulls) + self.smallest).tolist()


def write_token_shards(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode ``text`` of all ``docs`` and write the shards to ``path``.

    Null texts count as empty; each document ends with ``end_id``. Rows are in
    ascending order of ``doc_id``, then of their text's hash; those without an
    identifier come first. Texts, not ids, are shuffled: range bounds are sampled
    before anything is encoded. Other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(tokenizer, library_merges=True)
        end = struct.pack("<I", end_id)
        part = TaskContext.get().partitionId()
        shard = first_token = n_tokens = 0
        doc_ids: list[int | None] = []
        ids: list[bytes] = []

        def close() -> pa.RecordBatch:
            image = shard_image(doc_ids, ids, first_token)
            row = (part, shard, len(ids), n_tokens, first_token, image)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)],
                ["part", "shard", "n_documents", "n_tokens", "first_token", "image"],
            )

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                doc_ids.append(doc_id.as_py())
                ids.append(encoder.encode(text.as_py()) + end)
                n_tokens += len(ids[-1]) // 4
                if n_tokens >= shard_tokens:
                    yield close()
                    shard, first_token, n_tokens = shard + 1, first_token + n_tokens, 0
                    doc_ids, ids = [], []
        if ids:
            yield close()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(run, SHARDS).write.parquet(path)


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids``.

    ``ids`` are 32-bit little-endian integers. The driver sees one number per part.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    totals = sorted(
        tuple(r) for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    )
    starts, before = [], 0
    for part, n in totals:
        starts.append((part, before))
        before += n
    part_starts = spark.createDataFrame(starts, "part int, part_start bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part_start, image in zip(batch["part_start"], batch["image"], strict=True):
                shard = Shard.read(image.as_py())
                # a few documents at a time, their ids at four bytes each
                for i in range(0, shard.ends.n, 512):
                    count = min(512, shard.ends.n - i)
                    bounds = shard.bounds(i, count)
                    begins, ends = bounds[:-1], bounds[1:]
                    ids = [
                        shard.tokens[a:b].astype("<u4").tobytes()
                        for a, b in zip(begins, ends, strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids(i, count), pa.int64()),
                            pa.array(begins + shard.first_token + part_start.as_py()),
                            pa.array(ends - begins),
                            pa.array(ids, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return (
        shards.join(F.broadcast(part_starts), "part")
        .select("part_start", "image")
        .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
    )
