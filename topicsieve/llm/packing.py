"""Packing documents into sequences of bounded length by best-two-fit.

How pieces share sequences depends on their lengths only, of which there are at most
``capacity`` different ones. So the plan is made from the histogram of lengths: it is
a list of patterns (lengths that share a sequence) with the number of sequences that
follow each. The pieces are numbered within their length, in a distributed way, and
look up their sequence and offset by that number. Neither a task nor the driver ever
holds more than the histogram, its share of the pieces, and the plan.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicsieve.llm.bpe import Remembered, byte_characters
from topicsieve.llm.frames import slices, stored, text_or_empty

#: Fixed value: the pattern that such a tokenizer splits texts by.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
RUNS = re.compile(r" \s|\s ")
EDGES = re.compile(r"(?<=\S) (?=\S)")
CACHED_PARTS = 250_000
CAPACITY = 1024
END_ID = 2


class ByteBpe:
    """The encoder of a byte-level tokenizer file.

    No token crosses a single space between two characters that are not white space
    without starting at it. So texts are split there, and the parts are encoded once
    and remembered. Merge ranks are the ids, as in the rank files of this kind.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(map(byte_of.get, t)): i for t, i in spec["model"]["vocab"].items()}
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        library = tiktoken.Encoding(
            "byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
        self.ids = lambda text: np.array(library.encode(text, allowed_special="all"), "<u4").tobytes()
        self.spaced = Remembered(lambda part: self.ids(" " + part), CACHED_PARTS)

    def encode(self, text: str) -> bytes:
        # beside other white space, a space belongs to a run that is split as a whole
        parts = EDGES.split(text) if RUNS.search(text) else text.split(" ")
        return self.ids(parts[0]) + b"".join(self.spaced.all(parts[1:]))


@cache
def byte_bpe(path: str) -> ByteBpe:
    """One encoder for each worker process and file."""
    return ByteBpe(path)


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Every document's ids and end id, cut into pieces of at most ``capacity``.

    Returns ``doc_id``, ``piece`` (from 0), ``start``, ``length`` and ``ids``, as 32-bit
    little-endian integers. All pieces but the first are full. A null text is empty and
    gives one piece with the end id; repeated rows and rows without an identifier are
    cut like all others, and other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text"):
            rows: list[tuple[int, int, int, int, bytes]] = []
            for row, text in enumerate(batch["text"]):
                ids = encoder.encode(text.as_py()) + end
                total = len(ids) // 4
                first = (total - 1) % capacity + 1
                cuts = [0, *range(first, total + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((row, piece, start, stop - start, ids[4 * start : 4 * stop]))
            source, piece, start, length, ids = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(source)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", text_or_empty().alias("text"))
    return chosen.mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary"
    )


def fill(counts: np.ndarray) -> list[int]:
    """The lengths of one sequence, taken from ``counts`` (pieces left of each length).

    The longest pieces that fit are added until none does. Then the smallest one gives
    way to the two unpacked ones that fill its place and the gap best, if that is more.
    The largest piece always stays.
    """
    capacity = len(counts) - 1
    left = counts.copy()
    chosen: list[int] = []
    gap = capacity
    while (fitting := np.flatnonzero(left[: gap + 1])).size:
        chosen.append(int(fitting[-1]))
        left[chosen[-1]] -= 1
        gap -= chosen[-1]
    if gap and len(chosen) > 1:
        smallest = chosen[-1]
        room = gap + smallest
        sizes = np.flatnonzero(left[: room + 1])
        # for each length, the longest partner that still fits
        partner = sizes[np.searchsorted(sizes, room - sizes, "right") - 1] if sizes.size else sizes
        fits = (sizes + partner <= room) & ((sizes != partner) | (left[sizes] > 1))
        if fits.any() and (total := (sizes + partner)[fits]).max() > smallest:
            best = int(total.argmax())
            chosen[-1:] = [int(sizes[fits][best]), int(partner[fits][best])]
    return chosen


def plan_patterns(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """Patterns of lengths, and how many sequences follow each.

    A pattern is used until one of its lengths runs short, so there are about as many
    patterns as lengths, however many pieces there are.
    """
    left = counts.copy()
    patterns = []
    while left.any():
        pattern = fill(left)
        sizes, uses = np.unique(pattern, return_counts=True)
        times = int((left[sizes] // uses).min())
        left[sizes] -= times * uses
        patterns.append((pattern, times))
    return patterns


def plan_places(patterns: list[tuple[list[int], int]]) -> dict[int, list[tuple[int, int, int]]]:
    """For each length: number of the first piece, its sequence and the offset there."""
    places: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            first = used.get(length, 0)
            places.setdefault(length, []).append((first, sequence, offset))
            used[length] = first + times
            offset += length
        sequence += times
    return places


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, which replace columns so named.

    ``pieces`` has ``doc_id``, ``piece`` and ``length`` (1 to ``capacity``; another one
    is an error). Every row is placed, repeated ones too. Sequences are gapless from 0.
    Pieces are dealt by range over length and identifier, so that a length that half of
    all pieces have is numbered by many tasks.
    """
    own = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    checked = pieces.select(*own).withColumn(
        "_length",
        F.when(F.col("length").between(1, capacity), F.col("length").cast("long")).otherwise(
            F.raise_error(F.lit(f"a piece's length must be from 1 to {capacity}"))
        ),
    )
    # stored first, as the sampling of range bounds would make the pieces twice
    ranged = stored(
        stored(checked, "pieces")
        .repartitionByRange("_length", "doc_id", "piece")
        .withColumn("_part", F.spark_partition_id()),
        "ranged-pieces",
    )
    # one row for each length of a part: as many as parts and lengths together
    counted = sorted(
        (r["_length"], r["_part"], r["n"])
        for r in ranged.groupBy("_length", "_part").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    counts = np.zeros(capacity + 1, np.int64)
    before = []
    for length, part, n in counted:
        before.append((length, part, int(counts[length])))
        counts[length] += n
    places = plan_places(plan_patterns(counts))

    spark = pieces.sparkSession
    before_rows = spark.createDataFrame(before, "_length bigint, _part int, _before bigint")
    place = "struct<first: bigint, sequence_id: bigint, offset: bigint>"
    place_rows = spark.createDataFrame(
        list(places.items()), f"_length bigint, _places array<{place}>"
    )
    number = F.row_number().over(Window.partitionBy("_length", "_part").orderBy("doc_id", "piece"))
    numbered = (
        ranged.withColumn("_number", number - 1)
        .join(F.broadcast(before_rows), ["_length", "_part"])
        .join(F.broadcast(place_rows), "_length")
        .withColumn("_number", F.col("_number") + F.col("_before"))
        .withColumn(
            "_place",
            F.element_at(F.filter("_places", lambda p: p["first"] <= F.col("_number")), -1),
        )
    )
    return numbered.select(
        *own,
        (F.col("_place.sequence_id") + F.col("_number") - F.col("_place.first")).alias("sequence_id"),
        F.col("_place.offset").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and the ids of each whole sequence, from packed pieces with ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"])).alias("ids"),
        )
    )
