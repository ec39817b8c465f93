"""Byte pair encoding with a priority queue of merge ranks, and decoding.

A word is a doubly linked list of symbols. All mergeable neighbours enter a heap by
merge rank, then place; the cheapest is merged, the pairs with its new neighbours
enter the heap, and entries whose pair is no longer there are skipped when popped.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from topicsieve.llm.frames import slices, text_or_empty

#: Entries of each generation of a worker's caches, a bound on its memory.
CACHED_CHUNKS = 120_000
CACHED_WORDS = 150_000
#: As many times more where only ids are made, and nothing is decoded beside the caches.
LIBRARY_CACHES = 2
#: Longer chunks are encoded without being remembered.
CACHED_LENGTH = 64


@cache
def byte_characters() -> tuple[str, ...]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, the other bytes for the
    characters from code point 256 on, in ascending order.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(visible))
    table = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return tuple(table[b] for b in range(256))


class Remembered:
    """A function with a cache of two generations; the older one is dropped as a whole."""

    def __init__(self, compute: Callable[[str], bytes], limit: int):
        self.compute, self.limit = compute, limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, key: str) -> bytes:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.compute(key)
            if len(key) <= CACHED_LENGTH:
                if len(self.young) >= self.limit:
                    self.old, self.young = self.young, {}
                self.young[key] = found
        return found

    def all(self, keys: list[str]) -> list[bytes]:
        found = list(map(self.young.get, keys))
        if None in found:
            found = [self(key) if known is None else known for key, known in zip(keys, found)]
        return found


class WordBpe:
    """The encoder of a tokenizer file whose words end in a suffix and drop white space.

    Texts are split at spaces and line ends, which such a tokenizer drops and across
    which it does nothing. The pieces between them, and the words these hold, are
    encoded once and remembered.
    """

    # Pieces of these characters, printable ASCII and European letters, are normalised
    # and split here; the library's own parts before the merges do it for all others.
    SIMPLE = re.compile("[!-~À-ÖØ-öø-įı-ſ]*")
    WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-zß-öø-ſ0-9]+")

    def __init__(self, path: str, library_merges: bool = False):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        self.added_lowered = [t.lower() for t in self.added]
        characters = byte_characters()
        self.first = [vocabulary[c] for c in characters]
        self.last = [vocabulary[c + suffix] for c in characters]
        self.byte_table = dict(enumerate(characters))
        self.byte_of = {c: b for b, c in enumerate(characters)}
        pairs = (p.split(" ") if isinstance(p, str) else p for p in model["merges"])
        self.merges = {
            (vocabulary[left], vocabulary[right]): (rank, vocabulary[left + right])
            for rank, (left, right) in enumerate(pairs)
        }
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.merged = self.merge_by_library if library_merges else self.merge
        more = LIBRARY_CACHES if library_merges else 1
        self.words = Remembered(lambda word: self.encode_word(word.encode()), more * CACHED_WORDS)
        self.chunks = Remembered(self.encode_chunk, more * CACHED_CHUNKS)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        symbols = [self.first[b] for b in word[:-1]] + [self.last[word[-1]]]
        n, merges = len(symbols), self.merges
        following = [*range(1, n), -1]
        previous = list(range(-1, n - 1))
        heap: list[int] = []

        def offer(left: int, right: int) -> None:
            found = merges.get((symbols[left], symbols[right]))
            if found is not None:
                heapq.heappush(heap, found[0] * n + left)

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            rank, left = divmod(heapq.heappop(heap), n)
            right = following[left]
            if symbols[left] < 0 or right < 0:
                continue  # merged away, or nothing follows any more
            found = merges.get((symbols[left], symbols[right]))
            if found is None or found[0] != rank:
                continue  # stale: another pair stands here now
            symbols[left], symbols[right] = found[1], -1
            after = following[left] = following[right]
            if after >= 0:
                previous[after] = left
                offer(left, after)
            if previous[left] >= 0:
                offer(previous[left], left)
        return [s for s in symbols if s >= 0]

    def merge_by_library(self, word: bytes) -> list[int]:
        text = word.decode("latin-1").translate(self.byte_table)
        return [token.id for token in self.model.tokenize(text)]

    def encode_word(self, word: bytes) -> bytes:
        """Ids of a word, 32 bits each."""
        ids = self.merged(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a piece of text without spaces and line ends."""
        if any(map(chunk.__contains__, self.added)):
            # parts at odd places are added tokens; they stand outside of all words
            parts = self.added_pattern.split(chunk)
            return b"".join(
                struct.pack("<I", self.added[p]) if i % 2 else self.encode_plain(p)
                for i, p in enumerate(parts)
            )
        return self.encode_plain(chunk)

    def encode_plain(self, chunk: str) -> bytes:
        if self.SIMPLE.fullmatch(chunk):
            return b"".join(map(self.words, self.WORDS.findall(chunk.lower())))
        normal = self.library.normalizer.normalize_str(chunk)
        words = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return b"".join(self.encode_word(bytes(map(self.byte_of.get, w))) for w, _ in words)

    def encode(self, text: str) -> bytes:
        lowered = text.lower() if text.isascii() else text
        if not any(token in lowered for token in self.added_lowered):
            # fewer different chunks; only in added tokens does case matter
            text = lowered
        return b"".join(self.chunks.all(text.replace("\n", " ").split(" ")))


@cache
def word_bpe(path: str, library_merges: bool = False) -> WordBpe:
    """One encoder for each worker process and file."""
    return WordBpe(path, library_merges)


@cache
def vocabulary(path: str) -> pa.Array:
    """The string of each id of a tokenizer file; ids that no token has are null."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    tokens = {i: t for t, i in spec["model"]["vocab"].items()}
    tokens |= {x["id"]: x["content"] for x in spec["added_tokens"]}
    return pa.array([tokens.get(i) for i in range(max(tokens) + 1)])


def id_lists(encoded: Iterable[bytes]) -> pa.ListArray:
    encoded = list(encoded)
    offsets = np.cumsum([0, *(len(x) // 4 for x in encoded)])
    values = np.frombuffer(b"".join(encoded), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row's whole text.

    Null texts count as empty and give no ids; texts of any length are encoded whole,
    and an empty table gives one. Other columns are not looked at, and rows without an
    identifier or with a repeated one are encoded like all others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(path)
        for batch in slices(batches, "text"):
            ids = id_lists(encoder.encode(x.as_py()) for x in batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", text_or_empty().alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``: the vocabulary strings, a space between them.

    A file without a decoder joins by spaces; ids outside of the vocabulary are left
    out. Null ids give the empty text, an empty table an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = vocabulary(path)
        for batch in slices(batches, "ids"):
            lists = pc.fill_null(batch["ids"], pa.scalar([], batch["ids"].type))
            known = pc.if_else(
                pc.and_(pc.greater_equal(lists.values, 0), pc.less(lists.values, len(strings))),
                lists.values,
                None,
            )
            tokens = pa.ListArray.from_arrays(lists.offsets, strings.take(known))
            text = pc.binary_join(drop_null_items(tokens), " ")
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], lists, text], ["doc_id", "ids", "decoded"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    chosen = encoded.select("doc_id", "ids")
    return chosen.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def drop_null_items(lists: pa.ListArray) -> pa.ListArray:
    if lists.values.null_count == 0:
        return lists
    valid = lists.values.is_valid().to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(valid)])
    offsets = before[lists.offsets.to_numpy()]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lists.values.drop_null())
