"""Encoding, packing and token files against the tokenizers library and round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import cases
from topicsieve.llm import bpe, packing, token_files
from topicsieve.session import scratch_path

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = (
    "aA bB \n \t \r 0 1 é É Ü ß İ ı ς Σ ſ ŉ 日本 ́     \x1c \x85 ' 's 'LL don't <|endoftext|> "
    "<|startoftext|> <| |> 👍🏽 ​ ﬁ Å 한 \x00 \x7f ._-! ǅ Ω"
).split(" ") + [" ", "  ", " \n", "\n\n", "\t "]


def odd_texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def libraries():
    return {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}


@pytest.mark.parametrize("library_merges", [False, True])
def test_word_encoder_equals_library(libraries, library_merges):
    encoder = bpe.WordBpe(WORD, library_merges)
    for text in odd_texts(3000):
        ids = libraries[WORD].encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids, ascii(text)


def test_byte_encoder_equals_library(libraries):
    encoder = packing.ByteBpe(BYTE)
    for text in odd_texts(3000):
        ids = libraries[BYTE].encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids, ascii(text)


def test_merge_skips_stale_entries():
    encoder = bpe.WordBpe(WORD)
    for word in (b"a", b"aaaaaaaaaaaaaaa", b"thethethe", b"antidisestablishmentarianism", b"in" * 4000):
        assert encoder.merge(word) == encoder.merge_by_library(word)


def test_cache_forgets_by_generation():
    seen = []
    remembered = bpe.Remembered(lambda k: seen.append(k) or k.encode(), 2)
    assert remembered.all(["a", "b", "c", "a"]) == [b"a", b"b", b"c", b"a"]
    for key in "defga":
        remembered.all([key])
    assert len(remembered.young) <= 2 and len(remembered.old) <= 2
    assert seen.count("a") == 2


def sort_key(row):
    return tuple((x is not None, x) for x in row)


def test_encode_and_decode(spark, libraries):
    library = libraries[WORD]
    got = bpe.decode(bpe.encode(cases.frame(spark), WORD), WORD).collect()
    want = []
    for doc_id, text, *_ in cases.rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, got), key=sort_key) == sorted(want, key=sort_key)
    assert bpe.decode(bpe.encode(cases.empty(spark), WORD), WORD).collect() == []


def test_decode_leaves_out_unknown_ids(spark):
    df = spark.createDataFrame([(1, [0, -1, 10**6, 1]), (2, None), (3, [-5])], "doc_id long, ids array<int>")
    found = {r.doc_id: r.decoded for r in bpe.decode(df, WORD).collect()}
    assert found == {1: "! \"", 2: "", 3: ""}


def check_packed(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence)


def test_pieces_and_packing(spark, libraries):
    pieces = packing.token_pieces(cases.frame(spark), BYTE)
    packed = packing.pack(pieces)
    rows = packed.collect()
    n = check_packed(rows, 1024)
    assert n <= -(-sum(r.length for r in rows) // 1024) + 1
    want = Counter()
    for doc_id, text, *_ in cases.rows():
        ids = libraries[BYTE].encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 1024)]):
            stop = first if piece == 0 else start + 1024
            want[doc_id, piece, start, np.array(ids[start:stop], "<u4").tobytes()] += 1
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in rows) == want
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert packing.pack(packing.token_pieces(cases.empty(spark), BYTE)).collect() == []


def test_packing_is_close_to_the_bound():
    rng = np.random.default_rng(3)
    for make in (lambda: rng.integers(1, 1025, 5000), lambda: rng.integers(1, 200, 9000), lambda: np.full(999, 400)):
        counts = np.bincount(make(), minlength=1025)
        patterns = packing.plan_patterns(counts)
        used = np.zeros_like(counts)
        for pattern, times in patterns:
            assert sum(pattern) <= 1024
            np.add.at(used, pattern, times)
        assert (used == counts).all()
        bins = sum(t for _, t in patterns)
        total = (counts * np.arange(1025)).sum()
        per_bin = 1024 // np.flatnonzero(counts).min()
        assert bins <= 1.03 * max(total / 1024, counts.sum() / per_bin) + 1


def test_two_fit_replaces_the_smallest():
    counts = np.zeros(101, int)
    counts[[60, 35, 20, 19]] = 1
    # 60 + 35 leaves a gap of 5; 20 + 19 fill the place of 35 and more
    assert sorted(packing.fill(counts)) == [19, 20, 60]


def test_hot_length_and_bad_length(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "0 AS piece", "if(id % 3 = 0, 1024, 512) AS length", "'x' AS Offset")
    rows = packing.pack(df).collect()
    assert check_packed(rows, 1024) == 2000
    for bad in (0, 1025, None):
        with pytest.raises(Exception, match="length"):
            packing.pack(spark.createDataFrame([(1, 0, bad)], "doc_id long, piece int, length int")).collect()


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5, 5, 9, 1000, 10**12], list(range(0, 5000, 3)), [7] * 900])
def test_elias_fano(values):
    packed = token_files.EliasFano.of(np.array(values, np.int64))
    back, end = token_files.EliasFano.read(memoryview(packed.to_bytes()), 0)
    assert end == len(packed.to_bytes())
    assert back.all().tolist() == values
    assert [back.select(i) for i in range(len(values))] == values


@pytest.mark.parametrize("values", [[5, 5, 9, 1000, 10**12], list(range(0, 5000, 3)), [7] * 900, [*range(600), *range(10**6, 10**6 + 500)]])
def test_elias_fano_runs(values):
    packed = token_files.EliasFano.of(np.array(values, np.int64))
    n = len(values)
    for first in {0, 1, 200, 255, 256, 257, 511, 512, n - 1}:
        for count in (0, 1, 2, 255, 256, 257, 512, n):
            if first + count <= n:
                assert packed.select_run(first, count).tolist() == values[first : first + count]


def test_reading_selects(monkeypatch):
    docs = [None] * 300 + list(range(5, 1500, 2))
    ids = [np.arange(i % 7, dtype="<u4").tobytes() for i in range(len(docs))]
    shard = token_files.Shard.read(token_files.shard_image(docs, ids, 0))
    monkeypatch.delattr(token_files.EliasFano, "all")
    for i, count in ((0, 10), (290, 20), (299, 1), (300, 512), (0, len(docs)), (len(docs), 0)):
        assert shard.doc_ids(i, count) == docs[i : i + count]
        bounds = shard.bounds(i, count)
        assert [shard.tokens[a:b].astype("<u4").tobytes() for a, b in zip(bounds, bounds[1:])] == ids[i : i + count]


def test_elias_fano_is_small():
    rng = np.random.default_rng(1)
    ends = np.cumsum(rng.integers(1, 2000, 10_000))
    size = len(token_files.EliasFano.of(ends).to_bytes())
    assert size * 8 / len(ends) < 2 + np.log2(ends[-1] / len(ends)) + 1


@pytest.mark.parametrize("shard_tokens", [500, 10**6])
def test_token_files(spark, libraries, shard_tokens):
    path = scratch_path(spark, "test-shards")
    token_files.write_token_shards(cases.frame(spark), WORD, path, shard_tokens=shard_tokens)
    rows = sorted(token_files.read_token_shards(spark, path).collect(), key=lambda r: r.start)
    want = Counter()
    for doc_id, text, *_ in cases.rows():
        ids = libraries[WORD].encode(text or "", add_special_tokens=False).ids + [2]
        want[doc_id, np.array(ids, "<u4").tobytes()] += 1
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == want
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    image = spark.read.parquet(path).orderBy("part", "shard").first()
    shard = token_files.Shard.read(bytes(image.image))
    for i, r in enumerate(rows[: image.n_documents]):
        assert shard.document(i).astype("<u4").tobytes() == bytes(r.ids)
    assert zlib.crc32(bytes(rows[0].ids)) >= 0


def test_no_token_files(spark):
    path = scratch_path(spark, "test-shards")
    token_files.write_token_shards(cases.empty(spark), WORD, path)
    assert token_files.read_token_shards(spark, path).collect() == []
