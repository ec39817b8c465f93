"""The n-gram join by brute force: every pair, under filters of several orders."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm import cases
from tests.llm.test_dedup import brute_near, variants
from topicsieve.llm import prefix_join, shingles


def documents(spark, texts):
    more = [(1000 + i, t, "en", "s", 1, "k", "i", "h", 0) for i, t in enumerate(texts)]
    rows = cases.rows() + more
    return rows, spark.createDataFrame(rows, cases.SCHEMA).repartition(6)


def passages(rng, n):
    """Texts that share passages but are not alike, some of a third of their words."""
    words = [f"p{i}" for i in range(500)]
    shared = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(3)]
    return [" ".join([rng.choice(shared), *(rng.choice(words) for _ in range(rng.randint(20, 150)))]) for _ in range(n)]


@pytest.mark.parametrize(
    "percent, rounds, block, bits, counted",
    [(80, 3, 256, 1 << 25, 1 << 21), (80, 1, 3, 1 << 10, 500), (90, 0, 4, 1 << 16, 2_000), (60, 1, 5, 64, 1 << 21)],
)
def test_similar_documents(spark, monkeypatch, percent, rounds, block, bits, counted):
    monkeypatch.setattr(prefix_join, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(prefix_join, "BLOCK_NODES", block)
    monkeypatch.setattr(prefix_join, "COMMON_BITS", bits)
    monkeypatch.setattr(prefix_join, "COUNTED", counted)
    rng = random.Random(percent + rounds)
    texts = variants(rng, 40) + passages(rng, 40)
    rng.shuffle(texts)
    rows, df = documents(spark, texts)
    got = prefix_join.similar_documents(df, prefix_join.Join(percent)).collect()
    sets, components = brute_near(rows, percent)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), components[r.doc_id])
    assert max(Counter(components.values()).values()) > 5


def test_no_similar_documents(spark):
    assert prefix_join.similar_documents(cases.empty(spark)).collect() == []
    unlike = documents(spark, [])[1].where("doc_id IN (4, 8)")
    got = prefix_join.similar_documents(unlike).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(4, 4), (8, 8)]


def test_linked_sets_share_a_prefix_under_every_order():
    rng = np.random.default_rng(1)
    bitmap = rng.integers(0, 256, 1 << 8, np.uint8)
    join = prefix_join.Join(80, orders=5)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        both = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        a = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 1)), np.uint64)]))
        b = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 1)), np.uint64)]))
        linked = 100 * len(both) >= 80 * len(np.union1d(a, b))
        assert prefix_join.similar(a, b, join) == linked
        if linked:
            pa, pb = (prefix_join.prefixes(x, bitmap, join) for x in (a, b))
            assert all(len(p) == join.prefix(len(a)) for p in pa)
            assert all(np.isin(p, q).any() for p, q in zip(pa, pb, strict=True))
            known = [
                prefix_join.Prefixes(prefix_join.Prefixes.packed(len(x), p[1:]), join) for x, p in ((a, pa), (b, pb))
            ]
            assert known[0].candidate(known[1], join)


def test_common_tokens_come_last():
    found = np.sort(np.random.default_rng(2).integers(0, 1 << 63, 100, np.uint64))
    join = prefix_join.Join(80, orders=3)
    bitmap = np.zeros(1 << 12, np.uint8)
    for t in found[:70]:
        bit = int(t) & (len(bitmap) * 8 - 1)
        bitmap[bit >> 3] |= 1 << (bit & 7)
    assert prefix_join.is_common(found, bitmap)[:70].all()
    for prefix in prefix_join.prefixes(found, bitmap, join):
        assert not prefix_join.is_common(prefix, bitmap).any()


@pytest.mark.parametrize("hashed", [1, 7, 64, 1 << 20])
def test_token_sets(monkeypatch, hashed):
    monkeypatch.setattr(shingles, "HASHED", hashed)
    rng = random.Random(hashed)
    seen = {}
    for text in [t or "" for t in cases.TEXTS if t != cases.LONG] + [
        "".join(rng.choice("aAbB é\n\t\x0b\x1c日") for _ in range(rng.randrange(60))) for _ in range(300)
    ]:
        lowered = "".join(c.lower() if c.isascii() else c for c in text)
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        n = min(5, len(words))
        want = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
        got = shingles.tokens(text)
        assert len(got) == len(want) and (np.diff(got.astype(object)) > 0).all()
        key = frozenset(want)
        assert seen.setdefault(key, got.tobytes()) == got.tobytes()
    assert len({v for v in seen.values()}) == len(seen)


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(6)
    ruled_out = 0
    for percent in (60, 80, 95):
        join = prefix_join.Join(percent)
        for _ in range(400):
            both = rng.integers(0, 1 << 63, int(rng.integers(1, 400)), np.uint64)
            extra = [rng.integers(0, 1 << 63, int(rng.integers(0, len(both) // 4 + 2)), np.uint64) for _ in range(2)]
            a, b = (np.unique(np.concatenate([both, e])) for e in extra)
            may = prefix_join.Parity(prefix_join.parity(a)).may_link(prefix_join.Parity(prefix_join.parity(b)), join)
            assert may or not prefix_join.similar(a, b, join)
            ruled_out += not may
            rows = [(0, 1, 1, prefix_join.parity(a)), (0, 2, 2, prefix_join.parity(b))]
            assert (len(prefix_join.block_nodes(9, rows, join)) == 2) == may
    assert ruled_out > 300
