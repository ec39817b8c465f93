"""Exact, line and near deduplication and components against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import cases
from topicsieve.llm import exact_dedup, line_dedup, near_dedup
from topicsieve.llm.components import connected_components

BLANKS = " \t\n\x0b\x0c\r"


def key(row):
    return tuple((x is not None, x) for x in row)


def by_order(rows):
    return sorted(map(tuple, rows), key=key)


# exact


def brute_exact(rows):
    normal = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t, *_ in rows]
    groups = defaultdict(list)
    for d, t in normal:
        groups[t].append(d)
    out = []
    for d, t in normal:
        named = [x for x in groups[t] if x is not None]
        keep = min(named) if named else None
        out.append((d, keep, len(groups[t]), d == keep, hashlib.sha256(t.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("runs, fan_in", [(64, 4), (1, 2), (5, 2)])
def test_exact_duplicates(spark, monkeypatch, runs, fan_in):
    merged = exact_dedup.merged_digests
    monkeypatch.setattr(exact_dedup, "merged_digests", lambda d: merged(d, runs, fan_in))
    got = exact_dedup.exact_duplicates(cases.frame(spark).repartition(7)).collect()
    assert by_order(got) == by_order(brute_exact(cases.rows()))


def test_exact_duplicates_of_nothing(spark):
    assert exact_dedup.exact_duplicates(cases.empty(spark)).collect() == []


def test_exact_dedup_is_native(spark):
    plan = exact_dedup.text_digests(cases.frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_each_level_of_a_merge_is_sorted_and_folded_in_order(spark):
    merged = exact_dedup.merged_digests(exact_dedup.text_digests(cases.frame(spark)), 64, 4)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    levels = 4  # 64 runs, 16, 4, 1
    assert plan.count("SortAggregate") == 2 * levels and "HashAggregate" not in plan
    assert plan.count("Exchange hashpartitioning(run") == levels
    assert plan.count("Sort [run") >= levels


# lines


def brute_lines(rows, min_chars=10):
    def line_key(line):
        k = line.strip(BLANKS)
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)

    holders = defaultdict(set)
    for d, t, *_ in rows:
        if d is not None:
            for line in (t or "").split("\n"):
                holders[line_key(line)].add(d)
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [
            x for x in lines
            if d is None or len(k := line_key(x)) < min_chars or len(holders[k]) < 2 or d == min(holders[k])
        ]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_repeated_lines_are_dropped(spark):
    shared = [
        (100, "A line of many words.\nown one here, long\nA line of many words."),
        (101, " a LINE of many words.\t\nÀ line of many words."),
        (102, "à line of many words.\nnine char\nnine char"),
        (103, "nine char\nA line of many words."),
    ]
    rows = cases.rows() + [(d, t, "en", "s", 1, "k", "i", "h", 0) for d, t in shared]
    df = spark.createDataFrame(rows, cases.SCHEMA).repartition(5)
    cut = line_dedup.drop_repeated_lines(df)
    got = [(r.doc_id, r.lines.n_lines, r.lines.n_dropped, r.text) for r in cut.collect()]
    assert by_order(got) == by_order(brute_lines(rows))
    assert set(cut.columns) == set(df.columns) | {"lines"}
    assert {r.kept for r in cut.collect()} == {"x", "k", None}


def test_no_lines(spark):
    assert line_dedup.drop_repeated_lines(cases.empty(spark)).collect() == []


# components


def brute_components(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a long path
    edges += [(5000, 6000 + i) for i in range(50)] + [(7, 7), (None, 3), (4, None)] + edges[:9]
    got = connected_components(spark.createDataFrame(edges, "a int, b int")).collect()
    assert {r.node: r.component for r in got} == brute_components(edges)
    assert len(got) == len({r.node for r in got})


def test_no_components(spark):
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


# near duplicates


def brute_near(rows, percent):
    sets = {}
    for d, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        n = min(5, len(w))
        sets[d] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()
    named = [d for d in sets if d is not None]
    edges = [(d, d) for d in named]
    for i, a in enumerate(named):
        for b in named[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * len(sets[a] | sets[b]):
                edges.append((a, b))
    found = brute_components(edges)
    return sets, {d: found.get(d, d) for d in named}


def variants(rng, n):
    """Families whose members differ from each other more than from some of them."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(40, 220))]
        for _ in range(rng.randint(1, 9)):
            if rng.random() < 0.6:
                text[rng.randrange(len(text))] = "Changed" + str(rng.randrange(99))
            rows.append(" ".join(text))
    return rows


@pytest.mark.parametrize("percent, band_rows, rounds, block", [(80, 4, 3, 512), (85, 5, 1, 3)])
def test_near_duplicates(spark, monkeypatch, percent, band_rows, rounds, block):
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", block)
    rng = random.Random(percent + rounds)
    texts = variants(rng, 60)
    rng.shuffle(texts)
    more = [(1000 + i, t, "en", "s", 1, "k", "i", "h", 0) for i, t in enumerate(texts)]
    rows = cases.rows() + more
    df = spark.createDataFrame(rows, cases.SCHEMA).repartition(6)
    got = near_dedup.near_duplicates(df, near_dedup.Rule(percent, band_rows)).collect()
    sets, components = brute_near(rows, percent)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), components[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_no_near_duplicates(spark):
    assert near_dedup.near_duplicates(cases.empty(spark)).collect() == []


def test_bands_follow_from_the_threshold():
    for rule in (near_dedup.Rule(80, 4), near_dedup.Rule(85, 5)):
        missed = (1 - (rule.percent / 100) ** rule.band_rows) ** rule.bands
        assert missed <= near_dedup.MISS
        assert 0 < rule.least_agreeing < rule.minima * rule.percent / 100


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 63, 3000, np.uint64)
    b = np.concatenate([a[:2400], rng.integers(0, 1 << 63, 600, np.uint64)])
    agree = (near_dedup.sketch(np.unique(a), 512) == near_dedup.sketch(np.unique(b), 512)).mean()
    assert abs(agree - 2400 / 3600) < 0.1
