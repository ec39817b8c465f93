"""Fill-in-middle and Merkle manifests by brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from topicsieve.llm import fill_in_middle as fim
from topicsieve.llm import merkle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PIECES = ["a", " ", "\n", "é", "日本", "👍🏽", "<", "P", ">", "\t", "\x1c", "\x85", "word", "<M", "S>"]


def brute_fim(text, doc_id, units):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return "plain", n, text, None, None
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:i], units[i:j], units[j:]))
    if h[3] % 100 < 80:
        return "spm", n, f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return "psm", n, f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def hostile(rng):
    return "".join(rng.choice(PIECES) for _ in range(rng.randrange(30))) + ("<S>" if rng.random() < 0.03 else "")


@pytest.mark.parametrize("unit", ["token", "char"])
def test_transformed_texts_by_brute_force(unit):
    rng = random.Random(3)
    recipe = fim.Recipe(unit=unit)
    forms = Counter()
    for doc_id in range(6_000):
        text = hostile(rng)
        units = UNIT.findall(text) if unit == "token" else list(text)
        got = fim.transform(text, doc_id, recipe)
        assert (got.form, got.units, got.text, got.prefix_chars, got.middle_chars) == brute_fim(text, doc_id, units)
        assert fim.restore(got.text, got.form, recipe) == text
        if got.form != "plain":
            raw = text.encode()
            assert len(raw[: got.prefix_bytes].decode()) == got.prefix_chars
            assert len(raw[got.prefix_bytes :][: got.middle_bytes].decode()) == got.middle_chars
        forms[got.form] += 1
    assert min(forms[f] for f in ("plain", "psm", "spm")) > 400


def test_index_of_exceptions():
    rng = random.Random(4)
    for text in [hostile(rng) for _ in range(300)] + ["", "ascii only " * 50, "日" * 100]:
        index = fim.Exceptions(np.frombuffer(text.encode(), np.uint8))
        chars = np.arange(len(text) + 1)
        raw = np.array([len(text[:i].encode()) for i in chars])
        assert (index.to_bytes(chars) == raw).all() and (index.to_chars(raw) == chars).all()
        assert len(index.bytes) == sum(not c.isascii() for c in text)


def test_whole_texts_are_transformed(spark):
    df = cases.frame(spark).repartition(5)
    made = fim.fill_in_middle(df)
    back = made.withColumn("back", fim.restored(F.col("text"), F.col("form")))
    got = [(r.doc_id, r.form, r.n_units, r.text, r.prefix_chars, r.middle_chars, r.back) for r in back.collect()]
    want = []
    for d, t, *_ in cases.rows():
        form, n, out, p, m = brute_fim(t, d, UNIT.findall(t or ""))
        want.append((d, form, n, out, p, m, t or ""))
    assert Counter(got) == Counter(want)
    assert fim.fill_in_middle(cases.empty(spark)).collect() == []


def test_recipes_are_checked():
    for wrong in (dict(unit="word"), dict(prefix=""), dict(prefix="<S>"), dict(prefix="ab", suffix="ba"), dict(prefix="<P><S>")):
        with pytest.raises(ValueError):
            fim.Recipe(**wrong)
    long = fim.Recipe(prefix="<|fim_prefix|>", suffix="<|fim_suffix|>", middle="<|fim_middle|>", plain_from=100)
    for doc_id in range(50):
        text = "some text | with < all > of it"
        got = fim.transform(text, doc_id, long)
        assert got.form != "plain" and fim.restore(got.text, got.form, long) == text


# manifests


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes, fan):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def brute_manifest(rows, fan):
    """doc_id, leaf, subroot, root, proof and folded root of (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0], H(*map(encoded, r)), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = levels_of([leaf for _, leaf, _ in groups[g]], fan)
    top = levels_of([trees[g][-1][0] for g in names], fan)
    out = []
    for at, g in enumerate(names):
        for place, (d, leaf, r) in enumerate(groups[g]):
            path = []
            for tree, j in ((trees[g], place), (top, at)):
                for level in tree[:-1]:
                    run = j - j % fan
                    path.append((level[run:j], level[j + 1 : run + fan]))
                    j //= fan
            given = leaf
            if d is not None and zlib.crc32(str(d).encode()) % 7 == 0 and r[3] is not None:
                given = H(*map(encoded, (*r[:3], r[3] + 1, r[4])))
            for before, after in path:
                given = H(*before, given, *after)
            proof = H(*(x for before, after in path for x in before + after))
            out.append((d, leaf, trees[g][-1][0], top[-1][0], proof, given))
    return out


def manifest_rows(spark, rows, fan, block):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    # columns that the manifest adds itself, and clashing names
    df = df.withColumn("root", F.lit("x")).withColumn("path", F.lit(1)).withColumn("size", F.lit("s")).withColumn("tree", F.lit(2))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    added = [*fields[:3], fields[3] + 1, fields[4]]
    leaves = df.withColumn("leaf", merkle.leaf(*fields)).withColumn(
        "given", F.when(chosen, merkle.leaf(*added)).otherwise(F.col("leaf"))
    )
    proven = merkle.manifest(leaves.repartition(5), "lang", ["doc_id"], "leaf", block, fan)
    assert set(proven.columns) == {*leaves.columns, "subroot"}
    return [
        tuple(r)
        for r in proven.select(
            "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")),
            merkle.folded(F.col("given"), F.col("path")),
        ).collect()
    ]


def texts_of(n, langs):
    rng = random.Random(n)
    return [(i * 3, f"src{i % 4}" if i % 9 else None, rng.choice(langs), len(str(i)) if i % 11 else None, "é" * (i % 5) if i % 6 else None) for i in range(n)]


@pytest.mark.parametrize(
    "rows, fan, block",
    [
        (texts_of(300, [None, "", "en", "de", "en", "éé", "z"]), 2, 4),
        (texts_of(300, ["en", "en", "en", "de"]), 2, 256),
        (texts_of(150, ["en", "de", "fr"]), 3, 9),
        ([(i, "s", f"lang{i:03d}", 1, "t") for i in range(40)], 2, 4),
        ([(1, "s", "en", 5, "only")], 2, 256),
        ([(d, s, l, n, t) for d, t, l, s, n, *_ in cases.rows()], 2, 8),
    ],
)
def test_manifests_by_brute_force(spark, rows, fan, block):
    assert Counter(manifest_rows(spark, rows, fan, block)) == Counter(brute_manifest(rows, fan))


def test_manifest_of_nothing(spark):
    assert manifest_rows(spark, [], 2, 256) == []


def test_manifest_needs_no_python(spark):
    df = cases.frame(spark).withColumn("leaf", merkle.leaf(F.col("doc_id"), F.col("text")))
    plan = merkle.manifest(df, "lang", ["doc_id"], "leaf")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
