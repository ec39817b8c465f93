"""Keyword, TF-IDF and vector features against hand-computed values."""

import math

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from topicsieve.functions import text
from topicsieve.functions.keywords import keyword_hit, keyword_score
from topicsieve.functions.vectors import vector_score
from topicsieve.operators import similarity, vocabulary
from topicsieve.operators.topics import normalize_keywords


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "body, keyword, expected",
    [
        ("AI-driven threat", "AI", True),
        ("pain at the airport", "AI", False),
        ("a zero-trust model", "zero-trust", True),
        ("nonzero-trusting", "zero-trust", True),
        ("the threat model", "threat  model", False),
        ("ñai", "ai", False),
        ("(ai)", "ai", True),
        ("ai_x", "ai", False),
        ("written in c++ today", "c++", False),
        ("c++x", "c++", True),
        ("a.b", "a.b", True),
        ("axb", "a.b", False),
        ("anything", "  ", False),
        ("ends with ai", " AI ", True),
        (None, "ai", False),
    ],
)
def test_keyword_hit(spark, body, keyword, expected):
    assert one(spark, keyword_hit(F.lower(F.lit(body).cast("string")), keyword)) is expected


@pytest.mark.parametrize(
    "axes, expected",
    [
        ({}, 0.0),
        ({"a": []}, 0.0),
        ({"a": ["alpha", "beta", "", "gamma"]}, 0.5),
        ({"a": ["alpha"], "b": []}, 0.5),
        ({"a": ["nope"], "b": ["beta", "alpha"], "c": ["alpha"]}, 2 / 3),
    ],
)
def test_keyword_score(spark, axes, expected):
    assert one(spark, keyword_score(F.lit("alpha and beta"), axes)) == pytest.approx(expected)


def test_keyword_score_of_empty_text_is_zero(spark):
    assert one(spark, keyword_score(F.lit(""), {"a": ["x"], "b": ["y"]})) == 0.0


def test_strip_removes_unicode_white_space(spark):
    assert one(spark, text.strip(F.lit(" \t a b \r\n　"))) == "a b"


def test_rounding_is_half_up_on_the_scaled_value(spark):
    values = spark.createDataFrame([(0.00015,), (0.33335,), (0.12344,)], "x double")
    rounded = [r[0] for r in values.select(text.round_half_up(F.col("x"), 4)).collect()]
    assert rounded == [math.floor(x * 10000 + 0.5) / 10000 for x in (0.00015, 0.33335, 0.12344)]


def test_stop_list_is_the_one_of_spark(spark):
    assert set(text.DEFAULT_STOP_WORDS) == set(StopWordsRemover.loadDefaultStopWords("english"))


def test_bigrams_are_formed_after_stop_words(spark):
    df = spark.createDataFrame([("The Ñandú of a_b x detección",), ("",), ("one",)], "text string")
    terms = [r["terms"] for r in vocabulary.with_terms(df).collect()]
    assert terms == [
        ["ñandú", "a_b", "detección", "ñandú a_b", "a_b detección"],
        [],
        ["one"],
    ]


def test_term_counts_within_a_row(spark):
    df = spark.createDataFrame([(1, "red red blue red"), (2, ""), (3, "blue")], "id int, text string")
    rows = {(r["id"], r["term"]): r["tf"] for r in vocabulary.term_frequency(df, "id").collect()}
    assert rows == {
        (1, "red"): 3, (1, "blue"): 1, (1, "red red"): 1, (1, "red blue"): 1, (1, "blue red"): 1, (3, "blue"): 1,
    }


def corpus(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def test_fit_needs_two_documents(spark):
    for texts in ([], ["only one here"], ["only one here", "  ", None]):
        assert not vocabulary.fit(corpus(spark, *texts)).is_fitted


def test_terms_of_all_documents_are_pruned_in_a_small_corpus(spark):
    fitted = vocabulary.fit(corpus(spark, "shared apple", "shared pear"))
    assert fitted.n_docs == 2
    assert fitted.terms == ("apple", "pear", "shared apple", "shared pear")


def test_near_copies_send_only_the_limit_to_the_driver(spark, monkeypatch):
    common = " ".join(f"common{i:02d}" for i in range(30))
    sent = []
    limited = vocabulary.limit_vocabulary
    monkeypatch.setattr(vocabulary, "limit_vocabulary", lambda f, n: sent.append(n) or limited(f, n))
    fitted = vocabulary.fit(corpus(spark, f"{common} zeta", f"{common} eta"), max_features=2)
    assert fitted.terms == ("common29 eta", "common29 zeta")
    assert sent == [2]


def test_vocabulary_limit_breaks_ties_by_term(spark):
    fitted = vocabulary.fit(corpus(spark, "bb aa", "cc aa", "dd"), max_features=3)
    assert fitted.terms == ("aa", "bb", "bb aa")


def test_scores_by_hand(spark):
    docs = corpus(spark, "red blue", "red green", "green", "", "   ", "unknown")
    fitted = vocabulary.fit(docs)
    assert fitted.n_docs == 4
    idf = dict(zip(fitted.terms, fitted.idf_values()))
    assert idf["red"] == pytest.approx(math.log(5 / 3) + 1)
    scored = {r["text"]: r["tfidf"] for r in similarity.with_tfidf_score(docs, "red", fitted).collect()}
    parts = [idf["red"], idf["blue"], idf["red blue"]]
    assert scored["red blue"] == pytest.approx(idf["red"] / math.sqrt(sum(p * p for p in parts)))
    assert scored["green"] == 0.0
    assert scored[""] == 0.5
    assert scored["   "] == 0.0


def test_neutral_and_zero_scores(spark):
    docs = corpus(spark, "red blue", "red green")
    fitted = vocabulary.fit(docs)
    value = lambda q, v: {r["tfidf"] for r in similarity.with_tfidf_score(docs, q, v).collect()}
    assert value("nothing known", fitted) == {0.0}
    assert value("", fitted) == {0.5}
    assert value("red", vocabulary.Vocabulary(1)) == {0.5}


def test_statistics_of_batches_add_up(spark):
    first, second = corpus(spark, "aa bb", "aa"), corpus(spark, "bb cc", "", "cc cc")
    merged = vocabulary.merge_statistics(
        vocabulary.term_statistics(first), vocabulary.term_statistics(second)
    )
    assert vocabulary.vocabulary_from_statistics(merged) == vocabulary.fit(first.union(second))


def test_two_vocabularies_at_once(spark):
    docs = corpus(spark, "red blue", "red green", "green", "", "   ")
    one, two = vocabulary.fit(docs), vocabulary.fit(docs.limit(2))
    both = similarity.with_tfidf_scores(docs, "red", {"a": one, "b": two, "c": vocabulary.Vocabulary(1)}).collect()
    alone = [similarity.with_tfidf_score(docs, "red", v).collect() for v in (one, two)]
    for name, rows in zip("ab", alone):
        assert {r["text"]: r[name] for r in both} == pytest.approx({r["text"]: r["tfidf"] for r in rows})
    assert {r["c"] for r in both} == {0.5}


def test_vocabulary_round_trip(spark, tmp_path):
    fitted = vocabulary.fit(corpus(spark, "aa bb", "aa cc", "dd"))
    fitted.save(spark, f"{tmp_path}/v")
    assert vocabulary.Vocabulary.load(spark, f"{tmp_path}/v") == fitted


def test_vectors_have_unit_length(spark):
    docs = spark.createDataFrame([(1, "red blue red"), (2, "green red"), (3, "gold")], "id int, text string")
    vectors = similarity.tfidf_vectors(docs, vocabulary.fit(docs), "id")
    lengths = vectors.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("l")).collect()
    assert {r["id"] for r in lengths} == {1, 2, 3}
    assert all(r["l"] == pytest.approx(1.0) for r in lengths)


@pytest.mark.parametrize(
    "stored, query, expected",
    [
        (None, [1.0, 0.0], 0.5),
        ([], [1.0, 0.0], 0.5),
        ([0.0, 0.0], [1.0, 0.0], 0.5),
        ([1.0, 0.0], [0.0, 0.0], 0.5),
        ([1.0, 0.0], None, 0.5),
        ([2.0, 0.0], [1.0, 0.0], 1.0),
        ([-3.0, 0.0], [1.0, 0.0], 0.0),
        ([0.0, 5.0], [1.0, 0.0], 0.5),
    ],
)
def test_vector_score(spark, stored, query, expected):
    df = spark.createDataFrame([(stored,)], "embedding array<float>")
    assert df.select(vector_score(F.col("embedding"), query)).first()[0] == pytest.approx(expected)


def test_normalize_keywords(spark):
    df = spark.createDataFrame(
        [("New, old;;  NEW\n\n third ,", ["Old"]), ("", None)], "pasted string, existing array<string>"
    )
    found = [r["keywords"] for r in normalize_keywords(df, "pasted", "existing").collect()]
    assert found == [["Old", "New", "third"], []]


def test_statistics_hand_arrays_of_tokens_to_the_count(spark):
    """Slices and batches of documents add up; no row per term of a document is made."""
    texts = ["Alpha beta alpha beta", "beta gamma", "", None, "x", "delta " * 5]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    found = vocabulary.term_statistics(docs)
    got = {r["term"]: (r["df"], r["cf"]) for r in found.collect()}
    assert got == {
        "": (4, 4), "alpha": (1, 2), "beta": (2, 3), "gamma": (1, 1), "delta": (1, 5),
        "alpha beta": (1, 2), "beta alpha": (1, 1), "beta gamma": (1, 1), "delta delta": (1, 4),
    }
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("tokens", [1, 3, 100])
def test_slices_of_counted_documents(monkeypatch, tokens):
    import pyarrow as pa

    monkeypatch.setattr(vocabulary, "COUNTED_TOKENS", tokens)
    rows = [["aa", "bb", "aa"], [], ["bb", "cc", "dd", "bb"], ["aa"]]
    batch = pa.RecordBatch.from_arrays([pa.array([["zz"], *rows], pa.list_(pa.string()))], names=["_tokens"])
    total = {}
    for part in vocabulary._counted_terms(iter([batch.slice(1)])):
        for r in part.to_pylist():
            df, cf = total.get(r["term"], (0, 0))
            total[r["term"]] = (df + r["df"], cf + r["cf"])
    assert total == {
        "": (4, 4), "aa": (2, 3), "bb": (2, 3), "cc": (1, 1), "dd": (1, 1),
        "aa bb": (1, 1), "bb aa": (1, 1), "bb cc": (1, 1), "cc dd": (1, 1), "dd bb": (1, 1),
    }
