"""Rows of their own for what was found in round 3."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contract.queries import QUERIES
from topicsieve.functions.keywords import keyword_hit, whole_word_pattern
from topicsieve.functions.text import tokens
from topicsieve.functions.words import split_words, text_slices
from topicsieve.llm import near_dedup, pairs, prefix_join
from topicsieve.operators import embedding, vocabulary
from topicsieve.operators.similarity import with_tfidf_score
from topicsieve.operators.vocabulary import Vocabulary, fit, term_statistics, vocabulary_from_statistics
from topicsieve.plans.rescore import fit_corpus, rescore
from topicsieve.session import dealt, gathered
from topicsieve.sources.files import read_binary
from topicsieve.topic import Topic


def test_vector_score_embeds_documents_without_a_vector(spark, tmp_path):
    given = [(0, [1.0, 0.0]), (1, [0.0, 1.0])]
    unit = [(i, v + [0.0] * 62) for i, v in given]
    spark.createDataFrame(unit, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    texts = [(0, "alpha"), (2, "beta gamma"), (3, ""), (4, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["vec_id"]: r["sbert"] for r in QUERIES["vector_score"](spark, str(tmp_path)).collect()}
    assert set(got) == {0, 1, 2} and got[0] == 1.0 and got[1] == 0.5


def test_files_are_dealt_by_their_number(spark):
    rows = spark.range(100).coalesce(1)
    many = dealt(rows, 5)
    assert many.rdd.getNumPartitions() == 20 and many.count() == 100
    assert dealt(rows, 1000).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_a_vocabulary_that_is_given_is_not_fitted_again(spark):
    rows = [("P1", "alpha beta", None), ("P2", "beta gamma", None), ("P3", "delta", None)]
    papers = spark.createDataFrame(rows, "paper_id string, text string, title string").select(
        "*", F.lit(2020).alias("year"), F.array(F.lit(1.0)).alias("embedding")
    )
    topic = Topic("t", "alpha beta", {"core": ["alpha"]}, (2016, 2026))
    known = fit_corpus(papers)
    texts_only = papers.where("paper_id = 'P1'")
    # one document is too few for a fit, so a refit would give the neutral score
    (row,) = rescore(texts_only, topic, vocabulary=known).collect()
    (whole,) = rescore(papers, topic).where("paper_id = 'P1'").collect()
    assert row["score_breakdown"] == whole["score_breakdown"]


def test_words_are_split_by_their_bytes(spark):
    """The words of ``tokens``, whatever their characters, rows and slices."""
    texts = ["ab_1 é漢 x² 𝔞𝔟-½٣", "", "a", "é", "zz", "ﬁn\nab", "日本 ́a", "x" * 50 + " ab ab"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    want = [(r["i"], w) for r in df.select("i", tokens(F.col("text")).alias("w")).orderBy("i").collect() for w in r["w"]]
    given = pa.array(["before", *texts]).slice(1)
    ids, known, row = split_words(given)
    assert [(int(i), known[int(n)].as_py()) for i, n in zip(row, ids)] == want
    assert [t.as_py() for part in text_slices(given, 8) for t in part] == texts


def test_fit_does_not_list_tokens_in_the_plan(spark):
    docs = spark.createDataFrame([("alpha beta",), ("beta",)], "text string")
    plan = term_statistics(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_scores_make_no_vector_of_the_vocabulary(spark):
    docs = spark.createDataFrame([("P1", "alpha beta beta"), ("P2", "gamma"), ("P3", "")], "id string, text string")
    scored = with_tfidf_score(docs, "alpha beta", Vocabulary(2, ("alpha", "beta", "alpha beta"), (1, 2, 1), (1, 2, 1)))
    assert "vector" not in scored._jdf.queryExecution().optimizedPlan().toString().lower()
    got = {r["id"]: r["tfidf"] for r in scored.collect()}
    a, b = math.log(1.5) + 1, 1.0
    unit = math.sqrt(2 * a * a + b * b)
    assert got["P2"] == 0.0 and got["P3"] == 0.5
    assert abs(got["P1"] - (2 * a * a + 2 * b * b) / unit / math.sqrt(2 * a * a + 4 * b * b)) < 1e-12


def test_small_files_are_read_in_few_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for i in range(40 * cores):
        (tmp_path / f"{i}.pdf").write_text(str(i))
    found = read_binary(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > cores
    few = gathered(found)
    assert few.rdd.getNumPartitions() == cores
    assert sorted(int(bytes(r["content"])) for r in few.collect()) == list(range(40 * cores))


@pytest.mark.parametrize("module", [near_dedup, prefix_join])
def test_variants_that_are_not_linked_meet_in_one_star_round(spark, monkeypatch, module):
    """Texts that share most of their words, but are not linked, share buckets that no round can close."""
    rng = random.Random(7)
    common = [f"w{i}" for i in range(120)]
    texts = [" ".join([*common, *(f"x{rng.random()}" for _ in range(22 + i % 9))]) for i in range(60)]
    texts += [" ".join([*common, *(f"y{i}" for i in range(200)), f"z{i % 3}"]) for i in range(9)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    calls = []
    compared = module.matching
    monkeypatch.setattr(module, "matching", lambda *given: calls.append(1) or compared(*given))
    find = near_dedup.near_duplicates if module is near_dedup else prefix_join.similar_documents
    got = {r["doc_id"]: r["component_id"] for r in find(df).collect()}
    assert got == {i: i if i < 60 else 60 for i in range(69)}
    assert len(calls) == 2  # by filters, then by full sets


@pytest.mark.parametrize("partners", [2, 256])
def test_a_left_record_meets_all_its_partners(spark, monkeypatch, partners):
    monkeypatch.setattr(pairs, "PARTNERS", partners)
    rows = [(a, b) for a in (1, 2, 3) for b in range(10, 10 + 7 * a)]
    frame = spark.createDataFrame(rows, "left long, right long").repartition(3)
    numbers = spark.range(40).selectExpr("id AS node", "CAST(CAST(id AS string) AS binary) AS value")
    found = pairs.matching(frame, numbers, int, lambda a, b: (a + b) % 3 == 0).collect()
    assert sorted(map(tuple, found)) == [p for p in rows if sum(p) % 3 == 0]


def test_a_large_bucket_gets_another_star_round(spark, monkeypatch):
    monkeypatch.setattr(pairs, "STAR_BLOCKS", 2)
    members = spark.range(1, 41).selectExpr("7L AS bucket", "id AS node")
    asked = []

    def linked(given):
        asked.append(sorted(map(tuple, given.collect())))
        return given.where("right <= 38 OR left > 38")

    left, components = pairs.star_rounds(members, linked, 3, 4)
    assert len(asked) == 3 and asked[0] == [(1, n) for n in range(2, 41)]
    assert {r["node"] for r in components.where("component = 1").collect()} == set(range(1, 39))
    assert left.where("component > 1").count() <= 2
    left, _ = pairs.star_rounds(members, linked, 3, 100)
    assert len(asked) == 4 and left.count() == 39


def long_tail(spark):
    """300 words of all frequencies among thousands that occur once or twice, with ties and odd characters."""
    rng = random.Random(11)
    texts = []
    for i in range(400):
        often = [f"é{int(300 * rng.random() ** 2)}x" for _ in range(40)]
        rare = [f"r{rng.randrange(20_000)}" for _ in range(40)]
        both = often + rare
        rng.shuffle(both)
        texts.append((" ".join(both) + f" same each {i % 3}",))
    return spark.createDataFrame([*texts, (None,), ("",), (" ",)], "text string").repartition(5)


@pytest.mark.parametrize("max_features", [1, 60, 250])
def test_a_fit_counts_few_of_the_terms(spark, monkeypatch, max_features):
    docs = long_tail(spark).cache()
    whole = term_statistics(docs)
    want = vocabulary_from_statistics(whole, max_features=max_features)
    limited, listed = vocabulary.limit_vocabulary, []
    monkeypatch.setattr(vocabulary, "limit_vocabulary", lambda *given: listed.append(given[0]) or limited(*given))
    assert fit(docs, max_features=max_features) == want and want.n_docs == 400
    assert listed[-1].count() < whole.count() / 20


@pytest.mark.parametrize("least", [1, 40, 10**6])
def test_a_fit_is_right_whatever_was_estimated(spark, monkeypatch, least):
    docs = long_tail(spark).cache()
    want = vocabulary_from_statistics(term_statistics(docs), max_features=200)
    monkeypatch.setattr(vocabulary, "_least_count", lambda *_: least)
    assert fit(docs, max_features=200) == want


def test_a_keyword_is_looked_for_before_its_boundaries(spark):
    rng = random.Random(3)
    parts = ["a", "b", "ab", "é", "漢", "𝔞", "_", "1", " ", "-", "\n", "+", "c++", "²", "\u0301", "😀", "\r\n", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2).cache()
    for needle in ("ab", "a", "+", "c++", "b.", "é", "𝔞", "😀", "𝔞a", "²", "_"):
        hit = keyword_hit(F.col("t"), needle)
        assert df.where(hit != F.col("t").rlike(whole_word_pattern(needle))).count() == 0
        assert df.where(hit).count() > 0
    plan = df.select(keyword_hit(F.col("t"), "ab"))._jdf.queryExecution().optimizedPlan().toString()
    assert ", ab(?<!" in plan


def test_an_embedder_looks_a_word_up_once_for_many_texts(monkeypatch):
    texts = [" ".join(f"w{(i * 7 + j) % 90}" for j in range(400)) for i in range(1500)]
    assert 2 << 20 < sum(map(len, texts)) < 4 << 20
    seen = []
    monkeypatch.setattr(embedding, "split_words", lambda part: seen.append(len(part)) or split_words(part))
    many = embedding.HashingEmbedder(16)()(texts)
    assert seen == [1500]
    assert many[::500] == [embedding.HashingEmbedder(16)()([t])[0] for t in texts[::500]]
