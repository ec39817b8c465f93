"""Score mixing, decisions, tiers, listings and summaries."""

import pytest
from pyspark.sql import functions as F

from topicsieve.functions import scoring
from topicsieve.operators import papers, ranking, summary
from topicsieve.operators.topics import remove_axis, rename_axis, weight_sum
from topicsieve.plans.rescore import fit_corpus, rescore, score_papers
from topicsieve.operators.vocabulary import Vocabulary
from topicsieve.topic import Topic

BREAKDOWN = "struct<keyword:double,tfidf:double,sbert:double,weighted:double>"


def scored(spark, *rows):
    """(paper_id, title, year, weighted, score_final)"""
    full = [(i, t, y, (0.5, 0.5, 0.5, w), s, "x") for i, t, y, w, s in rows]
    return spark.createDataFrame(
        full,
        f"paper_id string, title string, year int, score_breakdown {BREAKDOWN}, score_final int, decision string",
    )


def ids(df):
    return [r["paper_id"] for r in df.collect()]


@pytest.mark.parametrize(
    "weighted, year, thresholds, expected",
    [
        (0.9, 2015, None, 0),
        (0.9, 2027, None, 0),
        (0.9, 2016, None, 5),
        (0.9, 2026, None, 5),
        (0.65, 2020, None, 5),
        (0.6499, 2020, None, 4),
        (0.5, 2020, None, 4),
        (0.35, 2020, None, 3),
        (0.2, 2020, None, 2),
        (0.1999, 2020, None, 1),
        (0.45, 2020, {"gold_claro": 0.45}, 4),
        (0.60, 2020, {"gold_claro": 0.45}, 4),
        (0.9, None, None, 5),
    ],
)
def test_decide(spark, weighted, year, thresholds, expected):
    df = spark.createDataFrame([(weighted, year)], "w double, y int")
    out = df.select(scoring.decide(F.col("w"), F.col("y"), (2016, 2026), thresholds).alias("o")).first()["o"]
    assert out["score_final"] == expected
    assert out["decision"] == scoring.DECISIONS[expected]


def test_weights_default_per_key_and_parts_stay_unrounded(spark):
    df = spark.createDataFrame([(0.33336, 0.5, 0.25)], "k double, t double, s double")
    mix = scoring.hybrid_score(F.col("k"), F.col("t"), F.col("s"), {"keyword": 1.0})
    out = df.select(mix.alias("m")).first()["m"]
    assert out["keyword"] == 0.3334
    assert out["weighted"] == pytest.approx(0.5584)  # 0.33336 + 0.15 + 0.075


def test_tiers(spark):
    df = spark.createDataFrame([(i,) for i in range(6)], "s int")
    tiers = [r[0] for r in df.select(scoring.score_to_tier(F.col("s"))).collect()]
    assert tiers == ["out_of_range", "bronze", "bronze", "silver", "gold", "gold"]
    labels = spark.createDataFrame([(scoring.DECISIONS[i],) for i in range(6)], "d string")
    assert [r[0] for r in labels.select(scoring.decision_to_tier(F.col("d"))).collect()] == tiers


def test_ranking_keeps_out_of_range_and_breaks_ties(spark):
    df = scored(
        spark, ("P2", "a", 2020, 0.5, 4), ("P1", "b", 1990, 0.5, 0), ("P3", "c", 2020, None, 1), ("P4", "d", 2020, 0.9, 5)
    )
    assert ids(ranking.ranking_top_n(df, 10)) == ["P4", "P1", "P2", "P3"]
    positions = {r["paper_id"]: r["position"] for r in ranking.ranking_position(df, 2).collect()}
    assert positions == {"P4": 1, "P1": 2}
    with pytest.raises(ValueError):
        ranking.ranking_top_n(df, 0)


def test_listing_search_and_filter(spark):
    df = scored(
        spark, ("PAPER_1", "Zero Trust", 2020, 0.5, 4), ("PAPER_2", "other", 2020, 0.4, 4), ("PAPER_12", "third", 2020, 0.1, 1)
    )
    assert ids(papers.list_by_min_score(df, 2, 1)) == ["PAPER_1"]
    assert ids(papers.search_papers(df, " TRUST ")) == ["PAPER_1"]
    assert sorted(ids(papers.search_papers(df, "paper_1"))) == ["PAPER_1", "PAPER_12"]
    assert len(ids(papers.search_papers(df, "  "))) == 3
    assert ids(papers.filter_by_tier(df, "bronze")) == ["PAPER_12"]
    with pytest.raises(ValueError):
        papers.filter_by_tier(df, "platinum")


def test_selection_precedence(spark):
    df = scored(spark, ("A", "a", 2020, 0.9, 5), ("B", "b", 2020, 0.5, 4), ("C", "c", 2020, 0.1, 1))
    chosen = ranking.select_for_justify(df, paper_ids=["C", "X", "A", "C"], top=1)
    assert [r["paper_id"] for r in chosen.orderBy("request_pos").collect()] == ["C", "A", "C"]
    assert ids(ranking.select_for_justify(df, paper_ids=[], top=1, min_score=0)) == ["A"]
    assert sorted(ids(ranking.select_for_justify(df, min_score=4))) == ["A", "B"]
    with pytest.raises(ValueError):
        ranking.select_for_justify(df)


def test_quality_check_flags_without_changing(spark):
    df = scored(spark, ("A", "a", 2020, 1.2, 5), ("B", None, 2020, 0.5, 9), ("C", "c", None, None, 1))
    found = {r["rule"]: r["n_violations"] for r in papers.quality_check(df, papers.paper_rules()).collect()}
    assert found["weighted_range"] == 2 and found["score_final_range"] == 1
    assert found["title_missing"] == 1 and found["year_missing"] == 1 and found["keyword_range"] == 0
    rows = {r["paper_id"]: r["violations"] for r in papers.with_violations(df, papers.paper_rules()).collect()}
    assert rows["A"] == ["weighted_range"]


def test_empty_corpus_summaries(spark):
    empty = scored(spark).limit(0)
    assert {r["percent"] for r in summary.tier_share(empty).collect()} == {0.0}
    assert summary.score_histogram(empty).count() == 0
    estimate = {(r["justify"], r["reextract"]): r["seconds"] for r in summary.run_cost_estimate(empty).collect()}
    assert estimate[("none", False)] == 2.0


def test_jobs_in_flight_count_failures_and_nulls(spark):
    jobs = spark.createDataFrame([("completed",), ("failed",), (None,), ("running",)], "status string")
    texts = spark.createDataFrame([("a",), (" ",)], "text string")
    row = summary.corpus_health(texts, jobs, Vocabulary(2)).first()
    assert (row["papers"], row["tfidf_fitted"], row["jobs_in_flight"]) == (2, False, 3)


def test_axis_edits(spark):
    axes = F.create_map(F.lit("one"), F.array(F.lit("a")), F.lit("two"), F.array(F.lit("b")))
    df = spark.range(1).select(axes.alias("axes"))

    def rename(new):
        renamed = rename_axis(F.col("axes"), F.lit("one"), F.lit(new))
        return [(e["key"], e["value"]) for e in df.select(F.map_entries(renamed)).first()[0]]

    assert rename("  New  Name ") == [("new_name", ["a"]), ("two", ["b"])]
    assert rename("two") == [("two", ["b"])]
    assert rename("  ") == [("one", ["a"]), ("two", ["b"])]
    only = df.select(remove_axis(remove_axis(F.col("axes"), F.lit("one")), F.lit("two"))).first()[0]
    assert only == {"keywords": []}


def test_weight_sum(spark):
    df = spark.createDataFrame([({"keyword": 0.5, "other": 9.0, "sbert": None},)], "w map<string,double>")
    assert df.select(weight_sum(F.col("w"))).first()[0] == 0.5


TOPIC = Topic("t", "red apples", {"a": ["red"], "b": ["green"]}, (2000, 2030), query_vector=(1.0, 0.0))
OTHER = Topic("u", "green pears", {"a": ["pears"]}, (2000, 2030), query_vector=(0.0, 1.0))


def small_corpus(spark):
    rows = [
        ("P1", "t1", "red apples and pears", 2020, [1.0, 0.0]),
        ("P2", "t2", "green pears", 2020, None),
        ("P3", "red title", "", None, [0.0, 1.0]),
        ("P4", "t4", "red green blue", 1990, [0.0, 0.0]),
    ]
    return spark.createDataFrame(
        rows, "paper_id string, title string, text string, year int, embedding array<float>"
    )


def as_dict(df):
    return {r["paper_id"]: r.asDict(recursive=True) for r in df.collect()}


def test_rescore_by_hand(spark):
    rows = as_dict(rescore(small_corpus(spark), TOPIC))
    assert rows["P1"]["score_breakdown"]["keyword"] == 0.5
    assert rows["P1"]["score_breakdown"]["sbert"] == 1.0
    assert rows["P2"]["score_breakdown"]["sbert"] == 0.5
    assert rows["P3"]["score_breakdown"]["keyword"] == 0.5  # scored by its title
    assert rows["P4"]["score_final"] == 0 and rows["P4"]["tier"] == "out_of_range"
    assert rows["P3"]["score_final"] > 0  # a missing year counts as the default one


def test_rescore_is_repeatable_and_keeps_rows(spark):
    corpus = small_corpus(spark)
    first, second = as_dict(rescore(corpus, TOPIC)), as_dict(rescore(corpus, TOPIC))
    assert first == second
    assert set(as_dict(rescore(corpus, OTHER))) == set(first)


def test_separate_embeddings_give_the_same_scores(spark):
    corpus = small_corpus(spark)
    split = rescore(corpus.drop("embedding"), TOPIC, corpus.select("paper_id", "embedding"))
    together = rescore(corpus, TOPIC)
    pick = lambda df: {k: v["score_breakdown"] for k, v in as_dict(df).items()}
    assert pick(split) == pick(together)


def test_scoring_new_papers_uses_the_old_vocabulary(spark):
    corpus = small_corpus(spark)
    old = fit_corpus(corpus.where("paper_id in ('P1', 'P2')"))
    new = corpus.where("paper_id = 'P4'")
    before = as_dict(score_papers(new, TOPIC, old))["P4"]["score_breakdown"]["tfidf"]
    after = as_dict(rescore(corpus, TOPIC))["P4"]["score_breakdown"]["tfidf"]
    assert before != after


def test_a_filter_on_the_decision_does_not_repeat_the_features(spark):
    gold = rescore(small_corpus(spark), TOPIC).where(F.col("score_final") >= 4).select("paper_id")
    plan = gold._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_rescore_of_one_table_needs_no_shuffle(spark, tmp_path):
    small_corpus(spark).write.parquet(f"{tmp_path}/papers")
    stored = spark.read.parquet(f"{tmp_path}/papers")
    scores = score_papers(stored, TOPIC, fit_corpus(stored))
    assert "Exchange" not in scores._jdf.queryExecution().executedPlan().toString()


def test_topic_round_trip_and_patch(spark):
    assert Topic.from_frame(TOPIC.frame(spark)) == TOPIC
    patched = TOPIC.patched(embed=lambda text: [0.5, 0.5], query_text="new", thresholds=None)
    assert patched.query_text == "new" and patched.query_vector == (0.5, 0.5)
    assert patched.axes == TOPIC.axes and patched.updated_at is not None
    with pytest.raises(ValueError):
        TOPIC.patched(topic_name=None)
    with pytest.raises(ValueError):
        Topic("t", "q", {}, (2000, 2010, 2020))
