"""Physical plans that have to stay as they are for large data."""

import pytest
from pyspark.sql import functions as F

from topicsieve.operators import joblog, papers, ranking, similarity, vocabulary
from topicsieve.operators.merge import update_by_key


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "papers")
    rows = spark.range(200).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("paper_id"),
        F.concat(F.lit("words number "), F.col("id").cast("string")).alias("text"),
        F.lit("t").alias("title"),
        F.lit(2020).alias("year"),
        (F.col("id") % 6).cast("int").alias("score_final"),
        F.lit("d").alias("decision"),
        F.struct((F.col("id") / 200).alias("weighted")).alias("score_breakdown"),
        F.array(F.lit(1.0)).alias("embedding"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_statistics_shuffle_once_by_term_after_partial_aggregation(stored):
    text = plan(vocabulary.term_statistics(stored))
    assert text.count("Exchange") == 1 and "partial_sum" in text
    assert "ReadSchema: struct<text:string>" in text


def test_term_frequency_and_scores_do_not_shuffle(stored):
    assert "Exchange" not in plan(vocabulary.term_frequency(stored, "paper_id"))
    fitted = vocabulary.fit(stored)
    assert "Exchange" not in plan(similarity.with_tfidf_score(stored, "words number 7", fitted))


def test_vectors_do_not_shuffle(stored):
    text = plan(similarity.tfidf_vectors(stored, vocabulary.fit(stored), "paper_id"))
    assert text.replace("BroadcastExchange", "").count("Exchange") == 0


def test_listings_prune_push_down_and_take_ordered(stored):
    listing = plan(papers.paper_summary(papers.list_by_min_score(stored, 3, 5)))
    assert "TakeOrderedAndProject" in listing
    assert "GreaterThanOrEqual(score_final,3)" in listing
    assert "embedding" not in listing and "text:" not in listing
    ranked = plan(ranking.ranking_position(stored, 5).select("paper_id", "position"))
    assert ranked.index("Window") < ranked.index("TakeOrderedAndProject")


def test_point_lookup_reaches_the_scan(stored):
    assert "EqualTo(paper_id,P7)" in plan(papers.paper_detail(stored, "P7"))


def test_latest_state_aggregates_before_the_shuffle(spark):
    log = spark.createDataFrame(
        [("j", 1, 1, "s", "queued")], "job_id string, ts long, event_id long, stage string, status string"
    )
    text = plan(joblog.job_latest_state(log))
    assert text.count("Exchange") == 1 and "partial_max_by" in text


def test_updates_are_reduced_before_the_join(spark, stored):
    updates = spark.createDataFrame([("P1", "x", 1)], "paper_id string, title string, at int")
    assert "partial_max_by" in plan(update_by_key(stored, updates, ["title"], order=["at"]))
