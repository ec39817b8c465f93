"""Score a corpus against a topic and re-score it when the topic changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicsieve.functions.keywords import keyword_score
from topicsieve.functions.once import evaluated_once
from topicsieve.functions.scoring import DEFAULT_YEAR, decide, hybrid_score, score_to_tier
from topicsieve.functions.text import non_empty
from topicsieve.functions.vectors import vector_score
from topicsieve.operators.embedding import Embedder, backfill_embeddings
from topicsieve.operators.similarity import with_tfidf_score
from topicsieve.operators.vocabulary import Vocabulary, fit
from topicsieve.topic import Topic

FEATURES = ("_keyword", "_tfidf", "_sbert")


def scoring_text(papers: DataFrame) -> Column:
    """The text a paper is scored by: its text, else its title."""
    return non_empty(F.col("text"), F.col("title"))


def with_text_features(
    papers: DataFrame, topic: Topic, vocabulary: Vocabulary, keep_inputs: bool = False
) -> DataFrame:
    """Add the keyword and TF-IDF features; row-local. Drops the text unless told not to."""
    staged = papers.withColumn("_text", scoring_text(papers)).withColumn("_lowered", F.lower("_text"))
    staged = staged.withColumn("_keyword", keyword_score(F.col("_lowered"), topic.axes))
    staged = with_tfidf_score(staged, topic.query_text, vocabulary, "_text", "_tfidf")
    return staged.drop("_text", "_lowered", *([] if keep_inputs else ["text"]))


def with_decision(featured: DataFrame, topic: Topic) -> DataFrame:
    """Mix the features and add score_breakdown, score_final, decision and tier."""
    mixed = evaluated_once(featured, *FEATURES).withColumn(
        "score_breakdown", hybrid_score(*[F.col(f) for f in FEATURES], topic.weights)
    ).withColumn(
        "_outcome",
        decide(
            F.col("score_breakdown.weighted"),
            F.coalesce("year", F.lit(DEFAULT_YEAR)),
            topic.year_range,
            topic.thresholds,
        ),
    )
    return (
        mixed.withColumn("score_final", F.col("_outcome.score_final"))
        .withColumn("decision", F.col("_outcome.decision"))
        .withColumn("tier", score_to_tier(F.col("score_final")))
        .drop("_outcome", *FEATURES)
    )


def score_papers(
    papers: DataFrame,
    topic: Topic,
    vocabulary: Vocabulary,
    embeddings: DataFrame | None = None,
    key: str = "paper_id",
    keep_inputs: bool = False,
) -> DataFrame:
    """Score papers with an already fitted vocabulary.

    Texts and vectors are inputs, not results: they are dropped unless
    ``keep_inputs`` is set (an ingest stores them along with the scores). With an ``embedding`` column in ``papers`` the whole job is one scan without
    a shuffle. With ``embeddings`` (key, embedding) kept as a table of its own,
    both sides are reduced to numbers before they meet, so neither texts nor
    vectors are shuffled.
    """
    featured = with_text_features(papers, topic, vocabulary, keep_inputs)
    if embeddings is None:
        scored = featured.withColumn("_sbert", vector_score(F.col("embedding"), topic.query_vector))
        return with_decision(scored if keep_inputs else scored.drop("embedding"), topic)
    similarity = embeddings.select(
        key, vector_score(F.col("embedding"), topic.query_vector).alias("_sbert")
    )
    joined = featured.join(similarity, key, "left")
    return with_decision(
        joined.withColumn("_sbert", F.coalesce("_sbert", vector_score(F.lit(None), None))), topic
    )


def fit_corpus(papers: DataFrame, **options) -> Vocabulary:
    """Fit the vocabulary on the scoring texts of a corpus."""
    return fit(papers.select(scoring_text(papers).alias("text")), **options)


def rescore(
    papers: DataFrame,
    topic: Topic,
    embeddings: DataFrame | None = None,
    key: str = "paper_id",
    keep_inputs: bool = False,
    embedder: Embedder | None = None,
    vocabulary: Vocabulary | None = None,
) -> DataFrame:
    """Refit on the whole corpus, then score all of it; other columns are kept.

    A ``vocabulary`` that was fitted on the same texts, as for another topic, is taken
    instead of fitting it again.

    With an ``embedder``, papers without a vector are embedded before they are
    scored; ``keep_inputs`` returns the new vectors with the others, so that the
    result can be stored as the next corpus. With ``embeddings`` in a table of their
    own this joins them to the texts; a corpus that stores both needs no shuffle.
    """
    vocabulary = vocabulary or fit_corpus(papers)
    if embedder is None:
        return score_papers(papers, topic, vocabulary, embeddings, key, keep_inputs)
    whole = papers if embeddings is None else papers.join(embeddings.select(key, "embedding"), key, "left")
    whole = whole.withColumn("_scoring_text", scoring_text(whole))
    filled = backfill_embeddings(whole, embedder, "_scoring_text").drop("_scoring_text")
    return score_papers(filled, topic, vocabulary, key=key, keep_inputs=keep_inputs)
