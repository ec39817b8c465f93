"""Counts and shares over scored papers, corpus health and run estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicsieve.functions.scoring import DECISIONS, TIERS, score_to_tier
from topicsieve.functions.text import round_half_up
from topicsieve.operators.vocabulary import Vocabulary

# Seconds per paper and severity limits of a run estimate.
SCORE_SECONDS, MIN_SCORE_SECONDS = 0.01, 2.0
REEXTRACT_SECONDS = 0.3
JUSTIFY_SECONDS = 15.0
WARN_SECONDS, DANGER_SECONDS = 600.0, 3600.0


def in_flight(status: Column) -> Column:
    """Every status but completed, failures and missing values included."""
    return ~status.eqNullSafe(F.lit("completed"))


def corpus_health(papers: DataFrame, jobs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row: papers, jobs in flight, and whether the stored vocabulary is fitted.

    The paper count needs no column at all.
    """
    flying = jobs.agg(F.count_if(in_flight(F.col("status"))))
    return papers.agg(F.count("*").alias("papers")).select(
        "papers", F.lit(vocabulary.is_fitted).alias("tfidf_fitted"), flying.scalar().alias("jobs_in_flight")
    )


def tier_counts(papers: DataFrame) -> DataFrame:
    """One wide row: papers per tier and in total, over the whole corpus."""
    tier = score_to_tier(F.col("score_final"))
    return papers.agg(*[F.count_if(tier == t).alias(t) for t in TIERS], F.count("*").alias("total"))


def tier_share(papers: DataFrame) -> DataFrame:
    """Rows of (tier, n, total, percent), empty tiers included."""
    wide = tier_counts(papers)
    share = F.when(F.col("total") > 0, round_half_up(F.col("n") / F.col("total") * 100.0, 1))
    return wide.unpivot("total", list(TIERS), "tier", "n").withColumn("percent", F.coalesce(share, F.lit(0.0)))


def score_histogram(papers: DataFrame) -> DataFrame:
    """Rows of (score_final, n, total, percent); empty scores do not appear."""
    counts = [F.count_if(F.col("score_final") == score).alias(str(score)) for score in DECISIONS]
    total = F.count_if(F.col("score_final").isin(*DECISIONS)).alias("total")
    tall = papers.agg(total, *counts).unpivot("total", [str(s) for s in DECISIONS], "score_final", "n")
    return tall.where(F.col("n") > 0).select(
        F.col("score_final").cast("int").alias("score_final"),
        "n",
        "total",
        round_half_up(F.col("n") / F.col("total") * 100.0, 2).alias("percent"),
    )


def run_cost_estimate(papers: DataFrame) -> DataFrame:
    """Estimated seconds of a rescore for every combination of its options."""
    totals = papers.agg(
        F.count("*").alias("papers"), F.count_if(F.col("score_final") >= 4).alias("gold")
    )
    modes = F.explode(F.array(F.lit("none"), F.lit("gold_only"), F.lit("all")))
    options = totals.withColumn("justify", modes).withColumn(
        "reextract", F.explode(F.array(F.lit(False), F.lit(True)))
    )
    scoring = F.greatest(F.lit(MIN_SCORE_SECONDS), F.col("papers") * SCORE_SECONDS)
    reading = F.when(F.col("reextract"), F.col("papers") * REEXTRACT_SECONDS).otherwise(0.0)
    writing = (
        F.when(F.col("justify") == "gold_only", F.col("gold") * JUSTIFY_SECONDS)
        .when(F.col("justify") == "all", F.col("papers") * JUSTIFY_SECONDS)
        .otherwise(0.0)
    )
    seconds = round_half_up(scoring + reading + writing, 2)
    return options.withColumn("seconds", seconds).withColumn(
        "severity",
        F.when(F.col("seconds") > DANGER_SECONDS, "danger")
        .when(F.col("seconds") > WARN_SECONDS, "warn")
        .otherwise("info"),
    )
