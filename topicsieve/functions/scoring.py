"""Hybrid score, decision ladder and tiers as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicsieve.functions.text import round_half_up

# Weights, threshold ladder, decision labels and tiers.
DEFAULT_WEIGHTS = {"keyword": 0.4, "tfidf": 0.3, "sbert": 0.3}
DEFAULT_THRESHOLDS = {"gold_muy": 0.65, "gold_claro": 0.50, "revisar": 0.35, "no_prioritario": 0.20}
DECISIONS = {
    5: "Gold — muy relacionado",
    4: "Gold — claramente relacionado",
    3: "Revisar (parcial)",
    2: "No prioritario",
    1: "Excluido",
    0: "Fuera del rango temporal",
}
TIERS = ("gold", "silver", "bronze", "out_of_range")
SIGNALS = ("keyword", "tfidf", "sbert", "weighted")
DEFAULT_YEAR = 2024


def hybrid_score(keyword: Column, tfidf: Column, sbert: Column, weights: Mapping[str, float]) -> Column:
    """Weighted mix of the un-rounded parts; all four values kept at 4 places."""
    w = {name: float(weights.get(name, default)) for name, default in DEFAULT_WEIGHTS.items()}
    weighted = keyword * F.lit(w["keyword"]) + tfidf * F.lit(w["tfidf"]) + sbert * F.lit(w["sbert"])
    parts = zip(SIGNALS, (keyword, tfidf, sbert, weighted))
    return F.struct(*[round_half_up(value, 4).alias(name) for name, value in parts])


def effective_thresholds(thresholds: Column) -> Column:
    """Defaults overlaid by the entries of a threshold map column, as a struct."""
    return F.struct(
        *[F.coalesce(thresholds[name], F.lit(default)).alias(name) for name, default in DEFAULT_THRESHOLDS.items()]
    )


def decide(
    weighted: Column,
    year: Column,
    year_range: Sequence[int],
    thresholds: Mapping[str, float] | None = None,
) -> Column:
    """Year gate, then the ladder: struct(score_final, decision)."""
    cut = {**DEFAULT_THRESHOLDS, **(thresholds or {})}
    low, high = year_range

    def outcome(score: int) -> Column:
        return F.struct(F.lit(score).alias("score_final"), F.lit(DECISIONS[score]).alias("decision"))

    year = F.coalesce(year, F.lit(DEFAULT_YEAR))
    ladder = F.when((year < low) | (year > high), outcome(0))
    for score, name in zip((5, 4, 3, 2), DEFAULT_THRESHOLDS):
        ladder = ladder.when(weighted >= F.lit(float(cut[name])), outcome(score))
    return ladder.when(weighted.isNotNull(), outcome(1))


def score_to_tier(score: Column) -> Column:
    return (
        F.when(score == 0, "out_of_range")
        .when(score >= 4, "gold")
        .when(score == 3, "silver")
        .otherwise("bronze")
    )


def decision_to_tier(decision: Column) -> Column:
    label = F.lower(decision)
    return (
        F.when(label.startswith("gold"), "gold")
        .when(label.contains("revisar"), "silver")
        .when(label.contains("fuera"), "out_of_range")
        .otherwise("bronze")
    )


def object_key(paper_id: Column, prefix: str = "uploads") -> Column:
    """Where the source file of a paper lives."""
    return F.concat(F.lit(f"{prefix}/"), paper_id, F.lit(".pdf"))


def tier_key(paper_id: Column, tier: Column, root: str = "tiers") -> Column:
    """Where the copy of a paper lives for its tier."""
    return F.concat(F.lit(f"{root}/"), tier, F.lit("/"), paper_id, F.lit(".pdf"))
