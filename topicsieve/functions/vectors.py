"""Similarity of stored embeddings to one query vector."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NEUTRAL = 0.5


def vector_score(embedding: Column, query: Sequence[float] | None) -> Column:
    """Cosine rescaled to 0..1; 0.5 where either side is missing or has no length."""
    if not query:
        return F.lit(NEUTRAL)
    # Summed left to right, the same order as the engine's own fold.
    query_norm = math.sqrt(sum(float(x) * float(x) for x in query))
    if query_norm == 0.0:
        return F.lit(NEUTRAL)
    weights = F.array(*[F.lit(float(x)) for x in query])
    pairs = F.zip_with(
        embedding.cast("array<double>"), weights, lambda e, q: F.struct(e.alias("e"), q.alias("q"))
    )

    def totals(dot: Column, squares: Column) -> Column:
        return F.struct(dot.alias("dot"), squares.alias("squares"))

    def rescaled(acc: Column) -> Column:
        cosine = acc["dot"] / (F.sqrt(acc["squares"]) * F.lit(query_norm))
        return F.when(acc["squares"] == 0.0, F.lit(NEUTRAL)).otherwise((cosine + F.lit(1.0)) / F.lit(2.0))

    # Dot product and squared length in one pass over the vector.
    score = F.aggregate(
        pairs,
        totals(F.lit(0.0), F.lit(0.0)),
        lambda acc, p: totals(acc["dot"] + p["e"] * p["q"], acc["squares"] + p["e"] * p["e"]),
        rescaled,
    )
    return F.when(embedding.isNull() | (F.size(embedding) == 0), F.lit(NEUTRAL)).otherwise(score)
