"""Keep the optimizer from evaluating an expensive expression several times.

Projections are merged, and filters pushed through them, by repeating the
expressions they refer to. Where those are folds, regular expressions or model
scores, one of these two forms is used instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def evaluated_once(df: DataFrame, *columns: str) -> DataFrame:
    """Fix computed columns so that everything above uses their values.

    Neither projections nor filters are moved through a generator.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns))))
