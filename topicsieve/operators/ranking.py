"""Top-k queries: ranking, positions and the selection for a justify batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicsieve.operators.papers import with_min_score

MAX_TOP = 2000
BROADCAST_IDS = 100_000


def ranking_order() -> list:
    return [F.desc_nulls_last("score_breakdown.weighted"), F.asc("paper_id")]


def ranking_top_n(papers: DataFrame, top: int = 10) -> DataFrame:
    """Best papers by weighted score; papers outside the year range stay in.

    Sort and limit in one node become a per-partition top-k, so only ``top``
    rows per partition travel.
    """
    if not 1 <= top <= MAX_TOP:
        raise ValueError(f"top must be 1..{MAX_TOP}")
    return papers.orderBy(*ranking_order()).limit(top)


def ranking_position(papers: DataFrame, top: int = 10) -> DataFrame:
    """The ranking with 1-based positions, numbered after the limit."""
    return ranking_top_n(papers, top).withColumn(
        "position", F.row_number().over(Window.orderBy(*ranking_order()))
    )


def select_for_justify(
    papers: DataFrame,
    paper_ids: Sequence[str] | None = None,
    top: int | None = None,
    min_score: int | None = None,
) -> DataFrame:
    """Papers of a justify request: ids, else top, else min_score.

    An id list keeps its order (column ``request_pos``) and its repeats, unknown
    ids drop out. A minimum score selects every matching paper.
    """
    if paper_ids:
        spark = papers.sparkSession
        wanted = spark.createDataFrame(list(enumerate(paper_ids)), "request_pos int, paper_id string")
        # A list of unknown size would be planned as a shuffle of the whole table.
        return papers.join(F.broadcast(wanted) if len(paper_ids) <= BROADCAST_IDS else wanted, "paper_id")
    if top is not None:
        return ranking_position(papers, top).withColumn("request_pos", F.col("position") - 1).drop("position")
    if min_score is not None:
        return with_min_score(papers, min_score).withColumn("request_pos", F.lit(None).cast("int"))
    raise ValueError("give paper_ids, top or min_score")
