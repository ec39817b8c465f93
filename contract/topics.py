"""The two topics used on the provided tables (their words are invented)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from topicsieve.topic import Topic

# Several axes, lowered gold thresholds.
TOPIC_A = dict(
    topic_name="topic A",
    query_text="This ai tion ther thble rewh orre erin thor thin that",
    axes={
        "alpha": ["ai", "that in"],
        "beta": ["this", "with"],
        "gamma": ["ther", "thble", "thon"],
        "delta": ["erin", "thre"],
    },
    weights={"keyword": 0.4, "tfidf": 0.3, "sbert": 0.3},
    year_range=(2016, 2026),
    thresholds={"gold_muy": 0.50, "gold_claro": 0.42},
)
# One axis with a blank keyword, one weight, no thresholds.
TOPIC_B = dict(
    topic_name="topic B",
    query_text="der die und erver heit keit",
    axes={"keywords": ["ai", "tion", "ther", "that in", "this", ""]},
    weights={"keyword": 0.5},
    year_range=(2012, 2029),
    thresholds=None,
)
TOPICS = {"a": TOPIC_A, "b": TOPIC_B}
QUERY_VECTOR_ID = {"a": 0, "b": 1}


def load_topic(spark: SparkSession, sf_dir: str, name: str) -> Topic:
    row = (
        spark.read.parquet(f"{sf_dir}/embeddings.parquet")
        .where(F.col("vec_id") == QUERY_VECTOR_ID[name])
        .select("embedding")
        .first()
    )
    return Topic(**TOPICS[name], query_vector=tuple(row["embedding"]) if row else None)
