"""Frames derived from the provided tables; ``contract.sql`` states them in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.topics import load_topic
from topicsieve.functions.scoring import object_key, tier_key
from topicsieve.operators.embedding import HashingEmbedder
from topicsieve.operators.vocabulary import Vocabulary
from topicsieve.plans.rescore import fit_corpus, rescore
from topicsieve.session import scratch_path, spread
from topicsieve.topic import Topic


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def paper_id(number) -> F.Column:
    return F.concat(F.lit("PAPER_"), (number + 1).cast("string"))


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One paper per document: first line as title, text, year, source key."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select(
        "doc_id",
        paper_id(F.col("doc_id")).alias("paper_id"),
        F.substring(F.substring_index("text", "\n", 1), 1, 300).alias("title"),
        F.when(F.col("doc_id") % 8 != 0, F.col("text")).alias("abstract"),
        "text",
        (F.lit(2010) + F.col("doc_id") % 20).cast("int").alias("year"),
        F.when(F.col("doc_id") % 5 != 0, object_key(paper_id(F.col("doc_id")))).alias("minio_key"),
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        paper_id(F.col("vec_id")).alias("paper_id"), "embedding"
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers together with their embeddings, where there is one."""
    return papers(spark, sf_dir).join(embeddings(spark, sf_dir), "paper_id", "left")


def scored(spark: SparkSession, sf_dir: str, topic: Topic, vocabulary: Vocabulary | None = None) -> DataFrame:
    """All papers scored against ``topic``, computed from the tables."""
    return rescore(
        spread(papers(spark, sf_dir)), topic, embeddings(spark, sf_dir), embedder=HashingEmbedder(64),
        vocabulary=vocabulary,
    )


def with_placement(scores: DataFrame) -> DataFrame:
    """Give scored papers the tier key they were stored under, if any."""
    placed = F.col("minio_key").isNotNull() & (F.col("doc_id") % 7 != 0)
    return scores.withColumn(
        "tier_minio_key", F.when(placed, tier_key(F.col("paper_id"), F.col("tier")))
    )


_snapshots: dict[tuple, str] = {}


def written_once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """The path that ``write(path)`` filled, once per session and input version."""
    files = [f"{sf_dir}/documents.parquet", f"{sf_dir}/embeddings.parquet"]
    versions = spark.read.format("binaryFile").load(files).select("path", "modificationTime", "length")
    key = (spark.sparkContext.applicationId, name, *sorted(tuple(r) for r in versions.collect()))
    if key not in _snapshots:
        path = scratch_path(spark, name)
        write(path)
        _snapshots[key] = path
    return _snapshots[key]


def fitted(spark: SparkSession, sf_dir: str) -> Vocabulary:
    """The stored vocabulary of the papers, which is the same for all topics."""
    def write(path: str) -> None:
        fit_corpus(spread(papers(spark, sf_dir))).save(spark, path)

    return Vocabulary.load(spark, written_once(spark, sf_dir, "vocabulary", write))


def snapshot(spark: SparkSession, sf_dir: str, name: str = "a") -> DataFrame:
    """The stored papers table as the last rescore left it.

    Listing, ranking and summary queries read stored scores, so a rescore is
    written once per session and input version and then scanned like any table.
    """
    def write(path: str) -> None:
        rows = scored(spark, sf_dir, load_topic(spark, sf_dir, name), fitted(spark, sf_dir))
        with_placement(rows).write.parquet(path)

    return spark.read.parquet(written_once(spark, sf_dir, f"scores-{name}", write))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_page_texts(table(spark, sf_dir, "documents"))


def as_page_texts(docs: DataFrame) -> DataFrame:
    """Documents dressed up as the text of a paper's first pages."""
    number = F.col("doc_id")
    return docs.select(
        "doc_id",
        paper_id(number).alias("paper_id"),
        F.concat(
            F.lit("doi:10.1000/"), number.cast("string"),
            F.lit("\nReceived "), (1 + number % 28).cast("string"),
            F.lit(" May "), (1985 + number % 60).cast("string"),
            F.lit("\n"), F.col("text"),
            F.lit("\nAbstract: "), F.col("text"),
            F.lit("\n\nIntroduction\n"),
        ).alias("full_text"),
        F.when(
            number % 10 == 0, F.concat(F.lit("A Metadata Title For Document "), number.cast("string"))
        ).alias("meta_title"),
    )


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_job_log(table(spark, sf_dir, "events"))


def as_job_log(events: DataFrame) -> DataFrame:
    """Events read as the log of job updates."""
    kind = F.col("event_type")
    return events.select(
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id"),
        "ts",
        "event_id",
        kind.alias("stage"),
        F.when(kind == "view", "queued")
        .when(kind.isin("click", "signup"), "running")
        .when(kind == "purchase", "completed")
        .when(kind == "error", "failed")
        .alias("status"),
        F.lit(100).alias("total"),
        F.get_json_object("props", "$.k").cast("int").alias("processed"),
    )


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic row per document, with partial and missing settings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    number = F.col("doc_id")
    words = F.split("text", " ")

    def every(step: int, rest: int) -> F.Column:
        return F.filter(words, lambda word, i: (i + 1) % step == rest)

    def maybe(modulus: int, rest: int, value: float) -> F.Column:
        return F.when(number % modulus != rest, F.lit(value))

    return docs.select(
        "doc_id",
        F.concat(F.lit("topic "), F.col("lang")).alias("topic_name"),
        F.col("text").alias("query_text"),
        F.create_map(
            F.lit("first"), every(2, 1),
            F.col("lang"), every(3, 0),
            F.lit("last one"), every(2, 0),
        ).alias("axes"),
        F.create_map(
            F.lit("keyword"), maybe(3, 0, 0.5),
            F.lit("tfidf"), maybe(4, 0, 0.25),
            F.lit("sbert"), maybe(5, 0, 0.125),
        ).alias("weights"),
        F.create_map(
            F.lit("gold_muy"), maybe(3, 1, 0.75),
            F.lit("revisar"), maybe(4, 1, 0.25),
        ).alias("thresholds"),
        F.array(F.lit(2010), (F.lit(2020) + number % 5).cast("int")).alias("year_range"),
        "text",
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")
