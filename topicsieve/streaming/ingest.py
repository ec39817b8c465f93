"""Continuous ingest of new files: extract, score, append, refit, log."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicsieve.operators.embedding import Embedder
from topicsieve.operators.generation import Generator, describe, justify_once, with_justifications
from topicsieve.operators.identifiers import FIRST_NUMBER, assign_ids, max_id_suffix
from topicsieve.operators.vocabulary import (
    Vocabulary,
    merge_statistics,
    term_statistics,
    vocabulary_from_statistics,
)
from topicsieve.plans.ingest import embedded, extracted, scored_rows, split_ingested
from topicsieve.plans.rescore import scoring_text
from topicsieve.sources.files import BINARY_SCHEMA, SUFFIX_GLOB, PageExtractor, split_upload, text_pages
from topicsieve.streaming.store import Levels, Store
from topicsieve.topic import Topic

ROWS, LOG, ANSWERS = "ingested", "job_log", "answers"
ASSIGNED, EXTRACTED, EMBEDDED, COUNTER = "assigned", "extracted", "embedded", "counter"
STATISTICS, VOCABULARY = "statistics", "vocabulary"

# Stages of an ingest job, in order, and the one of a justification.
RUNNING_STAGES = ("extracting_metadata", "embedding_sbert", "scoring")
JUSTIFY_STAGE = "ollama_justify"


def file_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of a folder, ``files_per_batch`` at a time."""
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .option("pathGlobFilter", SUFFIX_GLOB)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(files_per_batch))
        .load(folder)
    )


def current_vocabulary(spark: SparkSession, store: Store, batch: int | None = None) -> Vocabulary:
    """The vocabulary fitted by the last batch (before ``batch``, if given)."""
    known = store.batches(spark, VOCABULARY)
    known = [b for b in known if batch is None or b < batch]
    return Vocabulary.load(spark, store.path(VOCABULARY, known[-1])) if known else Vocabulary(0)


def read_papers(spark: SparkSession, store: Store) -> DataFrame:
    """All papers ingested so far, with their justifications."""
    papers, _ = split_ingested(store.read(spark, ROWS).drop("batch"))
    if not store.batches(spark, ANSWERS):
        return papers
    return with_justifications(papers, store.read(spark, ANSWERS).drop("batch"))


def updates(
    jobs: DataFrame, event: int, status: str, stage: str | None, error: Column | None = None
) -> DataFrame:
    """One update of the job of each new paper (paper_id, path), with the time it is written."""
    return jobs.select(
        F.concat(F.lit("ingest-"), "paper_id").alias("job_id"),
        F.lit("ingest").alias("type"),
        "paper_id",
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.current_timestamp().alias("ts"),
        F.lit(event).cast("long").alias("event_id"),
        F.lit(status).alias("status"),
        F.lit(stage).alias("stage"),
        (F.lit(None) if error is None else error).cast("string").alias("error"),
    )


def read_log(spark: SparkSession, store: Store) -> DataFrame:
    """The updates of all ingest jobs, from every stage that was written."""
    parts = [f"{LOG}/{place}" for place in LOG_PLACES]
    logs = [store.read(spark, part).drop("batch") for part in parts if store.batches(spark, part)]
    return reduce(DataFrame.unionByName, logs)


# Where the updates of each stage go, and of batches that died.
LOG_PLACES = ("queued", *RUNNING_STAGES, JUSTIFY_STAGE, "ended", "died")


def ingest_batch(
    files: DataFrame,
    batch: int,
    store: Store,
    topic: Topic,
    embedder: Embedder | None = None,
    extractor: PageExtractor = text_pages,
    refit_every: int = 1,
    justify: str = "none",
    generator: Generator | None = None,
    objects: str | None = None,
) -> None:
    """One micro-batch: number, extract, embed, score with the last vocabulary, refit.

    Each stage is stored, and its updates are appended to the job log before it runs. A
    batch that dies leaves the updates it came to, and a failed one for each of its jobs;
    when Spark repeats it, stored stages are read and not done again, and the failed
    updates are taken back. ``justify`` is none, lazy or auto; auto asks the
    ``generator`` once for each new paper. A large corpus with a steady stream may refit
    every so many batches only.
    """
    spark = files.sparkSession
    if justify not in ("none", "lazy", "auto"):
        raise ValueError("justify must be none, lazy or auto")

    def stage(table: str, make: Callable[[], DataFrame]) -> DataFrame:
        if batch in store.batches(spark, table):
            return spark.read.parquet(store.path(table, batch))
        return store.write(make(), table, batch)

    def log(place: str, make: Callable[[], DataFrame]) -> None:
        stage(f"{LOG}/{place}", make)

    ids = stage(ASSIGNED, lambda: _numbered(spark, files, store, batch))
    try:
        log("queued", lambda: updates(ids, 0, "queued", "queued"))
        log(RUNNING_STAGES[0], lambda: updates(ids, 1, "running", RUNNING_STAGES[0]))
        texts = stage(EXTRACTED, lambda: extracted(files, extractor))
        log(RUNNING_STAGES[1], lambda: updates(ids, 2, "running", RUNNING_STAGES[1]))
        vectors = stage(EMBEDDED, lambda: embedded(texts, embedder))
        # a failed embedding never reaches the scoring stage
        well = ids.join(vectors.where("ingest_error IS NULL").select("path"), "path", "left_semi")
        log(RUNNING_STAGES[2], lambda: updates(well, 3, "running", RUNNING_STAGES[2]))
        vocabulary = current_vocabulary(spark, store, batch)
        rows = stage(ROWS, lambda: scored_rows(vectors, ids, topic, vocabulary, objects))
        papers, failed = split_ingested(rows)
        if justify == "auto":
            log(JUSTIFY_STAGE, lambda: updates(_jobs(papers), 4, "running", JUSTIFY_STAGE))
            stage(
                ANSWERS,
                lambda: justify_once(papers, topic.topic_name, generator, store.path("asked")),
            )
        texts_of = papers.select(scoring_text(papers).alias("text"))
        Levels(store, STATISTICS).write(
            term_statistics(texts_of), batch, lambda parts: merge_statistics(*parts)
        )
        if (batch + 1) % refit_every == 0:
            refit(spark, store, batch)
        done = 5 if justify == "auto" else 4
        broken = updates(_jobs(failed), 3, "failed", RUNNING_STAGES[1], F.col("ingest_error"))
        ended = updates(_jobs(papers), done, "completed", "completed").unionByName(broken)
        log("ended", lambda: ended)
    except Exception as failure:
        died = updates(ids, 9, "failed", None, F.lit(describe(failure)))
        store.write(died, f"{LOG}/died", batch)
        raise
    if batch in store.batches(spark, f"{LOG}/died"):
        store.write(spark.read.parquet(store.path(f"{LOG}/died", batch)).limit(0), f"{LOG}/died", batch)


def _jobs(rows: DataFrame) -> DataFrame:
    return rows.withColumn("path", F.col("source_path"))


def _numbered(spark: SparkSession, files: DataFrame, store: Store, batch: int) -> DataFrame:
    """Path and id of each valid file of a batch; the last number in use is kept for the next one."""
    last = store.latest_before(spark, COUNTER, batch)
    number = spark.read.parquet(store.path(COUNTER, last)).first()["seq"] if last is not None else FIRST_NUMBER
    valid, _ = split_upload(files)
    ids = assign_ids(valid.select("path"), "path", number)
    counter = max_id_suffix(ids).select(F.greatest("max_n", F.lit(number)).alias("seq"))
    store.write(counter, COUNTER, batch)
    return ids


def refit(spark: SparkSession, store: Store, batch: int) -> None:
    """Fit on everything ingested up to ``batch``.

    Adds up the runs of term statistics, which equals a fit on all papers without reading
    any text again; only the vocabulary is written.
    """
    totals = merge_statistics(*Levels(store, STATISTICS).read_before(spark, batch + 1))
    vocabulary_from_statistics(totals, is_stored=True).save(spark, store.path(VOCABULARY, batch))


def stream_ingest(
    files: DataFrame,
    store: Store,
    topic: Topic,
    checkpoint: str,
    embedder: Embedder | None = None,
    extractor: PageExtractor = text_pages,
    refit_every: int = 1,
    justify: str = "none",
    generator: Generator | None = None,
    objects: str | None = None,
) -> StreamingQuery:
    """Start ingesting a file stream into a store."""
    return (
        files.writeStream.foreachBatch(
            lambda rows, batch: ingest_batch(
                rows, batch, store, topic, embedder, extractor, refit_every, justify, generator, objects
            )
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
