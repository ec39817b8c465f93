"""Job progress, final notices and heartbeats as streams over the job log.

Updates may come out of order by up to ``LATENESS`` of event time. They wait in a buffer
until the watermark (the latest time seen, less the lateness) has passed them, and are
then told in the order of (ts, event_id), as the batch operators tell them.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicsieve.operators.joblog import (
    beats_between,
    carry_state,
    flights,
    in_ranges,
    job_changes,
    last_flights,
    merge_states,
    window_states,
)
from topicsieve.streaming.store import Levels, Store

LATENESS = "1 day"
# How long a closed job is remembered after its last update.
REMEMBERED = "30 days"
NOTICES, STATE, BUFFER, FINAL, CLOCK = "notices", "state", "buffer", "final", "clock"
BEATS, FLIGHTS, COUNTS = "beats", "flights", "flight_counts"


def _states(spark: SparkSession, store: Store, batch: int) -> DataFrame | None:
    parts = Levels(store, STATE).read_before(spark, batch)
    return merge_states(reduce(DataFrame.unionByName, parts)) if parts else None


def _clock(spark: SparkSession, store: Store, batch: int) -> datetime | None:
    """The watermark that the batch before left."""
    known = store.latest_before(spark, CLOCK, batch)
    return spark.read.parquet(store.path(CLOCK, known)).first()["watermark"] if known is not None else None


def notify_batch(
    log: DataFrame, batch: int, store: Store, lateness: str = LATENESS, remembered: str = REMEMBERED
) -> None:
    """Notices of what one micro-batch makes final.

    Updates older than the watermark are too late and dropped; of updates with equal job,
    time and number one counts. A batch writes the states of the jobs it has notices
    of; closed jobs are forgotten some time after their last update, when states are
    merged: an update that comes after that begins a new job.

    The work is the batch operator itself, so a busy job is split over many
    slices here too instead of being one group of a keyed stateful operator.
    """
    spark = log.sparkSession
    before = _clock(spark, store, batch)
    known = store.latest_before(spark, BUFFER, batch)
    waiting = [spark.read.parquet(store.path(BUFFER, known))] if known is not None else []
    fresh = log if before is None else log.where(F.col("ts") >= F.lit(before))
    pending = reduce(DataFrame.unionByName, waiting, fresh).dropDuplicates(["job_id", "ts", "event_id"])
    pending = store.write(pending, "pending", batch)
    newest = F.max("ts") - F.expr(f"INTERVAL {lateness}")
    now = store.write(
        pending.agg(F.greatest(newest, F.lit(before).cast("timestamp")).alias("watermark")), CLOCK, batch
    ).first()["watermark"]
    is_final = F.coalesce(F.col("ts") < F.lit(now).cast("timestamp"), F.lit(False))
    store.write(pending.where(~is_final), BUFFER, batch)
    final = store.write(in_ranges(pending.where(is_final)), FINAL, batch)
    carried = _states(spark, store, batch)
    store.write(job_changes(final, carried), NOTICES, batch)

    horizon = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {remembered}")
    gone = F.coalesce(F.col("closed") & (F.col("last_ts") < horizon), F.lit(False))
    Levels(store, STATE).write(
        carry_state(final.drop("slice")),
        batch,
        lambda parts: merge_states(reduce(DataFrame.unionByName, parts)).where(~gone),
    )


def follow_jobs(log: DataFrame, store: Store, checkpoint: str, lateness: str = LATENESS) -> StreamingQuery:
    """Start writing progress and final notices of a streaming job log."""
    return (
        log.writeStream.foreachBatch(lambda rows, batch: notify_batch(rows, batch, store, lateness))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_notices(spark: SparkSession, store: Store, pending: bool = True) -> DataFrame:
    """All notices; with ``pending`` also those of updates that still wait, as if no other came."""
    told = store.read(spark, NOTICES).drop("batch", "slice")
    last = store.batches(spark, BUFFER)[-1]
    if not pending:
        return told
    waiting = spark.read.parquet(store.path(BUFFER, last))
    return told.unionByName(job_changes(waiting, _states(spark, store, last + 1)).select(*told.columns))


def _watermarked(log: DataFrame) -> DataFrame:
    # times without a zone are taken in the session's
    return log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", LATENESS)


def follow_states(log: DataFrame, path: str, checkpoint: str, width: str) -> StreamingQuery:
    """Start writing the last status per window and job, once windows are final.

    Feed the written table to ``joblog.heartbeat`` for the jobs in flight.
    """
    return (
        window_states(_watermarked(log), width)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def beat_batch(states: DataFrame, batch: int, store: Store, width: str) -> None:
    """Beats of the windows that a micro-batch of final window states brings.

    The count goes on from the last beat before; windows without updates in between have
    a beat too. Each job's last flight is kept as a run of those that changed.
    """
    spark = states.sparkSession
    known = store.latest_before(spark, COUNTS, batch)
    at, count = (None, 0)
    if known is not None:
        at, count = spark.read.parquet(store.path(COUNTS, known)).first()
    states = store.write(flights(states), "window_flights", batch)
    levels = Levels(store, FLIGHTS)
    earlier = levels.read_before(spark, batch)
    carried = last_flights(reduce(DataFrame.unionByName, earlier)) if earlier else None
    beats = store.write(beats_between(states, carried, at, count, width), BEATS, batch)
    last = beats.agg(F.max("window_start").alias("at"), F.max_by("jobs_in_flight", "window_start").alias("count"))
    store.write(
        last.select(
            F.coalesce("at", F.lit(at).cast("timestamp")).alias("at"), F.coalesce("count", F.lit(count)).alias("count")
        ),
        COUNTS,
        batch,
    )
    levels.write(last_flights(states), batch, lambda parts: last_flights(reduce(DataFrame.unionByName, parts)))


def follow_heartbeat(log: DataFrame, store: Store, checkpoint: str, width: str) -> StreamingQuery:
    """Start writing the jobs in flight at the end of each window, once windows are final."""
    return (
        window_states(_watermarked(log), width)
        .writeStream.outputMode("append")
        .foreachBatch(lambda rows, batch: beat_batch(rows, batch, store, width))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_beats(spark: SparkSession, store: Store) -> DataFrame:
    return store.read(spark, BEATS).drop("batch")
