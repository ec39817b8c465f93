"""Job state and progress from an append-only log of job updates.

Columns of a log: job_id, ts, event_id, stage, status and any further fields.
Updates of a job are ordered by (ts, event_id).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicsieve.operators.summary import in_flight

# Bounds of a job listing, final states, and the batch target.
MAX_JOBS_LISTED = 500
FINAL = ("completed", "failed")
ALL_PAPERS = "ALL"

KEY = ("job_id", "ts", "event_id")

# Length of the time slices that long logs of one job are cut into.
SLICE = "1 hour"
# Windows of a heartbeat that are accumulated in one task.
BEAT_SLICE = 10_000


def job_latest_state(log: DataFrame) -> DataFrame:
    """Current row per job: every field as its last non-null update set it.

    Pure partial aggregation, so a job with most of the log costs one row per
    map task.
    """
    order = F.struct("ts", "event_id")

    def last(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), order)).alias(name)

    fields = [c for c in log.columns if c not in KEY]
    return log.groupBy("job_id").agg(
        *[last(f) for f in fields], F.min("ts").alias("created_at"), F.max("ts").alias("updated_at")
    )


def job_lookup(jobs: DataFrame, job_id: str) -> DataFrame:
    return jobs.where(F.col("job_id") == job_id)


def recent_jobs(jobs: DataFrame, limit: int = 50) -> DataFrame:
    if not 1 <= limit <= MAX_JOBS_LISTED:
        raise ValueError(f"limit must be 1..{MAX_JOBS_LISTED}")
    return jobs.orderBy(F.desc("created_at"), "job_id").limit(limit)


def completed_targets(jobs: DataFrame) -> DataFrame:
    """Completed jobs that were about one paper."""
    concrete = F.coalesce("paper_id", F.lit("")) != ""
    return jobs.where((F.col("status") == "completed") & concrete & (F.col("paper_id") != ALL_PAPERS))


def job_progress(jobs: DataFrame) -> DataFrame:
    """Add the finished fraction, and position and size from an 'i/N' stage."""
    known = F.col("total").isNotNull() & (F.col("total") != 0)

    def number(group: int) -> Column:
        found = F.regexp_extract("stage", r"([0-9]+)/([0-9]+)\z", group)
        return F.nullif(found, F.lit("")).cast("bigint")

    return (
        jobs.withColumn("fraction", F.when(known, F.col("processed") / F.col("total")))
        .withColumn("stage_done", number(1))
        .withColumn("stage_total", number(2))
    )


def is_final(status: Column) -> Column:
    return F.coalesce(status.isin(*FINAL), F.lit(False))


def sliced(log: DataFrame, width: str = SLICE) -> DataFrame:
    """Number the time slices of the log; a job's slices follow each other.

    A slice depends on the row alone, so it can be computed anywhere and any number
    of times. A job that holds a third of the log is spread over as many groups as
    it has slices.
    """
    micros = F.unix_micros(F.expr(f"TIMESTAMP'1970-01-01 00:00:00Z' + INTERVAL {width}"))
    return log.withColumn("slice", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / micros))


def in_ranges(log: DataFrame) -> DataFrame:
    """Cut the log into slices by range over (ts, event_id), however many updates share a time.

    To be stored before it is used, as partitions become slices.
    """
    return log.repartitionByRange("ts", "event_id").withColumn("slice", F.spark_partition_id().cast("long"))


def with_previous(log: DataFrame, carried: DataFrame | None = None, width: str = SLICE) -> DataFrame:
    """Add each row's previous stage, and whether its job was final before it.

    Windows run within (job, slice); what a job looked like at the end of its
    earlier slices is carried over through a summary of one row per job and
    slice. ``carried`` (job_id, last_stage, closed) continues from earlier batches. A
    log that is cut already has its ``slice``, numbered in order.
    """
    rows = log if "slice" in log.columns else sliced(log, width)
    final = is_final(F.col("status"))
    here = Window.partitionBy("job_id", "slice").orderBy("ts", "event_id")
    local = (
        rows.withColumn("_before", F.lag("stage").over(here))
        .withColumn("_nth", F.row_number().over(here))
        .withColumn(
            "_closed",
            F.coalesce(F.max(final).over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)),
        )
    )
    ends = rows.groupBy("job_id", "slice").agg(
        F.max_by("stage", F.struct("ts", "event_id")).alias("_end"), F.max(final).alias("_final")
    )
    across = Window.partitionBy("job_id").orderBy("slice")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    entry = ends.select(
        "slice",
        "job_id",
        F.lag("_end").over(across).alias("_entry"),
        (F.row_number().over(across) == 1).alias("_first"),
        F.coalesce(F.max("_final").over(earlier), F.lit(False)).alias("_closed_entry"),
    )
    if carried is not None:
        known = carried.select(
            "job_id", F.col("last_stage").alias("_stage_then"), F.col("closed").alias("_closed_then")
        )
        entry = entry.join(known, "job_id", "left").select(
            "slice",
            "job_id",
            F.when(F.col("_first"), F.col("_stage_then")).otherwise(F.col("_entry")).alias("_entry"),
            (F.col("_closed_entry") | F.coalesce("_closed_then", F.lit(False))).alias("_closed_entry"),
        )
    return (
        local.join(entry.drop("_first"), ["job_id", "slice"])
        .withColumn(
            "previous_stage", F.when(F.col("_nth") == 1, F.col("_entry")).otherwise(F.col("_before"))
        )
        .withColumn("already_final", F.col("_closed") | F.col("_closed_entry"))
        .drop("slice", "_before", "_nth", "_closed", "_entry", "_closed_entry")
    )


def job_changes(log: DataFrame, carried: DataFrame | None = None, width: str = SLICE) -> DataFrame:
    """Progress and final notices of every job.

    A progress row where the stage differs from the one before (the first
    non-null always), one completed/failed row at the first final status, and
    nothing for the job after that.
    """
    open_rows = with_previous(log, carried, width).where(~F.col("already_final"))
    progress = F.when(~F.col("stage").eqNullSafe(F.col("previous_stage")), F.lit("job.progress"))
    notice = F.when(is_final(F.col("status")), F.concat(F.lit("job."), F.col("status")))
    return (
        open_rows.withColumn("notice", F.explode(F.array(progress, notice)))
        .where(F.col("notice").isNotNull())
        .drop("previous_stage", "already_final")
    )


def job_terminal(log: DataFrame) -> DataFrame:
    """The first final update per job; partial aggregation only."""
    fields = [c for c in log.columns if c != "job_id"]
    first = F.min_by(F.struct(*fields), F.struct("ts", "event_id"))
    return (
        log.where(is_final(F.col("status")))
        .groupBy("job_id")
        .agg(first.alias("_first"))
        .select("job_id", "_first.*")
        .withColumn("notice", F.concat(F.lit("job."), F.col("status")))
    )


def carry_state(log: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """State per job after ``log``: (job_id, last_stage, closed, last_ts, last_event_id)."""
    state = log.groupBy("job_id").agg(
        F.max_by("stage", F.struct("ts", "event_id")).alias("last_stage"),
        F.max(is_final(F.col("status"))).alias("closed"),
        F.max(F.struct("ts", "event_id")).alias("_last"),
    )
    state = state.select(
        "job_id", "last_stage", "closed",
        F.col("_last.ts").alias("last_ts"), F.col("_last.event_id").alias("last_event_id"),
    )
    return state if carried is None else merge_states(state.unionByName(carried.select(*state.columns)))


def merge_states(states: DataFrame) -> DataFrame:
    """One state per job out of those that several parts of a log left."""
    last = F.struct("last_ts", "last_event_id")
    return (
        states.groupBy("job_id")
        .agg(
            F.max_by("last_stage", last).alias("last_stage"),
            F.max("closed").alias("closed"),
            F.max(last).alias("_last"),
        )
        .select("job_id", "last_stage", "closed", "_last.*")
    )


def window_states(log: DataFrame, width: str) -> DataFrame:
    """Last status per tumbling window and job; also the streaming aggregation."""
    return log.groupBy(F.window("ts", width).alias("window"), "job_id").agg(
        F.max_by("status", F.struct("ts", "event_id")).alias("status")
    )


def flights(states: DataFrame) -> DataFrame:
    """``job_id``, ``window_start`` and ``flying`` (1 or 0) of window states."""
    return states.select(
        "job_id", F.col("window.start").alias("window_start"), in_flight(F.col("status")).cast("int").alias("flying")
    )


def last_flights(known: DataFrame) -> DataFrame:
    """Each job's last flight."""
    return known.groupBy("job_id").agg(
        F.max("window_start").alias("window_start"), F.max_by("flying", "window_start").alias("flying")
    )


def _changes(known: DataFrame, carried: DataFrame | None) -> DataFrame:
    """By how much the jobs in flight change in each window with updates."""
    per_job = Window.partitionBy("job_id").orderBy("window_start")
    rows = known.withColumn("_before", F.lag("flying").over(per_job))
    if carried is not None:
        then = carried.select("job_id", F.col("flying").alias("_then"))
        rows = rows.join(then, "job_id", "left").withColumn("_before", F.coalesce("_before", "_then"))
    change = F.col("flying") - F.coalesce("_before", F.lit(0))
    return rows.withColumn("_change", change).groupBy("window_start").agg(F.sum("_change").alias("_change"))


def beats_between(
    known: DataFrame, carried: DataFrame | None, after: datetime | None, count: int, width: str
) -> DataFrame:
    """Beats of all windows from the one after ``after`` (or the first one) to the last one.

    ``known`` are flights in these windows, ``carried`` each job's last one before, and
    ``count`` the jobs in flight then. Each window's change is a sum over its jobs; the
    changes are accumulated within slices of ``BEAT_SLICE`` windows, and the slices'
    totals over one row per slice. Windows without updates are a sequence that the plan
    derives from its bounds, so nothing is run to build the frame.
    """
    step = _micros(width)
    micros = F.lit(step).cast("long")
    start = F.unix_micros(F.col("window_start").cast("timestamp"))
    changes = _changes(known, carried).select(F.col("window_start"), start.alias("_start"), "_change")
    kind = known.schema["window_start"].dataType
    first = F.min("_start") if after is None else F.unix_micros(F.lit(after).cast("timestamp")) + micros
    bounds = changes.agg(first.alias("_low"), F.max("_start").alias("_high"))
    # a row for each slice, then one for each window in it
    span = micros * BEAT_SLICE
    n_slices = F.floor((F.col("_high") - F.col("_low")) / span)
    slices = bounds.where("_high >= _low").select(
        "_low", "_high", F.explode(F.sequence(F.lit(0).cast("long"), n_slices)).alias("slice")
    )
    begin = F.col("_low") + F.col("slice") * span
    windows = slices.select(
        "slice",
        F.explode(F.sequence(begin, F.least(F.col("_high"), begin + span - micros), micros)).alias("_start"),
    )
    numbered = windows.join(changes.select("_start", "_change"), "_start", "left").select(
        "slice", "_start", F.coalesce("_change", F.lit(0)).alias("_change")
    )
    so_far = Window.partitionBy("slice").orderBy("_start").rowsBetween(Window.unboundedPreceding, 0)
    totals = numbered.groupBy("slice").agg(F.sum("_change").alias("_total"))
    # one row for each 10,000 windows
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("slice", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    return (
        numbered.withColumn("_sum", F.sum("_change").over(so_far))
        .join(before, "slice")
        .select(
            F.timestamp_micros("_start").cast(kind).alias("window_start"),
            (F.lit(count) + F.col("_before") + F.col("_sum")).cast("long").alias("jobs_in_flight"),
        )
    )


def _micros(width: str) -> int:
    """Microseconds of an interval of weeks to microseconds, as ``window`` takes them."""
    units = {"week": 604_800_000_000, "day": 86_400_000_000, "hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000, "millisecond": 1_000, "microsecond": 1}
    number, unit = width.split()
    return int(number) * units[unit.lower().removesuffix("s")]


def heartbeat(states: DataFrame, width: str) -> DataFrame:
    """Jobs in flight at the end of every window: (window_start, jobs_in_flight)."""
    return beats_between(flights(states), None, None, 0, width)
