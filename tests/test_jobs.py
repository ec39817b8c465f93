"""Job log operators against plain Python, with a job that dominates the log."""

import random
from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicsieve.operators import joblog
from topicsieve.streaming import progress
from topicsieve.streaming.store import Levels, Store

SCHEMA = "job_id string, ts timestamp, event_id long, stage string, status string"
START = datetime(2024, 1, 1)
FINAL = ("completed", "failed")


def make_log(n=3000, seed=3):
    """A third of all rows belong to one job, which ends late; ties in time occur."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        job = "hot" if hot else f"job{rng.randrange(40)}"
        final = i > 0.95 * n if hot else rng.random() < 0.05
        status = rng.choice(FINAL) if final else rng.choice(("queued", "running"))
        stage = rng.choice((None, "a", "a", "b", "c"))
        rows.append((job, START + timedelta(seconds=i // 2), i, stage, status))
    rng.shuffle(rows)
    return rows


def expected_changes(rows):
    out, last, closed = set(), {}, set()
    for job, ts, event, stage, status in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if job in closed:
            continue
        if stage != last.get(job):
            out.add((job, event, "job.progress"))
        last[job] = stage
        if status in FINAL:
            out.add((job, event, f"job.{status}"))
            closed.add(job)
    return out


def found(df):
    rows = [(r["job_id"], r["event_id"], r["notice"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_changes_match_a_sequential_reading(spark):
    rows = make_log()
    log = spark.createDataFrame(rows, SCHEMA)
    for width in ("1 minute", "7 seconds", "1 day"):
        assert found(joblog.job_changes(log, width=width)) == expected_changes(rows)


def test_the_hot_job_is_spread_over_slices(spark):
    cut = joblog.sliced(spark.createDataFrame(make_log(), SCHEMA), "1 minute")
    hot = cut.where("job_id = 'hot'").groupBy("slice").count().collect()
    assert len(hot) > 1
    assert max(r["count"] for r in hot) < 1000


def test_terminal_is_the_first_final_update(spark):
    rows = make_log()
    firsts = {}
    for job, ts, event, _, status in sorted(rows, key=lambda r: (r[1], r[2])):
        if status in FINAL:
            firsts.setdefault(job, (event, f"job.{status}"))
    done = joblog.job_terminal(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["job_id"]: (r["event_id"], r["notice"]) for r in done} == firsts


def test_small_change_cases(spark):
    at = lambda i: START + timedelta(seconds=i)
    rows = [
        ("x", at(0), 0, "a", "queued"),
        ("x", at(1), 1, "a", "running"),
        ("x", at(2), 2, "a", "failed"),
        ("x", at(3), 3, "b", "running"),
        ("y", at(0), 4, None, "queued"),
        ("y", at(1), 5, "z", "completed"),
    ]
    assert found(joblog.job_changes(spark.createDataFrame(rows, SCHEMA))) == {
        ("x", 0, "job.progress"),
        ("x", 2, "job.failed"),
        ("y", 5, "job.progress"),
        ("y", 5, "job.completed"),
    }


def test_latest_state_merges_partial_updates(spark):
    rows = [
        ("x", START, 0, "a", "queued"),
        ("x", START + timedelta(seconds=1), 1, None, "running"),
        ("x", START + timedelta(seconds=1), 2, None, "completed"),
    ]
    row = joblog.job_latest_state(spark.createDataFrame(rows, SCHEMA)).first()
    assert (row["stage"], row["status"]) == ("a", "completed")
    assert (row["updated_at"] - row["created_at"]).total_seconds() == 1


def test_progress_of_unknown_totals(spark):
    jobs = spark.createDataFrame(
        [(5, 10, "justify 5/10"), (5, None, "scoring"), (5, 0, "0/0")], "processed int, total int, stage string"
    )
    rows = [(r["fraction"], r["stage_done"], r["stage_total"]) for r in joblog.job_progress(jobs).collect()]
    assert rows == [(0.5, 5, 10), (None, None, None), (None, 0, 0)]


def test_listing_bounds(spark):
    jobs = joblog.job_latest_state(spark.createDataFrame(make_log(60), SCHEMA))
    assert joblog.recent_jobs(jobs, 3).count() == 3
    for limit in (0, 501):
        with pytest.raises(ValueError):
            joblog.recent_jobs(jobs, limit)


def test_heartbeat_matches_a_replay(spark):
    rows = make_log(600)
    states = joblog.window_states(spark.createDataFrame(rows, SCHEMA), "1 minute")
    beats = {r["window_start"]: r["jobs_in_flight"] for r in joblog.heartbeat(states, "1 minute").collect()}
    assert len(beats) == 5
    for start, count in beats.items():
        last = {}
        for job, ts, event, _, status in sorted(rows, key=lambda r: (r[1], r[2])):
            if ts < start + timedelta(minutes=1):
                last[job] = status
        assert count == sum(status != "completed" for status in last.values())


def write_in_steps(spark, rows, folder, steps):
    """One file per step, in time order."""
    ordered = sorted(rows, key=lambda r: (r[1], r[2]))
    size = len(ordered) // steps
    for step in range(steps):
        part = ordered[step * size : (step + 1) * size if step < steps - 1 else None]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def log_stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_streamed_notices_equal_the_batch(spark, tmp_path):
    rows = [r for r in make_log(900)]
    write_in_steps(spark, rows, f"{tmp_path}/log", 3)
    store = Store(f"{tmp_path}/store")
    finish(progress.follow_jobs(log_stream(spark, f"{tmp_path}/log"), store, f"{tmp_path}/cp"))
    assert len(store.batches(spark, progress.NOTICES)) == 3
    assert found(progress.read_notices(spark, store)) == expected_changes(rows)


def test_equal_time_stamps_across_batches(spark, tmp_path):
    store = Store(f"{tmp_path}/store")
    batches = [
        [("x", START, 0, "a", "running"), ("y", START, 1, "a", "running"), ("x", START, 2, "b", "running")],
        [("x", START, 3, "b", "running"), ("x", START, 1, "late", "running"), ("y", START, 4, "a", "completed")],
        [("x", START, 3, "b", "running"), ("x", START, 5, "c", "failed"), ("y", START, 6, "z", "running")],
    ]
    for number, rows in enumerate(batches):
        progress.notify_batch(spark.createDataFrame(rows, SCHEMA), number, store)
    assert found(progress.read_notices(spark, store)) == expected_changes(sorted({r for b in batches for r in b}))
    assert progress.read_notices(spark, store, pending=False).count() == 0


def shuffled(rows, hours, seed=1):
    """Rows in an order that is wrong by up to so many hours."""
    rng = random.Random(seed)
    return sorted(rows, key=lambda r: r[1] + timedelta(hours=rng.uniform(0, hours)))


def spread_log(n, days):
    """A log whose updates are far apart."""
    return [(j, START + (t - START) * (days * 86_400 / n), e, stage, status) for j, t, e, stage, status in make_log(n)]


def test_updates_a_day_out_of_order_are_told_in_order(spark, tmp_path):
    rows = spread_log(400, 20)
    late = shuffled(rows, 23)
    assert [r[2] for r in late] != [r[2] for r in sorted(rows, key=lambda r: (r[1], r[2]))]
    store = Store(f"{tmp_path}/store")
    for number in range(8):
        part = late[number * 50 : (number + 1) * 50] + late[max(0, number * 50 - 5) : number * 50]  # some come again
        progress.notify_batch(spark.createDataFrame(part, SCHEMA), number, store)
    assert found(progress.read_notices(spark, store)) == expected_changes(rows)
    final = progress.read_notices(spark, store, pending=False)
    assert 0 < final.count() < len(expected_changes(rows))
    waiting = spark.read.parquet(store.path(progress.BUFFER, 7))
    assert waiting.agg(F.max("ts") - F.min("ts")).first()[0] <= timedelta(days=1)


def test_states_of_closed_jobs_are_forgotten(spark, tmp_path):
    store, day = Store(f"{tmp_path}/store"), timedelta(days=1)
    for number in range(17):
        rows = [(f"{number}-{i}", START + number * 2 * day, i, "a", "completed") for i in range(5)]
        rows += [("open", START + number * 2 * day, 9, f"s{number}", "running")]
        progress.notify_batch(spark.createDataFrame(rows, SCHEMA), number, store, remembered="4 days")
    levels = Levels(store, progress.STATE)
    merged = spark.read.parquet(store.path("state/level=1", 15))
    assert levels.runs(17) == [(1, 7), (1, 15), (0, 16)]
    # of 40 jobs closed in the merged batches, those of the last days and the open one
    assert {r.job_id for r in merged.where("closed").collect()} == {f"{n}-{i}" for n in (13, 14) for i in range(5)}
    assert merged.where("NOT closed").count() == 1


def test_levels(spark, tmp_path):
    levels = Levels(Store(f"{tmp_path}/s"), "t", fan=3)
    assert levels.runs(0) == []
    for batch in range(13):
        levels.write(spark.range(batch, batch + 1), batch, lambda parts: reduce(DataFrame.union, parts))
        ids = [[r.id for r in part.collect()] for part in levels.read_before(spark, batch + 1)]
        assert sorted(sum(ids, [])) == list(range(batch + 1))
        assert len(ids) <= 2 * 3
    assert levels.runs(13) == [(2, 8), (1, 11), (0, 12)]


@pytest.mark.parametrize("parts", [1, 5])
def test_streamed_beats_go_on_across_batches(spark, tmp_path, parts):
    rows = [r for r in spread_log(200, 3)]
    states = joblog.window_states(spark.createDataFrame(rows, SCHEMA), "1 hour").collect()
    states.sort(key=lambda r: r.window.start)
    schema = joblog.window_states(spark.createDataFrame(rows, SCHEMA), "1 hour").schema
    store, size = Store(f"{tmp_path}/store"), -(-len(states) // parts)
    starts = sorted({r.window.start for r in states})
    cut = [starts[min(len(starts) - 1, (len(starts) * i) // parts)] for i in range(1, parts)]
    for number in range(parts):
        part = [r for r in states if sum(r.window.start >= c for c in cut) == number]
        progress.beat_batch(spark.createDataFrame(part, schema), number, store, "1 hour")
    progress.beat_batch(spark.createDataFrame([], schema), parts, store, "1 hour")
    batch = joblog.heartbeat(spark.createDataFrame(states, schema), "1 hour")
    assert size and sorted(progress.read_beats(spark, store).collect()) == sorted(batch.collect())


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    rows = sorted(make_log(300), key=lambda r: (r[1], r[2]))
    store = Store(f"{tmp_path}/store")
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (rows[:150], rows[150:]))
    progress.notify_batch(first, 0, store)
    progress.notify_batch(second, 1, store)
    before = found(progress.read_notices(spark, store))
    progress.notify_batch(second, 1, store)
    assert found(progress.read_notices(spark, store)) == before == expected_changes(rows)


def test_late_updates_are_dropped(spark, tmp_path):
    store = Store(f"{tmp_path}/store")
    on_time = [("x", START + timedelta(seconds=10), 0, "b", "running")]
    late = [("x", START, 1, "a", "running"), ("x", START + timedelta(seconds=11), 2, "c", "running")]
    progress.notify_batch(spark.createDataFrame(on_time, SCHEMA), 0, store, "2 seconds")
    progress.notify_batch(spark.createDataFrame(late, SCHEMA), 1, store, "2 seconds")
    assert found(progress.read_notices(spark, store)) == {("x", 0, "job.progress"), ("x", 2, "job.progress")}


def test_streamed_heartbeat_equals_the_batch_for_final_windows(spark, tmp_path):
    rows = make_log(600)
    # A much later update moves the watermark past all real windows.
    rows.append(("end", START + timedelta(days=3), 10_000, "z", "completed"))
    write_in_steps(spark, rows, f"{tmp_path}/log", 2)
    finish(
        progress.follow_states(
            log_stream(spark, f"{tmp_path}/log"), f"{tmp_path}/states", f"{tmp_path}/cp", "1 minute"
        )
    )
    streamed = joblog.heartbeat(spark.read.parquet(f"{tmp_path}/states"), "1 minute")
    batch = joblog.heartbeat(
        joblog.window_states(spark.createDataFrame(rows[:-1], SCHEMA), "1 minute"), "1 minute"
    )
    assert sorted(streamed.collect()) == sorted(batch.collect())


