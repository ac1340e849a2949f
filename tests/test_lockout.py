"""The lockout rule, in batch and as a stream, against a replay attempt by attempt."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kiln.operators import protection

START = datetime(2024, 1, 1)


def replay(attempts, most=5, minutes=15):
    """``{event_id: (status, failed_attempts, locked_until)}``"""
    out, state = {}, {}
    for user, event, ts, outcome in sorted(attempts, key=lambda a: (a[0] or -1, a[2], a[1])):
        count, until = state.get(user, (0, None))
        if until is not None and until > ts:
            status = "rejected"
        elif outcome == "success":
            status, count, until = "success", 0, None
        else:
            status, count = "failure", count + 1
            if count >= most:
                until = ts + timedelta(minutes=minutes)
        state[user] = count, until
        out[event] = status, count, until
    return out


def attempts(seed, users=12, n=900, hot=0.3):
    rng = random.Random(seed)
    clock = {u: START + timedelta(minutes=rng.randrange(3000)) for u in range(users)}
    rows = []
    for event in range(n):
        u = 0 if rng.random() < hot else rng.randrange(users)
        clock[u] += timedelta(seconds=rng.choice([0, 20, 60, 240, 600, 899, 900, 901, 4000, 90_000]))
        rows.append((u if u != 3 else None, event, clock[u], "success" if rng.random() < 0.15 else "failure"))
    rng.shuffle(rows)
    return rows


SCHEMA = "user_id long, event_id long, ts timestamp, outcome string"


@pytest.mark.parametrize("seed", range(3))
def test_batch_equals_the_replay(spark, seed):
    rows = attempts(seed)
    got = protection.lockout(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert {r.event_id: (r.status, r.failed_attempts, r.locked_until) for r in got} == replay(rows)
    assert len(got) == len(rows)


def test_sessions_over_many_arrow_batches(spark):
    # one user who never pauses, and other limits than the usual ones
    rows = [(1, i, START + timedelta(seconds=70 * i), "success" if i % 37 == 0 else "failure") for i in range(700)]
    rows += [(2, 1000 + i, START + timedelta(hours=2 * i), "failure") for i in range(40)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = protection.lockout(spark.createDataFrame(rows, SCHEMA), 3, 20).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.event_id: (r.status, r.failed_attempts, r.locked_until) for r in got} == replay(rows, 3, 20)


def test_attempts_of_one_user_spread_over_tasks(spark):
    rows = [(7, i, START + timedelta(minutes=20 * i), "failure") for i in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = protection.lockout(spark.createDataFrame(rows, SCHEMA)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.task for r in got}) >= 4
    assert [r.failed_attempts for r in sorted(got, key=lambda r: r.event_id)] == list(range(1, 601))


def test_no_attempts(spark):
    assert protection.lockout(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, 1, None, "failure"), (1, 2, START, None)]
    assert [(r.event_id, r.status) for r in protection.lockout(spark.createDataFrame(rows, SCHEMA)).collect()] == [(2, "failure")]


def test_stream_equals_the_replay_in_any_order_of_arrival(spark):
    import time
    import uuid

    from kiln.session import scratch_path
    from kiln.streaming import ingest
    from kiln.streaming.lockout import lockout_stream

    rows = [r for r in attempts(5, n=250) if r[0] is not None]
    landing, out = (scratch_path(spark, f"lockout-{x}-{uuid.uuid4().hex[:8]}") for x in ("in", "out"))
    # shuffled rows in several files, one file a micro-batch; a second wave goes on from the first one's state
    middle = sorted(r[2] for r in rows)[len(rows) // 2]
    span = max(r[2] for r in rows) - min(r[2] for r in rows)
    for k, part in enumerate([[r for r in rows if r[2] < middle], [r for r in rows if r[2] >= middle], [(99, 10**6, middle + 3 * span, "failure")]]):
        spark.createDataFrame(part, SCHEMA).repartition(2 if k < 2 else 1).write.json(f"{landing}/part{k}")
        time.sleep(1.1)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").json(landing)
    delay = f"{int(span.total_seconds() / 2) + 400_000} seconds"
    ingest.to_parquet(lockout_stream(stream, delay=delay), out, f"lockout-{uuid.uuid4().hex[:8]}").awaitTermination()
    got = spark.read.parquet(out).collect()
    assert {r.event_id: (r.status, r.failed_attempts, r.locked_until) for r in got} == replay(rows)
    assert len(got) == len(rows)
