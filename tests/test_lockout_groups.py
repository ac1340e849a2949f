"""The streaming lockout keeps state and timers by group of users, not by user."""

import uuid

from test_lockout import SCHEMA, attempts, replay

from kiln.session import scratch_path
from kiln.streaming import ingest
from kiln.streaming.lockout import lockout_stream


def test_timers_by_group_and_users_without_id(spark):
    rows = attempts(7, users=40, n=400)  # user 3 has no id
    assert any(r[0] is None for r in rows)
    landing, out = (scratch_path(spark, f"lockout-groups-{x}-{uuid.uuid4().hex[:8]}") for x in ("in", "out"))
    span = max(r[2] for r in rows) - min(r[2] for r in rows)
    last = max(r[2] for r in rows)
    for k in range(2):
        spark.createDataFrame(rows[k::2], SCHEMA).repartition(1).write.json(f"{landing}/part{k}")
    spark.createDataFrame([(99, 10**6, last + 3 * span, "failure")], SCHEMA).repartition(1).write.json(f"{landing}/part2")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").json(landing)
    delay = f"{int(span.total_seconds()) + 10} seconds"
    query = ingest.to_parquet(lockout_stream(stream, delay=delay, groups=4), out, f"lockout-{uuid.uuid4().hex[:8]}")
    query.awaitTermination()
    got = spark.read.parquet(out).collect()
    assert {r.event_id: (r.status, r.failed_attempts, r.locked_until) for r in got} == replay(rows)
    assert {r.event_id: r.user_id for r in got} == {r[1]: r[0] for r in rows}
    timers = [p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(timers) <= 4
