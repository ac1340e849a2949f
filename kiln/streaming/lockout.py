"""Account lockout as a stateful streaming operator (V12, streaming form).

Attempts may arrive in any order within the watermark's delay. They wait in the
state store, and an event-time timer fires when the watermark has passed the
earliest; the attempts up to the watermark then go through the rule by user, time
and id. The other state is two numbers per user. So the result is that of the
batch operator whatever the order of arrival, and a micro-batch's size is set
where the stream is read (``max_files_per_trigger``).

State, timers and output frames belong to a group of users (a hash of the user,
``groups`` of them): each costs round trips between Python and the state store,
which for a user's few attempts take far longer than the rule. What waits in a
group is held in Arrow blocks, one per micro-batch. A group holds its share of the
users, so ``groups`` grows with what waits at once; it is part of the state and stays
the same as long as a checkpoint is used.

Attempts older than the watermark when they arrive are dropped, as everywhere in
Structured Streaming. A stream that ends leaves what the watermark has not
passed in the state: send a later attempt (of any user) to release it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kiln.operators.protection import LOCKOUT_SCHEMA

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHUNK = 10_000  # rows of an output frame
GROUPS = 4096  # of users
# ``known``: a user that is NULL has the number 0
ATTEMPTS = pa.schema([("known", pa.bool_()), ("user", pa.int64()), ("t", pa.int64()), ("event_id", pa.int64()), ("outcome", pa.string())])
ACCOUNTS = pa.schema([("known", pa.bool_()), ("user", pa.int64()), ("failed", pa.int64()), ("until", pa.int64())])
FRESH = (0, -1)  # failed attempts and end of the lock of a user not seen before


def _block(table: pa.Table) -> tuple[bytes]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _table(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(block)).read_all()


class LockoutProcessor(StatefulProcessor):
    """Buffers a group's attempts until the watermark has passed them."""

    def __init__(self, max_failures: int, lock_us: int):
        self.max_failures, self.lock_us = max_failures, lock_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.accounts = handle.getValueState("accounts", "block binary")
        self.waiting = handle.getListState("waiting", "block binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest, blocks = None, []
        for pdf in rows:
            blocks.append(_block(pa.Table.from_pandas(pdf[ATTEMPTS.names], ATTEMPTS, preserve_index=False)))
            t = int(pdf["t"].min())
            earliest = t if earliest is None else min(earliest, t)
        if blocks:
            self.waiting.appendList(blocks)
        self._wake(earliest)
        return iter(())

    def _wake(self, t: int | None) -> None:
        """Ask for a timer once time ``t`` has passed, unless an earlier one is set."""
        if t is None:
            return
        due = -(-t // 1000)
        set_for = list(self.handle.listTimers())
        if not set_for or due < min(set_for):
            for x in set_for:
                self.handle.deleteTimer(x)
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        accounts = {}
        if self.accounts.exists():
            seen = _table(self.accounts.get()[0]).to_pydict()
            accounts = {(k, u): (n, end) for k, u, n, end in zip(*(seen[c] for c in ACCOUNTS.names))}
        held = pa.concat_tables(_table(b[0]) for b in self.waiting.get())
        passed = pc.less_equal(held["t"], now)
        due = held.filter(passed).sort_by([(c, "ascending") for c in ("known", "user", "t", "event_id")])
        left = held.filter(pc.invert(passed))
        if left.num_rows:
            self.waiting.put([_block(left.combine_chunks())])
            self._wake(pc.min(left["t"]).as_py())
        else:
            self.waiting.clear()
        frames = [self._decide(due.slice(lo, CHUNK), accounts) for lo in range(0, due.num_rows, CHUNK)]
        # a user as good as new is not kept
        kept = [(*user, *account) for user, account in accounts.items() if account != FRESH]
        columns = list(zip(*kept)) or [[] for _ in ACCOUNTS.names]
        self.accounts.update(_block(pa.table([pa.array(c, f.type) for c, f in zip(columns, ACCOUNTS)], schema=ACCOUNTS)))
        yield from frames

    def _decide(self, due: pa.Table, accounts: dict) -> pd.DataFrame:
        """The rule over attempts in order; ``accounts`` is brought up to date."""
        rows = due.to_pydict()
        status, counts, ends = [], [], []
        for known, user, t, outcome in zip(rows["known"], rows["user"], rows["t"], rows["outcome"]):
            failed, until = accounts.get((known, user), FRESH)
            if until > t:
                status.append("rejected")
            elif outcome == "success":
                failed, until = FRESH
                status.append("success")
            else:
                failed += 1
                if failed >= self.max_failures:
                    until = t + self.lock_us
                status.append("failure")
            accounts[known, user] = failed, until
            counts.append(failed)
            ends.append(until if until >= 0 else None)
        user = pd.array([u if k else None for k, u in zip(rows["known"], rows["user"])], dtype="Int64")
        return pd.DataFrame({
            "user_id": user, "event_id": rows["event_id"], "ts": pd.to_datetime(rows["t"], unit="us"), "outcome": rows["outcome"],
            "status": status, "failed_attempts": counts, "locked_until": pd.to_datetime(pd.array(ends, dtype="Int64"), unit="us"),
        })

    def close(self) -> None:
        pass


def lockout_stream(attempts: DataFrame, max_failures: int = 5, lock_minutes: int = 15, delay: str = "1 hour", groups: int = GROUPS) -> DataFrame:
    """Streaming lockout over a stream of login attempts (``user_id, event_id, ts, outcome``).

    ``delay``: how late an attempt may arrive behind the latest one; ``groups``: into
    how many groups the users are dealt. Needs the RocksDB state store, which is set
    on the session.
    """
    attempts.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    timed = attempts.where(F.col("ts").isNotNull()).withWatermark("ts", delay).select(
        F.pmod(F.xxhash64("user_id"), F.lit(groups)).alias("group"),
        F.col("user_id").isNotNull().alias("known"),
        F.coalesce("user_id", F.lit(0)).cast("bigint").alias("user"),
        "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_id", "outcome",
    )
    return timed.groupBy("group").transformWithStateInPandas(
        LockoutProcessor(max_failures, int(lock_minutes) * 60_000_000), outputStructType=LOCKOUT_SCHEMA, outputMode="append", timeMode="eventTime"
    )
