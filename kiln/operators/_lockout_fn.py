"""The lockout rule over many sessions at once, as numpy arrays.

A session is a stretch of one user's attempts without a pause as long as a lock.
Sessions are stepped together: step k handles the k-th attempt of every session
that has one, so the work of a batch is a few array operations per step. A
session may go on in the next batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

OPEN = np.iinfo(np.int64).min  # lock end of an account that isn't locked


class Sessions:
    """States of the sessions of a batch: ``count``, ``until`` and ``reset`` per session and hypothetical start."""

    def __init__(self, count: np.ndarray, until: np.ndarray, reset: np.ndarray, max_failures: int, lock: int):
        self.count, self.until, self.reset = count, until, reset
        self.max_failures, self.lock = max_failures, lock

    def step(self, which: np.ndarray, t: np.ndarray, success: np.ndarray) -> np.ndarray:
        """Handle one attempt of each of the sessions ``which``; returns whether it was accepted."""
        t, success = t[:, None], success[:, None]
        count, until = self.count[which], self.until[which]
        accepted = until <= t
        good, bad = accepted & success, accepted & ~success
        count = np.where(good, 0, count + bad)
        self.count[which] = count
        self.until[which] = np.where(good, OPEN, np.where(bad & (count >= self.max_failures), t + self.lock, until))
        self.reset[which] |= good
        return accepted


def _bounds(same: np.ndarray) -> np.ndarray:
    """First row of each session, and the number of rows; ``same`` tells which rows go on with the one before."""
    return np.append(np.flatnonzero(~same), len(same))


def _steps(first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(sessions, rows)`` of each step."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    longest_first = -size[order]
    for k in range(int(size.max(initial=0))):
        live = order[: np.searchsorted(longest_first, -k)]
        yield live, first[live] + k


def session_task(names: list[str], starts: np.ndarray | None, max_failures: int, lock: int):
    """Batches sorted by session to one row a session, or to one row an attempt.

    ``names``: the columns that name a session. With ``starts`` (hypothetical counts at
    its start) a session gives its effect on each: ``reset`` and the count at its end (if
    reset) or added. Without, the column ``entry`` holds the real count, and each attempt
    gives ``status``, ``failed_attempts`` and ``locked_until``.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key = held = None  # the session that may go on, and its state

        def row_of(key, state):
            n = state[0] - np.where(state[2], 0, starts)
            columns = [pa.array([v], t) for v, t in key]
            return pa.RecordBatch.from_arrays([*columns, pa.array([state[2].tolist()], pa.list_(pa.bool_())), pa.array([n.tolist()], pa.list_(pa.int64()))], [*names, "reset", "n"])

        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(n) for n in names]
            same = np.ones(b.num_rows, dtype=bool)
            for k in keys:
                code = k.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                same[1:] &= code[1:] == code[:-1]
            same[0] = False
            first = _bounds(same)
            n = len(first) - 1
            entry = np.tile(starts, (n, 1)) if starts is not None else b.column("entry").to_numpy()[first[:-1]][:, None].copy()
            s = Sessions(entry.astype(np.int64), np.full(entry.shape, OPEN), np.zeros(entry.shape, dtype=bool), max_failures, lock)
            if held is not None:
                if [v for v, _ in held_key] == [k[0].as_py() for k in keys]:
                    s.count[0], s.until[0], s.reset[0] = held
                elif starts is not None:
                    yield row_of(held_key, held)
            t, success = b.column("t").to_numpy(), b.column("success").to_numpy(zero_copy_only=False)
            rows = b.num_rows
            accepted, count, until = np.zeros(rows, dtype=bool), np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
            for live, at in _steps(first):
                ok = s.step(live, t[at], success[at])
                if starts is None:
                    accepted[at], count[at], until[at] = ok[:, 0], s.count[live, 0], s.until[live, 0]
            last = int(first[-2])
            held_key, held = [(k[last].as_py(), k.type) for k in keys], (s.count[-1], s.until[-1], s.reset[-1])
            if starts is not None:
                done = slice(0, n - 1)
                if n > 1:
                    added = s.count[done] - np.where(s.reset[done], 0, starts)
                    lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(np.arange(n) * len(starts), pa.int32()), pa.array(x.reshape(-1), kind))
                    at = pa.array(first[:-2])
                    yield pa.RecordBatch.from_arrays([*[k.take(at) for k in keys], lists(s.reset[done], pa.bool_()), lists(added, pa.int64())], [*names, "reset", "n"])
            else:
                status = np.where(~accepted, "rejected", np.where(success, "success", "failure"))
                ends = pa.array(until, mask=until == OPEN).cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in ("user_id", "event_id", "ts", "outcome")], pa.array(status), pa.array(count), ends],
                    ["user_id", "event_id", "ts", "outcome", "status", "failed_attempts", "locked_until"],
                )
        if held is not None and starts is not None:
            yield row_of(held_key, held)

    return task
