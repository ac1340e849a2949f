"""Validators and protection re-aimed as table jobs.

Per-row checks of the reference become "scan these columns of a table,
return per-row flags"; every scan runs over whole texts with JVM regular
expressions inside whole-stage codegen.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kiln.functions import validators as V
from kiln.functions.dates import as_ts
from kiln.operators._lockout_fn import session_task
from kiln.session import staged

# Candidate extractors for values embedded in free text.
EMAIL_CANDIDATE = r"\S+@\S+"
PHONE_CANDIDATE = r"\+?[\d(][\d\s().-]{8,}\d"
SECRET_CANDIDATE = r"(?i)(?:token|secret|password|api_key)\s*[:=]\s*\"?([^\"\s]+)"


def _candidates(df: DataFrame, id_col: str, text_col: str, pattern: str, group: int = 0) -> DataFrame:
    # explode_outer + NULL filter: a plain explode would add an inferred
    # size(...) > 0 filter that runs the regular expression a second time.
    return df.select(
        id_col, F.explode_outer(F.regexp_extract_all(F.col(text_col), F.lit(pattern), group)).alias("candidate")
    ).where(F.col("candidate").isNotNull())


def email_check(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every ``x@y`` token of the text with its e-mail validity (V1)."""
    return _candidates(df, id_col, text_col, EMAIL_CANDIDATE).withColumn("valid", V.is_email(F.col("candidate")))


def phone_check(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every phone-like digit run of the text with its US-phone validity (V2)."""
    return _candidates(df, id_col, text_col, PHONE_CANDIDATE).withColumn("valid", V.is_phone(F.col("candidate")))


def secret_check(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Secrets assigned in the text (``token = "..."``) with the secret rule
    (V9) and both password rule sets (V8)."""
    c = _candidates(df, id_col, text_col, SECRET_CANDIDATE, 1)
    s = F.col("candidate")
    return c.select(
        id_col,
        "candidate",
        V.secret_strength(s).alias("strong_secret"),
        V.password_strength(s).alias("password"),
        V.password_strength_config(s).alias("password_config"),
    )


def injection_scan(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """SQL-injection (V4) and script-injection (V5) flags per row."""
    t = F.col(text_col)
    return df.select(id_col, V.has_sql_injection(t).alias("sql_injection"), V.has_xss(t).alias("xss"))


def key_presence(df: DataFrame, json_col: str, required: list[str]) -> DataFrame:
    """Per required key: rows whose JSON object has it with a non-empty
    value, and whether every row does (V10, a left join of the key list
    against the key/value table, written as one aggregate)."""
    m = F.from_json(F.col(json_col), "map<string,string>")
    aggs = [F.count("*").alias("__n")]
    for i, k in enumerate(required):
        v = m[F.lit(k)]
        aggs.append(F.count_if(v.isNotNull() & (v != "")).alias(f"k{i}"))
    wide = df.agg(*aggs)
    rows = [
        F.struct(F.lit(k).alias("key"), F.col(f"k{i}").alias("rows_present"), (F.col(f"k{i}") == F.col("__n")).alias("present"))
        for i, k in enumerate(required)
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# --------------------------------------------------------------------------
# V11 column encryption
# --------------------------------------------------------------------------

def derive_key(passphrase: str, salt: bytes, rounds: int = 100_000) -> bytes:
    """32-byte key from a passphrase (PBKDF2-HMAC-SHA256), once on the driver."""
    return hashlib.pbkdf2_hmac("sha256", passphrase.encode("utf-8"), salt, rounds, dklen=32)


def store_key(spark: SparkSession, key: bytes, path: str) -> None:
    """Keep a key as a one-row table in a folder that only the jobs may read."""
    spark.createDataFrame([(bytearray(key),)], "key binary").coalesce(1).write.mode("errorifexists").parquet(path)


def stored_key(spark: SparkSession, path: str) -> Column:
    """The key under ``path`` as a scalar subquery: plans and event logs show where it is, not what it is."""
    return spark.read.schema("key binary").parquet(path).scalar()


def _key(key: bytes | Column) -> Column:
    return key if isinstance(key, Column) else F.lit(key)


def encrypt_column(c: Column, key: bytes | Column) -> Column:
    """AES-GCM encryption of a string (or of ``to_json`` of a struct), base64.

    A key given as bytes becomes a literal of the plan; see ``stored_key``.
    """
    return F.base64(F.aes_encrypt(c.cast("string"), _key(key), F.lit("GCM")))


def decrypt_column(c: Column, key: bytes | Column, strict: bool = True) -> Column:
    """The encrypted string; a changed token or another key fails the job, or gives null if not ``strict``."""
    opened = F.aes_decrypt if strict else F.try_aes_decrypt
    return opened(F.unbase64(c), _key(key), F.lit("GCM")).cast("string")


# --------------------------------------------------------------------------
# S19 audit log, P21 / P22 windows over it, P24 JSON
# --------------------------------------------------------------------------

def audit_events(events: DataFrame) -> DataFrame:
    """Security-log rows from an event table: type, user, details as JSON
    text, creation time (S19)."""
    return events.select(
        F.col("event_type"),
        F.col("user_id"),
        F.lit(None).cast("string").alias("ip_address"),
        F.to_json(F.struct(F.col("event_id"), F.col("value"), F.from_json("props", "map<string,string>").alias("props"))).alias("details"),
        as_ts("ts").alias("created_at"),
    )


def append_audit(log: DataFrame, path: str) -> None:
    """Append ``audit_events`` rows to the log under ``path`` (S19), one folder
    per day; rows of a day meet in few files, and a large day is split."""
    days = log.withColumn("created_date", F.to_date("created_at")).hint("rebalance", "created_date")
    days.write.mode("append").partitionBy("created_date").parquet(path)


def recent_errors(log: DataFrame, as_of: Column, hours: int = 1, ts_col: str = "ts", type_col: str = "event_type") -> DataFrame:
    """Error events of the last ``hours`` up to ``as_of``."""
    ts = as_ts(ts_col)
    lo = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    return log.where((F.col(type_col) == "error") & (ts >= lo) & (ts <= as_of))


def retain(log: DataFrame, as_of: Column, days: int = 90, ts_col: str = "ts") -> DataFrame:
    """Rows inside the retention window."""
    return log.where(as_ts(ts_col) >= as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def roles_overlap(df: DataFrame, key: str, role_col: str, wanted: list[str]) -> DataFrame:
    """Keys whose set of roles shares one with ``wanted`` (J7): the role set
    per key is distinct roles only, so it stays small."""
    sets = df.groupBy(key).agg(F.array_sort(F.collect_set(role_col)).alias("roles"))
    return sets.where(F.arrays_overlap(F.col("roles"), F.array(*[F.lit(r) for r in wanted])))


# --------------------------------------------------------------------------
# V12 account lockout
# --------------------------------------------------------------------------

LOCKOUT_SCHEMA = (
    "user_id bigint, event_id bigint, ts timestamp, outcome string, status string, "
    "failed_attempts bigint, locked_until timestamp"
)


def login_attempts(events: DataFrame, failure: str = "error", success: str = "signup") -> DataFrame:
    """Login attempts from an event table: one event type is a failure,
    another a success."""
    return events.where(F.col("event_type").isin(failure, success)).select(
        "user_id",
        "event_id",
        as_ts("ts").alias("ts"),
        F.when(F.col("event_type") == failure, "failure").otherwise("success").alias("outcome"),
    )


def lockout(attempts: DataFrame, max_failures: int = 5, lock_minutes: int = 15) -> DataFrame:
    """Login attempts of each user in time order under the lockout rule.

    The 5th failed attempt locks the account for 15 minutes; a success
    resets the counter and the lock; attempts while locked are rejected and
    do not count; the counter survives the end of a lock, so the next
    failure locks again. Attempts need a time; equal times go by event_id.

    A pause of 15 minutes ends any lock, so what a session (attempts without such a
    pause) does depends only on the counter at its start, and of that only on
    0, 1, .., 4 or more: its effect is a small transition table.

    1. Sessions are numbered with windows over (user, day) and over a user's days.
    2. Each session is reduced to its table: sessions, not users, are dealt to the
       tasks, which step many at once as arrays (``_lockout_fn``).
    3. Tables compose: a day's sessions (96 at most) to a table per day, the days of
       a user to the counter at each day's start, and back to each session's start.
    4. Sessions are stepped again from their real counter.

    So the attempts of one user spread over as many tasks as there are sessions and
    days. Only a session itself is handled in one task, as a stream of batches.
    """
    lock = int(lock_minutes) * 60_000_000
    numbered = staged(_sessions(attempts, lock), "sessions")
    dealt = numbered.repartition("user_id", "session").sortWithinPartitions("user_id", "session", "t", "event_id")
    kind = {f.name: f.dataType.simpleString() for f in numbered.schema.fields}
    starts = np.arange(max_failures, dtype=np.int64)
    tables = dealt.mapInArrow(
        session_task(["user_id", "session"], starts, max_failures, lock), f"user_id {kind['user_id']}, session long, reset array<boolean>, n array<long>"
    )
    entries = _entries(numbered, tables, max_failures)
    again = _beside(numbered, entries, "user_id", "session")
    again = again.repartition("user_id", "session").sortWithinPartitions("user_id", "session", "t", "event_id")
    return again.mapInArrow(session_task(["user_id", "session"], None, max_failures, lock), LOCKOUT_SCHEMA)


def _beside(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``a`` with the other columns of ``b`` where ``keys`` are equal, NULL equal to NULL."""
    b = b.withColumnsRenamed({k: f"__{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return a.join(b, cond).drop(*[f"__{k}" for k in keys])


def _sessions(attempts: DataFrame, lock: int) -> DataFrame:
    """Attempts with the number of their session within the user, and the day on which it begins."""
    a = attempts.where(F.col("ts").isNotNull()).select(
        "user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "outcome",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), (F.col("outcome") == "success").alias("success"),
    )
    a = a.withColumn("success", F.coalesce("success", F.lit(False))).withColumn("day", F.floor(F.col("t") / 86_400_000_000))
    by_user = Window.partitionBy("user_id").orderBy("day")
    by_day = Window.partitionBy("user_id", "day").orderBy("t", "event_id")
    days = a.groupBy("user_id", "day").agg(F.max("t").alias("last")).withColumn("before", F.lag("last").over(by_user)).drop("last")
    x = _beside(a, days, "user_id", "day")
    pause = F.col("t") - F.coalesce(F.lag("t").over(by_day), "before")
    x = x.withColumn("starts", F.coalesce(pause >= lock, F.lit(True)).cast("long"))
    x = x.withColumn("local", F.sum("starts").over(by_day)).drop("before")
    counts = x.groupBy("user_id", "day").agg(F.sum("starts").alias("n"))
    counts = counts.withColumn("offset", F.coalesce(F.sum("n").over(by_user.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    return _beside(x, counts, "user_id", "day").withColumn("session", F.col("offset") + F.col("local")).drop("local", "offset")


def _entries(numbered: DataFrame, tables: DataFrame, classes: int) -> DataFrame:
    """The counter at the start of each session: ``user_id, session, entry``."""
    first_day = numbered.where("starts = 1").select("user_id", "session", "day")
    placed = _beside(tables, first_day, "user_id", "session")
    # a day's sessions in order; what they do to each start is one table
    days = staged(
        placed.groupBy("user_id", "day").agg(F.array_sort(F.collect_list(F.struct("session", "reset", "n"))).alias("steps")), "session-days"
    )
    top = classes - 1
    step = f"""aggregate(steps, transform(sequence(0, {top}), k -> named_struct('reset', false, 'n', CAST(0 AS BIGINT))),
      (state, s) -> transform(state, (c, k) -> IF(
        s.reset[CAST(least(IF(c.reset, c.n, k + c.n), {top}) AS INT)],
        named_struct('reset', true, 'n', s.n[CAST(least(IF(c.reset, c.n, k + c.n), {top}) AS INT)]),
        named_struct('reset', c.reset, 'n', c.n + s.n[CAST(least(IF(c.reset, c.n, k + c.n), {top}) AS INT)]))))"""
    tables_of_days = days.select("user_id", "day", F.expr(step).alias("d")).select(
        "user_id", F.struct("day", F.col("d.reset").alias("reset"), F.col("d.n").alias("n")).alias("d")
    )
    users = tables_of_days.groupBy("user_id").agg(F.array_sort(F.collect_list("d")).alias("steps"))

    def running(name: str) -> str:
        """The counter before each step, from ``entry`` on."""
        after = f"IF(s.reset[CAST(least(state.now, {top}) AS INT)], 0, state.now) + s.n[CAST(least(state.now, {top}) AS INT)]"
        return f"""inline(aggregate(steps, named_struct('now', entry, 'out', CAST(array() AS ARRAY<STRUCT<{name}: BIGINT, entry: BIGINT>>)),
          (state, s) -> named_struct('now', {after}, 'out', array_append(state.out, named_struct('{name}', s.{name}, 'entry', state.now))),
          state -> state.out))"""

    by_day = users.withColumn("entry", F.lit(0).cast("bigint")).selectExpr("user_id", running("day"))
    joined = _beside(days, by_day, "user_id", "day").select("user_id", "steps", "entry")
    return joined.selectExpr("user_id", running("session"))
