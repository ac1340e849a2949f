"""Queries of the streaming jobs (S11 ingest, V12 lockout as a stream)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.plans.q_validators import v12_lockout as _batch_lockout  # noqa: F401  (same oracle)
from kiln.plans.registry import REGISTRY, query
from kiln.session import scratch_path
from kiln.sources import files
from kiln.sources.tables import read
from kiln.streaming import ingest
from kiln.streaming.lockout import lockout_stream

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _land_events(spark, sf_dir) -> str:
    """Write the event table as JSON-lines files: the stream's landing zone."""
    path = scratch_path(spark, f"events-landing-{uuid.uuid4().hex[:12]}")
    files.write_table(read(spark, sf_dir, "events"), path, "json")
    return path


def _run_to_parquet(stream, name: str):
    spark = stream.sparkSession
    out = scratch_path(spark, f"{name}-out-{uuid.uuid4().hex[:12]}")
    q = ingest.to_parquet(stream, out, f"{name}-{uuid.uuid4().hex[:12]}", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out)


@query("s11_json_stream_ingest", sql="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s11_json_stream_ingest(spark, sf_dir):
    """Events as JSON text records, streamed, decoded with ``from_json``
    and written by a Parquet sink; the sink holds the same rows as the table."""
    landing = _land_events(spark, sf_dir)
    decoded = ingest.decode_json(ingest.text_stream(spark, landing, max_files_per_trigger=2), "raw", EVENT_SCHEMA)
    return _run_to_parquet(decoded.drop("raw"), "s11")


@query("v12_lockout_stream", sql=REGISTRY["v12_lockout"].sql)
def v12_lockout_stream(spark, sf_dir):
    """The lockout rule as a stateful streaming operator over the event stream.

    The landed files may arrive in any order, so the watermark is delayed by the
    time that the log spans; a closing event long after the last one releases what waits.
    """
    events = read(spark, sf_dir, "events")
    first, last = events.select(F.min("ts"), F.max("ts")).first()
    landing = scratch_path(spark, f"events-landing-{uuid.uuid4().hex[:12]}")
    files.write_table(events.repartition(8), landing, "json")
    if last is not None:
        span = int((last - first).total_seconds()) + 1
        closing = events.limit(1).withColumns({"user_id": F.lit(-1).cast("bigint"), "event_type": F.lit("error"), "ts": (F.lit(last) + F.make_dt_interval(secs=F.lit(2 * span))).cast(events.schema["ts"].dataType)})
        files.write_table(closing, landing, "json", mode="append")
    ev = ingest.decode_json(ingest.text_stream(spark, landing, max_files_per_trigger=3), "raw", EVENT_SCHEMA)
    attempts = ev.where(F.col("event_type").isin("error", "signup")).select(
        "user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("outcome"),
    )
    return _run_to_parquet(lockout_stream(attempts, delay=f"{span if last is not None else 1} seconds"), "v12")
