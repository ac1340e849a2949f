"""JSON stream ingestion (S11) with Structured Streaming.

The reference polls a stream shard for at most 1000 records per call,
from the latest position or a chosen one, and decodes each record from
JSON. Here:

* a file landing zone is read with ``readStream.json`` (schema given,
  ``maxFilesPerTrigger`` bounds a micro-batch, ``latestFirst`` starts from
  the newest files); a message bus is read with the Kafka source
  (``startingOffsets`` latest / earliest / JSON offsets, and
  ``maxOffsetsPerTrigger`` as the per-trigger record limit) when its
  connector is on the class path;
* records are decoded with ``from_json``;
* the sink is Parquet with its checkpoint under the shared checkpoint
  folder, so a restarted job resumes exactly where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kiln.session import checkpoint_dir


def json_file_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    max_files_per_trigger: int | None = None,
    latest_first: bool = False,
) -> DataFrame:
    """Streaming DataFrame of JSON-lines files arriving under ``path``."""
    r = spark.readStream.schema(schema).option("latestFirst", str(latest_first).lower())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.json(path)


def kafka_json_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Records of a Kafka topic decoded from JSON (needs the Kafka connector)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        raw = raw.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    raw = raw.load()
    return decode_json(raw.select(F.col("value").cast("string").alias("value"), "partition", "offset"), "value", schema)


def decode_json(df: DataFrame, col: str, schema: str, options: dict | None = None) -> DataFrame:
    """``from_json`` of a text column; undecodable records give NULL fields."""
    opts = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", **(options or {})}
    rec = F.from_json(F.col(col), schema, opts).alias("record")
    return df.select("*", rec).select("*", "record.*").drop("record")


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw records (one JSON text per line) arriving under ``path``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path).withColumnRenamed("value", "raw")


def to_parquet(stream: DataFrame, path: str, name: str, available_now: bool = True,
               output_mode: str = "append") -> StreamingQuery:
    """Start a Parquet sink with its checkpoint in the shared checkpoint folder."""
    ckpt = os.path.join(checkpoint_dir(stream.sparkSession), "streams", name)
    w = stream.writeStream.format("parquet").option("checkpointLocation", ckpt).option("path", path)
    w = w.outputMode(output_mode)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
