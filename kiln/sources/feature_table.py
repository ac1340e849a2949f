"""Feature table: definition, append and latest-record lookup.

A ``FeatureGroup`` is a Parquet table of the session catalog, partitioned by
ingestion date and bucketed and sorted by record id. Records keep the original
layout -- a map of feature name to value-as-text with missing values left
out. Definition, append and lookup share the one schema of the group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from kiln.sources.catalog import ensure_database
from kiln.sources.files import _fs


@dataclass(frozen=True)
class FeatureGroup:
    """A feature group: its definition (S14), appends (S13) and lookups.

    ``features`` names the features and their types (DDL), the record id and the
    event time among them; ``location`` is the folder of the table. The catalog
    table holds ``record_id, event_time, record, ingest_date``.

    * An append with a column that is no declared feature, or without the record id,
      raises ``ValueError``; declared features may be absent (their values are missing).
    * Rows without a record id are refused by ``append`` (they could never be found).
    """

    name: str
    record_id: str
    event_time: str
    features: str
    location: str
    database: str = "default"
    buckets: int = 64

    @property
    def table(self) -> str:
        return f"`{self.database}`.`{self.name}`"

    @property
    def declared(self) -> StructType:
        return StructType.fromDDL(self.features)

    def create(self, spark: SparkSession) -> None:
        """Define the group in the catalog; days already stored at the location are found again."""
        missing = {self.record_id, self.event_time} - set(self.declared.names)
        if missing:
            raise ValueError(f"{self.name}: no type declared for {sorted(missing)}")
        if spark.catalog.tableExists(self.table):
            return
        ensure_database(spark, self.database)
        id_type = self.declared[self.record_id].dataType.simpleString()
        path = self.location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.table} (record_id {id_type}, event_time TIMESTAMP, record MAP<STRING, STRING>, ingest_date DATE) "
            f"USING parquet PARTITIONED BY (ingest_date) "
            f"CLUSTERED BY (record_id) SORTED BY (record_id) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        fs, folder = _fs(spark, self.location)
        fs.mkdirs(folder)
        spark.catalog.recoverPartitions(self.table)

    def append(self, df: DataFrame, event_time: Column | None = None) -> None:
        """Append the rows of ``df`` as records under the day of their event time.

        Rebalanced by (day, bucket): a bucket of a day is written by one task, or
        by several if one id makes it large (AQE splits it), so an append writes
        about as many files a day as there are buckets with records.
        """
        unknown = sorted(set(df.columns) - set(self.declared.names))
        if unknown or self.record_id not in df.columns:
            raise ValueError(f"{self.name}: undeclared features {unknown}, record id {self.record_id!r} expected")
        types = {f.name: f.dataType for f in self.declared}
        typed = df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in df.columns])
        records = feature_records(typed, self.record_id, event_time, self.event_time)
        dated = records.select(
            F.coalesce("record_id", F.raise_error(F.lit(f"{self.name}: a record without an id"))).alias("record_id"),
            F.col("event_time").cast("timestamp").alias("event_time"),
            "record",
            F.to_date("event_time").alias("ingest_date"),
        )
        bucketed = dated.withColumn("bucket", F.pmod(F.hash("record_id"), F.lit(self.buckets)))
        bucketed.hint("rebalance", "ingest_date", "bucket").drop("bucket").write.insertInto(self.table)

    def records(self, spark: SparkSession) -> DataFrame:
        """All records, through the catalog: a filter on the id reads one bucket."""
        return spark.table(self.table)

    def latest(self, spark: SparkSession) -> DataFrame:
        """The newest record of every id.

        Read as plain files: a scan by buckets would give a bucket, with a hot id's
        whole history, to one task.
        """
        return latest_records(spark.read.schema(self.records(spark).schema).parquet(self.location))

    def get(self, spark: SparkSession, record_id) -> DataFrame:
        """The newest record of one id."""
        return get_record(self.records(spark), record_id)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The newest record of every id in the one column of ``keys`` that has any."""
        key = keys.select(F.col(f"`{keys.columns[0]}`").alias("record_id"))
        stored = keys.sparkSession.read.schema(self.records(keys.sparkSession).schema).parquet(self.location)
        return latest_records(stored.join(key, "record_id", "left_semi"))

    def typed(self, records: DataFrame) -> DataFrame:
        """Records as columns of the declared types; a feature that a record lacks is null."""
        return records.select(*[F.col("record")[f.name].cast(f.dataType).alias(f.name) for f in self.declared])


def _text(c: str, dtype) -> Column:
    col = F.col(f"`{c}`")
    if isinstance(dtype, (DoubleType, FloatType)):
        col = F.nanvl(col, F.lit(None).cast("double"))
    return col.cast("string")


def feature_records(df: DataFrame, record_id: str, event_time: Column | None = None, event_time_col: str = "event_time") -> DataFrame:
    """One record per row (S13): ``record_id``, ``event_time`` (defaulted
    to the given time when the frame has none) and ``record`` = map of
    feature name -> value as text, missing values omitted."""
    out = df
    if event_time_col not in df.columns:
        if event_time is None:
            event_time = F.current_timestamp()
        out = out.withColumn(event_time_col, event_time.cast("timestamp"))
    types = {f.name: f.dataType for f in out.schema.fields}
    entries = F.array(*[F.struct(F.lit(c).alias("key"), _text(c, types[c]).alias("value")) for c in out.columns])
    record = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return out.select(F.col(record_id).alias("record_id"), F.col(event_time_col).alias("event_time"), record.alias("record"))


def latest_records(records: DataFrame) -> DataFrame:
    """The newest record of every id (S15): ``max_by`` over event time -- a
    partial/final aggregate, so a hot id never gathers its history in one
    place. Of records with one event time the largest (as JSON) counts."""
    return records.groupBy("record_id").agg(
        F.max_by(F.struct("event_time", "record"), F.struct("event_time", F.to_json("record"))).alias("r")
    ).select("record_id", "r.event_time", "r.record")


def get_record(records: DataFrame, record_id) -> DataFrame:
    """The newest record of one id."""
    return latest_records(records.where(F.col("record_id") == F.lit(record_id)))
