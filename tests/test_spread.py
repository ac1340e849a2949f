"""A large file of one row group is not read and worked on by one task."""

import uuid

from pyspark.sql import functions as F

from kiln.session import scratch_path
from kiln.sources.tables import read


def test_rows_of_one_row_group_are_spread(spark):
    at = scratch_path(spark, f"one-group-{uuid.uuid4().hex[:8]}")
    rows = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    rows.coalesce(1).write.option("parquet.block.size", 1 << 30).parquet(f"{at}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        df = read(spark, at, "documents")
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert spark.read.parquet(f"{at}/documents.parquet").rdd.getNumPartitions() >= cores
        assert len(sizes) >= cores and max(sizes) < 2 * 4000 / cores and sum(sizes) == 4000
        assert df.agg(F.sum("id")).first()[0] == 3999 * 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
