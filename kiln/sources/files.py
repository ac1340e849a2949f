"""File sources and sinks.

All reads are ``spark.read`` with an explicit schema where one is known
(inference only on request), so projection and filters push into the scan;
all writes are partitioned DataFrame writes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SUPPORTED_FORMATS = ("csv", "parquet", "json")

# Text formats keep microseconds (the writers' default stops at milliseconds).
TEXT_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Hadoop file-system existence check (works for any scheme)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def has_files(spark: SparkSession, path: str, suffix: str | None = None) -> bool:
    """True when ``path`` holds at least one (matching) data file."""
    if not path_exists(spark, path):
        return False
    fs, p = _fs(spark, path)
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if suffix is None or name.endswith(suffix):
            return True
    return False


def _has_partitions(spark: SparkSession, path: str) -> bool:
    """True when a folder right under ``path`` is named ``column=value``."""
    fs, p = _fs(spark, path)
    return fs.isDirectory(p) and any(f.isDirectory() and "=" in f.getPath().getName() for f in fs.listStatus(p))


def require_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    """Fail fast before a run when an input is missing or an empty folder."""
    missing = [p for p in paths if not has_files(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing inputs: {missing}")


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    infer: bool = False,
    recursive: bool | None = None,
    merge: bool = False,
) -> DataFrame:
    """Read every ``fmt`` file under ``path``.

    * unsupported formats raise ``ValueError`` before any read (S4);
    * only files with the format's suffix are read (``pathGlobFilter``),
      directory markers and hidden files are skipped (S5);
    * a missing or empty prefix gives an empty frame with ``schema`` (S6); if
      only some of several prefixes are missing or empty, that is an error;
    * files are combined by column name; ``merge`` also unites differing Parquet
      schemas (S7), which reads the footer of every file;
    * folders named ``column=value`` give columns that filters prune by (S10);
      other nested folders are read through. ``recursive`` decides otherwise: true
      takes all files without such columns.
    """
    fmt = fmt.lower()
    if fmt not in SUPPORTED_FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    paths = [path] if isinstance(path, str) else list(path)
    live = [p for p in paths if has_files(spark, p, f".{fmt}")]
    if not live:
        if schema is None:
            return spark.createDataFrame([], StructType([]))
        return spark.createDataFrame([], schema)
    if len(live) < len(paths):
        raise FileNotFoundError(f"no {fmt} files under {sorted(set(paths) - set(live))}")
    if recursive is None:
        recursive = not any(_has_partitions(spark, p) for p in live)
    r = spark.read.option("pathGlobFilter", f"*.{fmt}").option("recursiveFileLookup", str(recursive).lower())
    if schema is not None:
        r = r.schema(schema)
    if fmt in ("csv", "json"):
        r = r.options(**TEXT_TIME_OPTIONS)
    if fmt == "csv":
        r = r.option("header", "true").option("inferSchema", str(infer and schema is None).lower())
        return r.csv(live)
    if fmt == "json":
        return r.json(live)
    return r.option("mergeSchema", str(merge and schema is None).lower()).parquet(*live)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; absent columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """Write a table (S9, S10, S21): CSV with a header, JSON lines or
    Parquet, optionally Hive-partitioned."""
    fmt = fmt.lower()
    if fmt not in SUPPORTED_FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(**TEXT_TIME_OPTIONS).option("header", "true").csv(path)
    elif fmt == "json":
        w.options(**TEXT_TIME_OPTIONS).json(path)
    else:
        w.parquet(path)


def write_by_month(df: DataFrame, path: str, ts_col: str, mode: str = "overwrite") -> None:
    """``year=/month=`` partitioned Parquet layout of a dated table.

    The data is rebalanced by the partition columns first: each task writes
    few partition directories, and AQE splits a month beyond the advisory
    partition size over several tasks.
    """
    part = df.withColumns({"year": F.year(ts_col), "month": F.month(ts_col)})
    part.hint("rebalance", "year", "month").write.mode(mode).partitionBy("year", "month").parquet(path)


def storage_inventory(spark: SparkSession, root: str, expected: Sequence[str] = ()) -> DataFrame:
    """Files, bytes and last modification per top-level prefix under
    ``root`` (S16), plus whether each expected prefix holds files.

    ``binaryFile`` with only metadata columns selected never reads content.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select("path", "length", "modificationTime")
    )
    root_uri = root.rstrip("/")
    rel = F.regexp_replace(F.col("path"), r"^.*?" + root_uri.replace(".", r"\.") + "/?", "")
    prefix = F.regexp_extract(rel, r"^([^/.]+)", 1)
    inv = files.groupBy(prefix.alias("prefix")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("last_modified")
    )
    if expected:
        want = spark.createDataFrame([(e,) for e in expected], "prefix string")
        inv = want.join(inv, "prefix", "full").withColumn("expected", F.col("prefix").isin(*expected))
    return inv


def stored_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Per file-based table: ``prefix, rows, largest_file_rows``.

    Counted by file from the scan's metadata; no column is read (of Parquet only
    footers are). A table without rows has 0 and 0.
    """
    counts = None
    for name, df in tables.items():
        by_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
        one = by_file.agg(
            F.lit(name).alias("prefix"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.max("n"), F.lit(0)).alias("largest_file_rows"),
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts
