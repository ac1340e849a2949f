"""Catalog operations (S14, S17, S18, S22) and parametrised SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from kiln.sources.files import _fs, has_files


def ensure_database(spark: SparkSession, name: str, properties: dict[str, str] | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` and tag it."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    if properties:
        quoted = lambda s: "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"
        props = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER DATABASE `{name}` SET DBPROPERTIES ({props})")


def database_properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED `{name}`").collect()
    out = {}
    for r in rows:
        if r[0] == "Properties" and r[1]:
            body = r[1].strip("()")
            for part in body.split("), ("):
                part = part.strip("()")
                if "," in part:
                    k, v = part.split(",", 1)
                    out[k.strip()] = v.strip()
    return out


def catalog_check(spark: SparkSession, database: str, tables: Sequence[str]) -> list[dict]:
    """Per expected table (S17): exists, column count, partition-key count
    and the first five partitions."""
    out = []
    for t in tables:
        name = f"{database}.{t}"
        if not spark.catalog.tableExists(name):
            out.append({"table": t, "exists": False})
            continue
        cols = spark.catalog.listColumns(f"{database}.{t}")
        keys = [c.name for c in cols if c.isPartition]
        parts = []
        if keys:
            parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").limit(5).collect()]
        out.append({"table": t, "exists": True, "columns": len(cols), "partition_keys": len(keys), "partitions": parts})
    return out


def _sub_folders(spark: SparkSession, root: str) -> list[str]:
    fs, p = _fs(spark, root)
    found = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()]
    return sorted(n for n in found if not n.startswith(("_", ".")))


def _is_external_at(spark: SparkSession, name: str, path: str) -> bool:
    """Whether the table only points at ``path``, so that dropping it deletes no data."""
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if about.get("Type") != "EXTERNAL":
        return False
    (fs, wanted), (_, given) = _fs(spark, path), _fs(spark, about["Location"])
    return fs.makeQualified(wanted).toString() == fs.makeQualified(given).toString()


def crawl(
    spark: SparkSession,
    database: str,
    root: str,
    tables: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> list[str]:
    """Register one external table per sub-folder of ``root`` (S18): ``tables``,
    or every sub-folder that holds a file of the format.

    Only files with the format's suffix are data files, so stray ``*.tmp``
    and ``*.log`` files are never read; the table schema (Parquet: merged over
    all files) and its partition columns are inferred from the files and
    folder layout, and partitions are recovered into the catalog. A table that
    exists already is registered anew only if it is external and at that path;
    any other raises ``ValueError``.
    """
    ensure_database(spark, database)
    root = root.rstrip("/")
    if tables is None:
        tables = [t for t in _sub_folders(spark, root) if has_files(spark, f"{root}/{t}", f".{fmt}")]
    made = []
    for t in tables:
        path = f"{root}/{t}"
        name = f"`{database}`.`{t}`"
        if spark.catalog.tableExists(f"{database}.{t}"):
            if not _is_external_at(spark, name, path):
                raise ValueError(f"{database}.{t} exists and is not an external table at {path}")
            spark.sql(f"DROP TABLE {name}")
        options = {"mergeSchema": "true"} if fmt == "parquet" else {}
        spark.catalog.createTable(f"{database}.{t}", path=path, source=fmt, pathGlobFilter=f"*.{fmt}", **options)
        cols = spark.catalog.listColumns(f"{database}.{t}")
        if any(c.isPartition for c in cols):
            spark.catalog.recoverPartitions(f"{database}.{t}")
        made.append(t)
    return made


def safe_query(spark: SparkSession, sql: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Parametrised SQL (S12): values are bound as ``:name`` parameters --
    never spliced into the text -- and DataFrames are referenced as
    ``{name}``."""
    return spark.sql(sql, args=params or {}, **frames)
