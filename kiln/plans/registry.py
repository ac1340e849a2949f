"""Registry of named queries: a Spark plan and its DuckDB oracle statement.

Each entry is keyed by the operator ID of the survey (``a1_...``), takes
``(spark, sf_dir)`` and reads the driver tables -- so its work grows with
them. The oracle is the same computation written as plain SQL over the same
tables. Doubles are rounded identically on both sides (``rounding``), and
``+ 0.0`` folds a negative zero, so value hashes compare.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    rounding: dict[str, int] = field(default_factory=dict)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        # Results are defined in UTC whatever session the caller brings.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = self.build(spark, sf_dir)
        # Zone-free timestamps in results (UTC wall clock), like the oracle's.
        ts_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
        if ts_cols:
            df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ts_cols})
        if self.rounding:
            df = df.withColumns({c: F.round(F.col(c), d) + F.lit(0.0) for c, d in self.rounding.items()})
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.rounding:
            return self.sql
        repl = ", ".join(f"round({c}, {d}) + 0.0 AS {c}" for c, d in self.rounding.items())
        return f"SELECT * REPLACE ({repl}) FROM (\n{self.sql}\n) AS q"


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, rounding: dict[str, int] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, dict(rounding or {}))
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every query module and return the registry."""
    from kiln.plans import (  # noqa: F401
        q_features,
        q_injected,
        q_models,
        q_prep,
        q_quality,
        q_run,
        q_sources,
        q_streaming,
        q_text,
        q_timeseries,
        q_validators,
    )

    return REGISTRY
