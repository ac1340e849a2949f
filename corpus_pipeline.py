"""The corpus pipeline: documents to token ids in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all of ``docs`` and
returns a DataFrame; all but the last return the columns of ``documents``.
The dedup stages act on rows: of rows that repeat each other whole one stays, a
row without a doc_id counts as larger than all with one, and a doc_id that
stands beside several texts names each of them apart.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kiln.llm import bpe, exact_dedup, mixing, simhash  # noqa: E402
from kiln.llm.common import keep  # noqa: E402
from kiln.llm.components import connected_components  # noqa: E402
from kiln.llm.queries import byte_bpe, table  # noqa: E402
from kiln.llm.toxicity import toxicity as score_toxicity  # noqa: E402

#: Fingerprints of op9_simhash: shingle length and largest bit distance.
SHINGLE, RADIUS = 3, 3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier chain finds toxic."""
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where(~F.col("toxic")).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of equal texts: the smallest doc_id (null last), then the smallest other columns."""
    found = exact_dedup.exact_duplicates(docs)
    rows = found.groupBy("doc_id", "text_sha256").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    marked = keep(
        rows.where("NOT kept OR n > 1").select(F.col("doc_id").alias("copy_id"), F.col("text_sha256").alias("copy_sha"), "kept"), "copies"
    )
    sha = F.sha2(exact_dedup.normalised(docs["text"]), 256)
    same = docs["doc_id"].eqNullSafe(marked["copy_id"]) & (sha == marked["copy_sha"])
    repeated = docs.join(marked.where("kept"), same).groupBy("copy_sha").agg(F.min(F.struct(*[docs[c] for c in docs.columns])).alias("row"))
    return docs.join(marked, same, "left_anti").unionByName(repeated.select("row.*"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id (null last) of each SimHash component.

    Fingerprints are the nodes and rows are named by (doc_id, text digest), so
    texts that share a doc_id are linked and dropped apart.
    """
    sha = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", sha.alias("sha")).alias("id"), "text")
    fps = keep(simhash.fingerprints(named, "id", "text", SHINGLE), "fingerprints")
    distinct = keep(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    component = connected_components(simhash.fingerprint_links(distinct.select("fp", F.col("fp").alias("rep")), RADIUS))
    groups = keep(
        distinct.join(component, distinct["fp"] == component["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component")),
        "groups",
    )
    owners = groups.groupBy("component").agg(F.min("least").alias("owner"))
    copies = fps.join(groups.join(owners, "component").select("fp", "owner"), "fp").where("id <> owner")
    copies = copies.select(F.col("id.doc_id").alias("copy_id"), F.col("id.sha").alias("copy_sha")).distinct()
    return docs.join(copies, docs["doc_id"].eqNullSafe(copies["copy_id"]) & (sha == copies["copy_sha"]), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Use each document as often as the mix takes it (not at all, once or twice)."""
    # a row without a doc_id is named by its text
    name = F.coalesce("doc_id", -1 - F.xxhash64(F.lit("unnamed"), F.col("text")).bitwiseAND(F.lit((1 << 63) - 1)))
    uses, _ = mixing.mix_documents(docs.withColumn("doc_id", name))
    uses = uses.groupBy(F.col("doc_id").alias("used_id")).agg(F.max("uses").cast("int").alias("used"))
    taken = docs.join(uses, name == uses["used_id"], "left").withColumn("used", F.coalesce("used", F.lit(1)))
    return taken.withColumn("used", F.explode(F.array_repeat(F.lit(0), F.col("used")))).select(*[docs[c] for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts, with a check that they decode to the text."""
    ids = bpe.encode(docs, byte_bpe(), check_col="round_trip")
    return ids.select(
        *[c for c in docs.columns if c != "text"], F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip"
    )


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mixing", mix),
    ("bpe", encode),
]

#: Fitted models, fingerprints and BPE have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
