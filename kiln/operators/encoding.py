"""Categorical encoders with fit / transform semantics.

``fit`` builds a dictionary from ``distinct`` (a shuffle of the distinct
values only, combined map-side) and writes it to the checkpoint folder;
``transform`` joins it, whatever its size. AQE picks the join from measured
bytes: a small dictionary is broadcast, a skewed value of a large one is split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import cut_lineage


def _dictionary(df: DataFrame, col: str, partitions: int | None = None) -> DataFrame:
    """Sorted distinct non-NULL values with their 0-based rank.

    Distributed sorted rank: the distinct values are range-partitioned
    (sampled boundaries, so partitions are balanced), each partition ranks
    its own values, and each partition's offset is the sum of the sizes of
    the partitions before it (a table of one row per partition). No window
    ever sees the whole dictionary.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # checkpointed: both branches below must see the same partition ids
    d = cut_lineage(
        df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct()
        .repartitionByRange(n_parts, "value")
        .withColumn("__p", F.spark_partition_id())
    )
    local = d.withColumn("__r", F.row_number().over(Window.partitionBy("__p").orderBy("value")) - 1)
    sizes = d.groupBy("__p").agg(F.count("*").alias("__n"))
    offsets = sizes.withColumn(
        "__off", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("__p", "__off")
    return local.join(F.broadcast(offsets), "__p").select(
        "value", (F.col("__off") + F.col("__r")).cast("bigint").alias("index")
    )


def _joined(df: DataFrame, col: str, out: str, right: DataFrame, value: str) -> DataFrame:
    """``df`` with ``value`` of the row of ``right`` whose ``value`` column
    equals ``col`` as ``out``; NULL where there is none."""
    right = right.select(F.col("value").alias("__v"), F.col(value).alias("__out"))
    found = df.drop(out).join(right, F.col(col) == F.col("__v"), "left").withColumn(out, F.col("__out"))
    return found.drop("__v", "__out")


@dataclass
class LabelEncoderModel:
    input_col: str
    output_col: str
    frame: DataFrame

    @property
    def labels(self) -> list:
        """All values in index order; reads the whole dictionary into the
        driver, for callers that want it as a list (``frame`` holds it else)."""
        return [r["value"] for r in self.frame.orderBy("index").collect()]

    def transform(self, df: DataFrame) -> DataFrame:
        """Index of each value in the sorted dictionary; unseen -> NULL."""
        return _joined(df, self.input_col, self.output_col, self.frame, "index")


@dataclass
class LabelEncoder:
    """0-based rank among the sorted distinct values."""

    input_col: str
    output_col: str

    def fit(self, df: DataFrame) -> LabelEncoderModel:
        return LabelEncoderModel(self.input_col, self.output_col, cut_lineage(_dictionary(df, self.input_col)))


@dataclass
class OneHotEncoderModel:
    input_col: str
    prefix: str
    values: list

    def transform(self, df: DataFrame) -> DataFrame:
        """One ``<prefix>_<value>`` 0/1 column per fitted value; an unseen or
        missing value gives all zeros (``handle_unknown='ignore'``)."""
        c = F.col(self.input_col)
        return df.withColumns(
            {f"{self.prefix}_{v}": F.coalesce((c == F.lit(v)).cast("bigint"), F.lit(0).cast("bigint")) for v in self.values}
        )


@dataclass
class OneHotEncoder:
    """Dummy columns for every category, none dropped (F8).

    ``layout`` is the caller's choice: ``columns`` gives one 0/1 column per
    category, so the schema grows with them (beyond ``max_categories`` it is an
    error, and no category is dropped); ``sparse`` gives one column
    ``<prefix>_index``, the place of the row's 1 among the sorted categories
    (NULL: all zeros), and keeps the dictionary on the cluster.
    """

    input_col: str
    prefix: str | None = None
    layout: str = "columns"
    max_categories: int = 10_000

    def fit(self, df: DataFrame) -> OneHotEncoderModel | LabelEncoderModel:
        prefix = self.prefix or self.input_col
        if self.layout == "sparse":
            return LabelEncoder(self.input_col, f"{prefix}_index").fit(df)
        if self.layout != "columns":
            raise ValueError(f"Unknown one-hot layout: {self.layout}")
        # one category more than allowed tells that there are too many; no more reach the driver
        values = df.select(self.input_col).where(F.col(self.input_col).isNotNull()).distinct().limit(self.max_categories + 1).collect()
        if len(values) > self.max_categories:
            raise ValueError(f"{self.input_col} has over {self.max_categories} categories: use layout='sparse'")
        return OneHotEncoderModel(self.input_col, prefix, sorted(r[0] for r in values))


@dataclass
class TargetEncoderModel:
    input_col: str
    output_col: str
    prior: float
    stats: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """Smoothed category mean; unseen or missing category -> prior."""
        out = _joined(df, self.input_col, self.output_col, self.stats, "enc")
        return out.withColumn(self.output_col, F.coalesce(self.output_col, F.lit(self.prior)))


@dataclass
class TargetEncoder:
    """Smoothed target mean per category.

    Public definition of the library default (min_samples_leaf=20,
    smoothing=10): ``w = 1 / (1 + exp(-(n - 20) / 10))``,
    ``enc = prior * (1 - w) + mean * w``; a category seen once gets the
    prior. ``prior`` is the global target mean.
    """

    input_col: str
    target_col: str
    output_col: str | None = None
    min_samples_leaf: float = 20.0
    smoothing: float = 10.0

    def fit(self, df: DataFrame) -> TargetEncoderModel:
        prior = df.agg(F.avg(self.target_col)).collect()[0][0]
        stats = df.where(F.col(self.input_col).isNotNull()).groupBy(F.col(self.input_col).alias("value")).agg(
            F.count(self.target_col).alias("n"), F.avg(self.target_col).alias("mean")
        )
        w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("n") - F.lit(self.min_samples_leaf)) / F.lit(self.smoothing)))
        enc = F.when(F.col("n") == 1, F.lit(prior)).otherwise(F.lit(prior) * (F.lit(1.0) - w) + F.col("mean") * w)
        stats = cut_lineage(stats.select("value", enc.cast("double").alias("enc")))
        return TargetEncoderModel(self.input_col, self.output_col or f"{self.input_col}_target", prior, stats)


@dataclass
class BinaryEncoderModel:
    input_col: str
    prefix: str
    n_bits: int
    frame: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """Base-2 digits of the 1-based ordinal, most significant first,
        as ``<prefix>_0 .. <prefix>_{k-1}``; unseen / missing -> all zeros."""
        out = _joined(df, self.input_col, "__ord", self.frame, "index")
        o = F.coalesce(F.col("__ord") + 1, F.lit(0))
        digits = {
            f"{self.prefix}_{i}": F.shiftright(o, self.n_bits - 1 - i).bitwiseAND(F.lit(1)).cast("bigint")
            for i in range(self.n_bits)
        }
        return out.withColumns(digits).drop("__ord")


@dataclass
class BinaryEncoder:
    """Ordinal (1-based, in sorted value order) written as binary digit
    columns (F10). A table has no order of first appearance, so the
    dictionary is ordered by value."""

    input_col: str
    prefix: str | None = None

    def fit(self, df: DataFrame) -> BinaryEncoderModel:
        frame = cut_lineage(_dictionary(df, self.input_col))
        n_bits = max(1, frame.count().bit_length())
        return BinaryEncoderModel(self.input_col, self.prefix or self.input_col, n_bits, frame)


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Count (or share) of each non-missing value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    if not normalize:
        return counts
    total = df.where(F.col(col).isNotNull()).select(F.count("*")).scalar()
    return counts.withColumn("proportion", F.col("count") / total)


def distinct_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """``drop_duplicates`` of the listed columns."""
    return df.select(*cols).distinct()
