"""Bag of words and TF-IDF over *every* term of a corpus (F13, F14, W6 without a limit).

Without ``max_features`` the vocabulary grows with the corpus, so it is a table:

1. rows are dealt by a row number (rows may share an id), so their texts are
   shuffled, never their terms; counts by (row, term) need no other shuffle and are
   written. One aggregate of them gives corpus totals and document frequencies;
2. the alphabetical index of a term is its place in a sorted range partition plus
   the sizes of the partitions before it: no window over the vocabulary, no join;
3. a transform joins counts to the vocabulary on the term. AQE broadcasts a small
   vocabulary and splits a term that most rows hold. Counts of the fitted rows hold
   no other terms and are not joined.

Norms are windows over one row's distinct terms. Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.text_features import TOKEN_PATTERN, explode_terms, with_terms
from kiln.session import staged


def ranked_terms(totals: DataFrame) -> DataFrame:
    """All terms with their alphabetical ``index`` (W6 without a limit): ``term, .., index``."""
    totals = staged(totals, "term-totals")
    parts = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the number holds the partition in its upper bits and the place in it below
    placed = totals.repartitionByRange(parts, "term").sortWithinPartitions("term").withColumn("__at", F.monotonically_increasing_id())
    placed = staged(placed, "term-places").withColumn("__p", F.shiftright("__at", 33))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__p").agg(F.count("*").alias("__n"))  # a row per partition
    offsets = sizes.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "__p").select(*totals.columns, (F.col("__off") + place).cast("bigint").alias("index"))


@dataclass
class TermTable:
    """A vocabulary on the cluster: ``vocabulary(term, total, df, index)``; ``n_docs`` weighs terms, None counts them."""

    id_col: str
    text_col: str
    ngram_max: int
    stop_words: tuple | None
    pattern: str
    vocabulary: DataFrame
    n_docs: int | None

    def entries(self, counts: DataFrame) -> DataFrame:
        """``__row, id, term, index, count | weight`` of counts by row."""
        found = counts.join(self.vocabulary.select("term", "index", "df"), "term")
        keys = ["__row", self.id_col, "term", "index"]
        if self.n_docs is None:
            return found.select(*keys, F.col("tf").alias("count"))
        idf = F.log(F.lit(float(1 + self.n_docs)) / (1 + F.col("df"))) + 1.0
        found = found.withColumn("w", F.col("tf") * idf)
        norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("__row")))
        return found.select(*keys, (F.col("w") / norm).alias("weight"))

    def transform(self, df: DataFrame) -> DataFrame:
        """Long form ``id, term, count | weight``; terms not seen in the fit are left out."""
        e = self.entries(row_counts(df, self))
        return e.select(self.id_col, "term", e.columns[-1])

    def transform_sparse(self, df: DataFrame) -> DataFrame:
        """One row per row of ``df``: ``id, size, indices, values``, sorted by index (empty arrays without known terms)."""
        terms = row_terms(df, self)
        e = self.entries(count_terms(terms, self.id_col))
        pairs = F.array_sort(F.collect_list(F.struct("index", F.col(e.columns[-1]).cast("double").alias("value"))))
        vectors = e.groupBy("__row").agg(pairs.alias("v"))
        return terms.select("__row", self.id_col).join(vectors, "__row", "left").select(
            self.id_col,
            F.lit(self.vocabulary.count()).alias("size"),
            F.coalesce("v.index", F.array().cast("array<bigint>")).alias("indices"),
            F.coalesce("v.value", F.array().cast("array<double>")).alias("values"),
        )


def numbered_terms(df: DataFrame, by) -> DataFrame:
    """``__row, id, __terms`` of every row, dealt by the row number."""
    rows = df.select(F.col(by.id_col), F.col(by.text_col).alias("__text")).withColumn("__row", F.monotonically_increasing_id())
    return with_terms(rows.repartition("__row"), "__text", "__terms", by.ngram_max, by.stop_words, by.pattern).drop("__text")


def row_terms(df: DataFrame, by) -> DataFrame:
    """``__row, id, __terms`` of every row, written so that the row number holds."""
    return staged(numbered_terms(df, by), "row-terms")


def count_terms(terms: DataFrame, id_col: str) -> DataFrame:
    """``__row, id, term, tf``, written: the terms of one row sit in one partition."""
    each = terms.select("__row", id_col, explode_terms("__terms")).where(F.col("term").isNotNull())
    return staged(each.groupBy("__row", id_col, "term").agg(F.count("*").alias("tf")), "term-counts")


def row_counts(df: DataFrame, by) -> DataFrame:
    return count_terms(numbered_terms(df, by), by.id_col)


@dataclass
class TermTableVectorizer:
    """Fits a ``TermTable``: bag of words, or TF-IDF with the smoothed idf and normalised rows (``tfidf=True``).

    A null text has no terms but counts as a document; an empty table gives an
    empty vocabulary.
    """

    text_col: str
    id_col: str
    ngram_max: int = 1
    tfidf: bool = False
    stop_words: tuple | None = None
    pattern: str = TOKEN_PATTERN

    def _fit(self, counts: DataFrame, df: DataFrame) -> TermTable:
        totals = counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df"))
        vocabulary = staged(ranked_terms(totals), "vocabulary")
        n_docs = df.count() if self.tfidf else None
        return TermTable(self.id_col, self.text_col, self.ngram_max, self.stop_words, self.pattern, vocabulary, n_docs)

    def fit(self, df: DataFrame) -> TermTable:
        return self._fit(row_counts(df, self), df)

    def fit_transform(self, df: DataFrame) -> tuple[TermTable, DataFrame]:
        """Fit and transform the same rows; their counts are made once."""
        counts = row_counts(df, self)
        model = self._fit(counts, df)
        if not self.tfidf:
            return model, counts.select(self.id_col, "term", F.col("tf").alias("count"))
        return model, model.entries(counts).select(self.id_col, "term", "weight")
