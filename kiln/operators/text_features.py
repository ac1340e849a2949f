"""Bag of words and TF-IDF with fit / transform semantics.

The corpus never leaves the cluster:

1. tokens per document: ``regexp_extract_all`` (two or more word
   characters, lower-cased), stop words dropped with a hashed ``IN`` set,
   bigrams of the remaining tokens with ``zip_with`` -- all row-local;
2. term counts per (document, term): explode + ``groupBy`` (combined
   map-side: the rows of one document sit in one partition);
3. vocabulary = the ``max_features`` most frequent terms of the corpus,
   ties alphabetical: a distributed top-k (``orderBy().limit()``), so only
   ``max_features`` terms reach the driver;
4. document frequency of the vocabulary terms: the vocabulary is a
   literal ``IN`` set of at most ``max_features`` entries;
5. weights ``tf * (ln((1 + n) / (1 + df)) + 1)`` L2-normalised per
   document with a per-document ``groupBy`` of the (sparse) weights.

Output is long and sparse: ``(id, term, weight)``; ``transform_wide``
pivots to ``tfidf_0 ..`` columns (the original dense layout) when asked.

A vocabulary without a limit is a table: see ``term_tables``.
"""

from __future__ import annotations

import glob
import os
import zipfile
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.text import tokens as _tokens
from kiln.session import cut_lineage
from kiln.session import staged as written

TOKEN_PATTERN = r"(?U)\b\w\w+\b"
TIES = 10  # words that reach the vocabulary's least total, per term of it, before bigrams are no longer pruned


@lru_cache(maxsize=None)
def english_stop_words() -> tuple[str, ...]:
    """The English stop-word list that ships with Spark ML
    (``StopWordsRemover.loadDefaultStopWords('english')``), read from the
    Spark ML jar so no session is needed."""
    import pyspark

    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    if jars:
        with zipfile.ZipFile(jars[0]) as z:
            words = z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode("utf-8").split()
        return tuple(words)
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def terms_column(text: Column, stop_words=None, ngram_max: int = 1, pattern: str = TOKEN_PATTERN) -> Column:
    """Array of unigrams (stop words removed) and, for ``ngram_max=2``, the
    bigrams of consecutive remaining tokens. For use on a *column* holding
    the text; ``with_terms`` stages the tokens so they are computed once."""
    stops = list(english_stop_words() if stop_words is None else stop_words)
    toks = _tokens(F.coalesce(text, F.lit("")), pattern)
    if stops:
        toks = F.filter(toks, lambda t: ~t.isin(*stops))
    if ngram_max == 1:
        return toks
    return F.concat(toks, bigrams(toks))


def bigrams(toks: Column) -> Column:
    """``a b`` for every pair of consecutive tokens."""
    head = F.slice(toks, 1, F.greatest(F.size(toks) - 1, F.lit(0)))
    return F.transform(head, lambda x, i: F.concat(x, F.lit(" "), F.element_at(toks, i + 2)))


def with_terms(df: DataFrame, text_col: str, out: str = "__terms", ngram_max: int = 1, stop_words=None,
               pattern: str = TOKEN_PATTERN) -> DataFrame:
    """Adds ``out`` (the term array) in two projections: the tokens are a
    column of their own, so the regular expression runs once per row even
    though the bigrams read the tokens several times (expressions inside
    higher-order functions are not shared otherwise)."""
    staged = df.withColumn("__tok", terms_column(F.col(text_col), stop_words, 1, pattern))
    if ngram_max == 1:
        return staged.withColumnRenamed("__tok", out)
    return staged.withColumn(out, F.concat(F.col("__tok"), bigrams(F.col("__tok")))).drop("__tok")


def explode_terms(arr) -> Column:
    """``explode_outer`` of a term array as column ``term`` -- callers drop the
    NULL row of empty arrays by grouping on non-NULL terms. A plain explode
    lets the optimizer infer a ``size(array) > 0`` filter and push it below
    the staged projections, which re-runs the tokenisation per element."""
    return F.explode_outer(arr).alias("term")


def corpus_totals(df: DataFrame, text_col: str, ngram_max: int = 1, stop_words=None,
                  pattern: str = TOKEN_PATTERN) -> DataFrame:
    """``(term, total)``: corpus frequency of every term, combined map-side."""
    # stop words of single terms are dropped as rows; bigrams need them gone before
    stops = list(english_stop_words() if stop_words is None else stop_words) if ngram_max == 1 else []
    kept = () if ngram_max == 1 else stop_words
    staged = with_terms(df.select(F.col(text_col).alias("__text")), "__text", "__terms", ngram_max, kept, pattern)
    ex = staged.select(explode_terms("__terms")).where(F.col("term").isNotNull())
    if stops:
        ex = ex.where(~F.col("term").isin(*stops))
    return ex.groupBy("term").agg(F.count("*").alias("total"))


def top_terms(totals: DataFrame, max_features: int) -> DataFrame:
    """Most frequent terms, ties alphabetical (W6): ``term, total, index``
    where ``index`` is the alphabetical position inside the vocabulary."""
    top = totals.orderBy(F.desc("total"), F.asc("term")).limit(max_features)
    # the rank window runs over the (at most max_features) vocabulary rows only
    return top.withColumn("index", (F.row_number().over(Window.orderBy("term")) - 1).cast("bigint"))


def term_frequencies(terms: Column) -> Column:
    """``array<struct<term, tf>>`` of a term array, counted inside the row."""
    # size - size(array_remove): a native loop per distinct term, no lambda.
    return F.transform(
        F.array_distinct(terms),
        lambda t: F.struct(t.alias("term"), (F.size(terms) - F.size(F.array_remove(terms, t))).cast("bigint").alias("tf")),
    )


@dataclass
class VectorizerModel:
    id_col: str
    text_col: str
    ngram_max: int
    stop_words: tuple | None
    terms: list[str]
    idf: dict[str, float] | None
    pattern: str = TOKEN_PATTERN

    @property
    def input_col_name(self) -> str:
        return self.text_col

    def with_vocab_terms(self, df: DataFrame, out: str = "__vt") -> DataFrame:
        """Adds ``out``: the row's terms that are in the vocabulary."""
        staged = with_terms(df, self.text_col, "__all_terms", self.ngram_max, self.stop_words, self.pattern)
        vocab = list(self.terms)
        vt = F.filter(F.col("__all_terms"), lambda t: t.isin(*vocab)) if vocab else F.array().cast("array<string>")
        return staged.withColumn(out, vt).drop("__all_terms")

    def entries_from_tf(self, d: DataFrame, tf_col: str, out: str = "__entries") -> DataFrame:
        """Counts or unnormalised TF-IDF entries plus ``__norm`` from an
        ``array<struct<term, tf>>`` column."""
        if self.idf is None:
            e = F.transform(F.col(tf_col), lambda x: F.struct(x["term"].alias("term"), x["tf"].alias("value")))
            return d.withColumn(out, e).withColumn("__norm", F.lit(1))
        idf_map = F.create_map(*[x for t in self.terms for x in (F.lit(t), F.lit(self.idf[t]))])
        d = d.withColumn(
            out, F.transform(F.col(tf_col), lambda x: F.struct(x["term"].alias("term"), (x["tf"] * idf_map[x["term"]]).alias("value")))
        )
        return d.withColumn("__norm", F.sqrt(F.aggregate(F.col(out), F.lit(0.0), lambda acc, x: acc + x["value"] * x["value"])))

    def long_form(self, d: DataFrame) -> DataFrame:
        name = "weight" if self.idf is not None else "count"
        ex = d.select(F.col(self.id_col), F.explode_outer("__entries").alias("e"), "__norm").where(F.col("e").isNotNull())
        value = F.col("e.value") if self.idf is None else F.col("e.value") / F.col("__norm")
        return ex.select(self.id_col, F.col("e.term").alias("term"), value.alias(name))

    def with_entries(self, df: DataFrame, out: str = "__entries") -> DataFrame:
        """Adds ``out``: per row ``array<struct<term, value>>`` of the
        vocabulary terms -- counts, or TF-IDF weights before normalisation --
        and ``__norm`` (their L2 norm; 1 for counts). Computed inside the row,
        no shuffle; each intermediate array is its own column, so the
        tokenisation runs once per row."""
        d = self.with_vocab_terms(df, "__vt")
        d = d.withColumn("__tf", term_frequencies(F.col("__vt")))
        return self.entries_from_tf(d, "__tf", out).drop("__vt", "__tf")

    def transform(self, df: DataFrame) -> DataFrame:
        """Long form ``(id, term, count | weight)`` for the vocabulary terms of
        each document -- a narrow projection plus ``explode``. (``explode_outer``
        then a NULL filter: a plain explode would make the optimizer infer a
        ``size(...) > 0`` filter that repeats the tokenisation.)"""
        return self.long_form(self.with_entries(df.select(self.id_col, self.input_col_name)))

    def transform_wide(self, df: DataFrame, prefix: str = "tfidf_", width: int | None = None) -> DataFrame:
        """Dense layout: one column per vocabulary index (alphabetical), 0 when
        absent, padded to ``width`` columns -- map lookups inside the row."""
        width = width or len(self.terms)
        out = self.with_entries(df).withColumn("__m", F.map_from_entries("__entries")).drop("__entries")
        cols = {}
        for i in range(width):
            if i < len(self.terms):
                v = F.col("__m")[F.lit(self.terms[i])].cast("double")
                if self.idf is not None:
                    v = v / F.col("__norm")
                cols[f"{prefix}{i}"] = F.coalesce(v, F.lit(0.0))
            else:
                cols[f"{prefix}{i}"] = F.lit(0.0)
        return out.withColumns(cols).drop("__m", "__norm")


def _token_table(df: DataFrame, text_col: str, stop_words, pattern: str, *keep: str) -> DataFrame:
    """``keep`` and the tokens ``__tok`` of every row, written once for all passes."""
    return written(df.select(*keep, terms_column(F.col(text_col), stop_words, 1, pattern).alias("__tok")), "tokens")


def _candidate_totals(toks: DataFrame, max_features: int) -> DataFrame:
    """``(term, total)`` of every uni- or bigram that can be among the ``max_features`` most frequent.

    A bigram is no more frequent than either of its words. With ``least`` the total of the
    ``max_features``-th word, no term below it makes the vocabulary, so only bigrams of two
    words that reach it are counted: the totals are exact, and millions of rare bigrams are
    never shuffled. Too few words, too many ties or words with blanks: all terms are counted.
    """
    def totals(terms: Column) -> DataFrame:
        ex = toks.select(terms.alias("__terms")).select(explode_terms("__terms")).where(F.col("term").isNotNull())
        return ex.groupBy("term").agg(F.count("*").alias("total"))

    single = written(totals(F.col("__tok")), "word-totals")
    first = single.select("total").orderBy(F.desc("total")).limit(max_features)
    n, least = first.agg(F.count("*"), F.min("total")).first()
    blanks = single.where(F.col("term").contains(" ")).limit(1).count()
    frequent = single.where(F.col("total") >= least) if n == max_features and not blanks else single.limit(0)
    words = [r["term"] for r in frequent.limit(TIES * max_features + 1).collect()]
    if not 0 < len(words) <= TIES * max_features:
        return totals(F.concat("__tok", bigrams(F.col("__tok"))))
    tok = F.col("__tok")
    head = F.slice(tok, 1, F.greatest(F.size(tok) - 1, F.lit(0)))
    pairs = F.transform(head, lambda x, i: F.when(x.isin(*words) & F.element_at(tok, i + 2).isin(*words), F.concat(x, F.lit(" "), F.element_at(tok, i + 2))))
    return frequent.unionByName(totals(pairs))


def _fit_vocab(df: DataFrame, text_col: str, ngram_max: int, stop_words, max_features,
               pattern: str = TOKEN_PATTERN, toks: DataFrame | None = None) -> list[str]:
    if ngram_max == 2 and max_features > 0:
        totals = _candidate_totals(_token_table(df, text_col, stop_words, pattern) if toks is None else toks, max_features)
    else:
        totals = corpus_totals(df, text_col, ngram_max, stop_words, pattern)
    return [r["term"] for r in top_terms(totals, max_features).orderBy("index").collect()]


@dataclass
class CountVectorizer:
    """Bag of words over the ``max_features`` most frequent terms."""

    input_col: str
    id_col: str
    max_features: int = 100
    ngram_max: int = 1
    stop_words: tuple | None = None
    pattern: str = TOKEN_PATTERN

    def fit(self, df: DataFrame) -> VectorizerModel:
        terms = _fit_vocab(df, self.input_col, self.ngram_max, self.stop_words, self.max_features, self.pattern)
        return VectorizerModel(self.id_col, self.input_col, self.ngram_max, self.stop_words, terms, None, self.pattern)


@dataclass
class TfidfVectorizer:
    """TF-IDF over uni- (and bi-) grams with the smoothed idf
    ``ln((1 + n) / (1 + df)) + 1`` and L2-normalised rows (F14).

    Fit = two aggregates: corpus totals for the vocabulary (a distributed
    top-k), then document frequencies of the vocabulary terms (each
    document contributes its distinct vocabulary terms only)."""

    input_col: str
    id_col: str
    max_features: int = 100
    ngram_max: int = 2
    stop_words: tuple | None = None
    pattern: str = TOKEN_PATTERN

    def fit_transform(self, df: DataFrame) -> tuple[VectorizerModel, DataFrame]:
        """Fit and transform the same rows with one pass over the text: tokens are
        written once, and every later pass reads them. The per-document vocabulary counts (at most
        ``max_features`` entries per row) are checkpointed to the shared
        folder, then document frequencies and weights both read them."""
        import math

        toks = _token_table(df, self.input_col, self.stop_words, self.pattern, self.id_col)
        terms = _fit_vocab(df, self.input_col, self.ngram_max, self.stop_words, self.max_features, self.pattern, toks)
        model = VectorizerModel(self.id_col, self.input_col, self.ngram_max, self.stop_words, terms, None, self.pattern)
        known = F.col("__tok") if self.ngram_max == 1 else F.concat(F.col("__tok"), bigrams(F.col("__tok")))
        known = F.filter(known, lambda t: t.isin(*terms)) if terms else F.array().cast("array<string>")
        base = toks.select(self.id_col, known.alias("__vt"))
        base = cut_lineage(base.select(self.id_col, term_frequencies(F.col("__vt")).alias("__tf")))
        n_docs = base.count()
        present = base.select(F.explode_outer("__tf.term").alias("term")).where(F.col("term").isNotNull())
        dfs = {r["term"]: r["df"] for r in present.groupBy("term").agg(F.count("*").alias("df")).collect()}
        model.idf = {t: math.log((1 + n_docs) / (1 + dfs.get(t, 0))) + 1.0 for t in terms}
        return model, model.long_form(model.entries_from_tf(base, "__tf"))

    def fit(self, df: DataFrame) -> VectorizerModel:
        import math

        terms = _fit_vocab(df, self.input_col, self.ngram_max, self.stop_words, self.max_features, self.pattern)
        model = VectorizerModel(self.id_col, self.input_col, self.ngram_max, self.stop_words, terms, None, self.pattern)
        n_docs = df.count()
        dfs = {}
        if terms:
            present = model.with_vocab_terms(df.select(self.input_col), "__vt").select(
                explode_terms(F.array_distinct("__vt"))
            ).where(F.col("term").isNotNull())
            dfs = {r["term"]: r["df"] for r in present.groupBy("term").agg(F.count("*").alias("df")).collect()}
        idf = {t: math.log((1 + n_docs) / (1 + dfs.get(t, 0))) + 1.0 for t in terms}
        model.idf = idf
        return model
