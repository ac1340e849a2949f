"""Queries of the text operators (P11, P18, F13, F14, W6, F15 with TF-IDF)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions.text import ASCII_TOKEN_PATTERN, length, letters_only, normalize_text, word_count
from kiln.operators import prep
from kiln.operators.text_features import CountVectorizer, TfidfVectorizer, corpus_totals, english_stop_words, top_terms
from kiln.operators.term_tables import TermTableVectorizer, ranked_terms
from kiln.plans.registry import query
from kiln.sources import tables as T
from kiln.sources.tables import read, with_ctes


def _stops_sql() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words()) + "]"


CLEAN_SQL = "trim(regexp_replace(regexp_replace(lower({c}), '[^a-zA-Z\\s]', '', 'g'), '\\s+', ' ', 'g'))"


def _clean(c: str) -> str:
    return CLEAN_SQL.format(c=c)


def sql_terms(docs: str, ngram_max: int, limit: str = "LIMIT 100") -> str:
    """CTEs tok / terms / tf / vocab over ``docs(id, t)``."""
    big = ", list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])" if ngram_max == 2 else ""
    terms = f"list_concat(w{big})" if big else "w"
    return f"""tok AS (SELECT id, list_filter(regexp_extract_all(lower(t), '\\b\\w\\w+\\b'),
                                   lambda x: NOT list_contains({_stops_sql()}, x)) AS w FROM {docs}),
terms AS (SELECT id, unnest({terms}) AS term FROM tok),
tf AS (SELECT id, term, count(*) AS tf FROM terms GROUP BY id, term),
vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY term ORDER BY total DESC, term ASC {limit})"""


def sql_tfidf_parts(docs: str, id_name: str, limit: str = "LIMIT 100") -> tuple[str, str]:
    """(CTE list, final SELECT) of the long-form TF-IDF over ``docs(id, t)``."""
    ctes = f"""{sql_terms(docs, 2, limit)},
dfc AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM vocab) GROUP BY term),
nd AS (SELECT count(*) AS n FROM {docs}),
wt AS (SELECT tf.id, tf.term,
              tf.tf * (ln(CAST(1 + n AS DOUBLE) / CAST(1 + df AS DOUBLE)) + 1.0) AS w
       FROM tf JOIN dfc ON tf.term = dfc.term, nd),
nrm AS (SELECT id, sqrt(sum(w * w)) AS norm FROM wt GROUP BY id)"""
    select = f"SELECT wt.id AS {id_name}, term, w / norm AS weight FROM wt JOIN nrm ON wt.id = nrm.id"
    return ctes, select


def sql_tfidf(docs: str, id_name: str) -> str:
    ctes, select = sql_tfidf_parts(docs, id_name)
    return ctes + "\n" + select


# ---------------------------------------------------------------- P11 / P18
@query(
    "p11_text_stats",
    sql="""
SELECT doc_id, CAST(length(text) AS BIGINT) AS text_length,
       CAST(CASE WHEN text IS NULL THEN NULL
                 WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' THEN 0
                 ELSE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) END AS BIGINT) AS word_count
FROM documents""",
)
def p11_text_stats(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", length(F.col("text")).alias("text_length"), word_count(F.col("text")).alias("word_count"))


@query("p18_normalize_text", sql=f"SELECT doc_id, {_clean('text')} AS clean_text FROM documents")
def p18_normalize_text(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", normalize_text(F.col("text")).alias("clean_text"))


# ---------------------------------------------------------------- F13 / W6
DOCS_CLEAN = f"(SELECT doc_id AS id, {_clean('text')} AS t FROM documents)"


def _clean_docs(spark, sf_dir):
    """Cleaned documents for the vectorisers: the letters-only form of P18
    (identical tokens, one regular-expression pass instead of three)."""
    return read(spark, sf_dir, "documents").select("doc_id", letters_only(F.col("text")).alias("clean_text"))


@query(
    "w6_top_terms",
    sql=f"WITH {sql_terms(DOCS_CLEAN, 1)}\n"
        "SELECT term, total, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS \"index\" FROM vocab",
)
def w6_top_terms(spark, sf_dir):
    """The 100 most frequent non-stop words of the cleaned documents."""
    return top_terms(corpus_totals(_clean_docs(spark, sf_dir), "clean_text", 1, None, ASCII_TOKEN_PATTERN), 100)


@query(
    "f13_bag_of_words",
    sql=f"WITH {sql_terms(DOCS_CLEAN, 1)}\n"
        "SELECT id AS doc_id, term, tf AS \"count\" FROM tf WHERE term IN (SELECT term FROM vocab)",
)
def f13_bag_of_words(spark, sf_dir):
    docs = _clean_docs(spark, sf_dir)
    return CountVectorizer("clean_text", "doc_id", 100, pattern=ASCII_TOKEN_PATTERN).fit(docs).transform(docs)


@query(
    "w6_all_terms",
    sql=f"WITH {sql_terms(DOCS_CLEAN, 1, '')}\n"
        "SELECT term, total, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS \"index\" FROM vocab",
)
def w6_all_terms(spark, sf_dir):
    """Every non-stop word of the cleaned documents with its alphabetical index."""
    return ranked_terms(corpus_totals(_clean_docs(spark, sf_dir), "clean_text", 1, None, ASCII_TOKEN_PATTERN))


@query(
    "f13_bag_of_all_words",
    sql=f"WITH {sql_terms(DOCS_CLEAN, 1, '')}\nSELECT id AS doc_id, term, tf AS \"count\" FROM tf",
)
def f13_bag_of_all_words(spark, sf_dir):
    """Bag of words without a limit on the vocabulary."""
    return TermTableVectorizer("clean_text", "doc_id", pattern=ASCII_TOKEN_PATTERN).fit_transform(_clean_docs(spark, sf_dir))[1]


# ---------------------------------------------------------------- F14
@query(
    "f14_tfidf_products",
    sql=with_ctes("prod") + ",\ndocs AS (SELECT product_id AS id, coalesce(product_description, '') AS t FROM prod),\n"
        + sql_tfidf("docs", "product_id"),
    rounding={"weight": 6},
)
def f14_tfidf_products(spark, sf_dir):
    p = T.products(spark, sf_dir).withColumn("product_description", F.coalesce("product_description", F.lit("")))
    return TfidfVectorizer("product_description", "product_id", 100, 2).fit_transform(p)[1]


@query(
    "f14_tfidf_documents",
    sql=f"WITH docs AS {DOCS_CLEAN},\n" + sql_tfidf("docs", "doc_id"),
    rounding={"weight": 6},
)
def f14_tfidf_documents(spark, sf_dir):
    """TF-IDF of uni- and bigrams over the whole cleaned documents."""
    docs = _clean_docs(spark, sf_dir)
    return TfidfVectorizer("clean_text", "doc_id", 100, 2, pattern=ASCII_TOKEN_PATTERN).fit_transform(docs)[1]


@query(
    "f14_tfidf_products_all_terms",
    sql=with_ctes("prod") + ",\ndocs AS (SELECT product_id AS id, coalesce(product_description, '') AS t FROM prod),\n"
        + "\n".join(sql_tfidf_parts("docs", "product_id", "")),
    rounding={"weight": 6},
)
def f14_tfidf_products_all_terms(spark, sf_dir):
    """TF-IDF of product texts without a limit on the vocabulary."""
    return TermTableVectorizer("product_description", "product_id", 2, tfidf=True).fit_transform(T.products(spark, sf_dir))[1]


def _f15_wide_sql() -> str:
    cols = ", ".join(
        f"coalesce(max(CASE WHEN vi.idx = {i} THEN lw.weight END), 0.0) AS tfidf_{i}" for i in range(100)
    )
    ctes, select = sql_tfidf_parts("docs", "product_id")
    return (
        with_ctes("prod") + ",\ndocs AS (SELECT product_id AS id, coalesce(product_description, '') AS t FROM prod),\n"
        + ctes + f",\nlw AS ({select}),\n"
        + "vi AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM vocab)\n"
        + f"SELECT prod.product_id, {cols}\nFROM prod LEFT JOIN lw ON prod.product_id = lw.product_id "
        + "LEFT JOIN vi ON lw.term = vi.term GROUP BY prod.product_id"
    )


@query("f15_product_tfidf_wide", sql=_f15_wide_sql(), rounding={f"tfidf_{i}": 6 for i in range(100)})
def f15_product_tfidf_wide(spark, sf_dir):
    """F15's dense ``tfidf_0..99`` block, one row per product."""
    p = prep.product_features(T.products(spark, sf_dir), tfidf=True)
    return p.select("product_id", *[f"tfidf_{i}" for i in range(100)])
