"""Vocabularies without a limit against the limited vectorisers and simple counts."""

import inspect

import pytest

from kiln.operators import term_tables
from kiln.operators.term_tables import TermTableVectorizer, ranked_terms
from kiln.operators.text_features import CountVectorizer, TfidfVectorizer, corpus_totals

ROWS = [(1, "red apple red pear"), (2, "the pear and the plum"), (3, None), (4, ""), (5, "zebra apple"), (5, "apple " * 3000), (None, "plum plum kiwi")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "id long, t string")


def rows(df):
    return sorted(((r[0], r[1], round(r[2], 12)) for r in df.collect()), key=repr)


def test_equal_to_the_limited_form(docs):
    assert rows(TermTableVectorizer("t", "id", 2).fit_transform(docs)[1]) == rows(CountVectorizer("t", "id", 1000, 2).fit(docs).transform(docs))
    model, got = TermTableVectorizer("t", "id", 2, tfidf=True).fit_transform(docs)
    assert rows(got) == rows(TfidfVectorizer("t", "id", 1000, 2).fit_transform(docs)[1])
    assert rows(model.transform(docs)) == rows(got)


def test_index_is_the_alphabetical_rank(docs):
    ranked = {r.term: r["index"] for r in ranked_terms(corpus_totals(docs, "t")).collect()}
    assert [t for t, _ in sorted(ranked.items(), key=lambda x: x[1])] == sorted(ranked) and sorted(ranked.values()) == list(range(len(ranked)))


def test_unseen_terms_are_left_out_and_sparse_rows_are_whole(spark, docs):
    model = TermTableVectorizer("t", "id").fit(docs)
    new = spark.createDataFrame([(9, "apple unseen apple zebra"), (9, "unseen"), (9, None)], "id long, t string")
    index = {r.term: r["index"] for r in model.vocabulary.collect()}
    got = [(r.id, r.size, list(r.indices), list(r["values"])) for r in model.transform_sparse(new).collect()]
    size = len(index)
    assert sorted(got) == [(9, size, [], []), (9, size, [], []), (9, size, [index["apple"], index["zebra"]], [2.0, 1.0])]


def test_empty_table(docs):
    model, got = TermTableVectorizer("t", "id", 2, tfidf=True).fit_transform(docs.limit(0))
    assert got.count() == 0 and model.vocabulary.count() == 0


def test_no_collect_and_no_unpartitioned_window(docs):
    assert "collect()" not in inspect.getsource(term_tables)
    plan = TermTableVectorizer("t", "id").fit_transform(docs)[1]._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_terms_are_not_shuffled_and_fitted_counts_not_joined(spark, docs, monkeypatch):
    """Counts by row need no shuffle of terms, and counts of the fitted rows no join with the vocabulary."""
    plans, write = [], term_tables.staged

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(term_tables, "staged", seen)
    counted = TermTableVectorizer("t", "id").fit_transform(docs)[1]
    (plan,) = [p for name, p in plans if name == "term-counts"]
    assert plan.count("Exchange ") == 1 and "row-terms" not in dict(plans)
    assert "Join" not in counted._jdf.queryExecution().executedPlan().toString()


def test_rare_bigrams_are_not_counted(spark, monkeypatch):
    """The limited vocabulary counts only bigrams of words that can reach it, and is that of all terms."""
    from kiln.operators import text_features

    text = ["common words stay common words", "rare%d common words tail%d"]
    docs = spark.createDataFrame([(i, text[i % 2] % ((i, i) if i % 2 else ())) for i in range(300)] + [(300, None), (301, "")], "id long, t string")
    counted, top = [], text_features.top_terms
    monkeypatch.setattr(text_features, "top_terms", lambda totals, k: (counted.append(totals.count()), top(totals, k))[1])
    for k in (1, 3, 5, 400, 5000):  # 400: cut among the words that occur once
        got = text_features._fit_vocab(docs, "t", 2, None, k)
        assert got == [r.term for r in top(corpus_totals(docs, "t", 2), k).orderBy("index").collect()]
    assert counted[1] < 10 and counted[-1] == corpus_totals(docs, "t", 2).count()
