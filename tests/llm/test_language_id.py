"""Segmentation-marginalised unigrams against direct recursions."""

import math
import random
from functools import cache

import numpy as np
import pytest

from kiln.llm import language_id as L

NAMES = ["▁", "a", "b", "ab", "▁a", "ba", "abab", "é"]


def tables(seed=0, languages=2):
    rng = np.random.default_rng(seed)
    table = rng.uniform(0.01, 0.3, (len(NAMES) + L.BYTES + 1, languages))
    table[-1] = 0
    return L.Pieces(NAMES), table


def logs(pieces, table, word, k):
    """log of the sum over all segmentations, from the right, position by position."""

    def piece(w):
        if w in pieces.index:
            return math.log(table[pieces.index[w]][k])
        return sum(math.log(table[pieces.size + x][k]) for x in w.encode()) if len(w) == 1 else None

    @cache
    def rest(i):
        if i == len(word):
            return 0.0
        found = [p + rest(j) for j in range(i + 1, min(len(word), i + pieces.longest) + 1) if (p := piece(word[i:j])) is not None]
        return float(np.logaddexp.reduce(found))

    for i in range(len(word) - 1, 0, -1):  # keeps the recursion shallow
        rest(i)
    return rest(0)


def samples():
    rng = random.Random(4)
    words = ["▁" + "".join(rng.choice("abé日x") for _ in range(n)) for n in (0, 1, 2, 5, 22, 23, 24, 25, 60, 60, 400, 3000)]
    return [*words, "▁" + "ab" * 30, "▁日本", "▁é"]


def test_sums_over_all_segmentations_of_words_of_any_length():
    pieces, table = tables()
    got = L.log_likelihoods(pieces, table, samples())
    want = [[logs(pieces, table, w, k) for k in range(2)] for w in samples()]
    assert np.allclose(got, want, rtol=1e-11)


def test_short_and_long_paths_agree(monkeypatch):
    pieces, table = tables(3)
    short = [w for w in samples() if len(w) <= L.TOGETHER]
    a, ea = L.log_likelihoods(pieces, table, short), L.expected_counts(pieces, table[:, 0], short, np.ones(len(short)))
    monkeypatch.setattr(L, "TOGETHER", 0)
    assert np.allclose(a, L.log_likelihoods(pieces, table, short), rtol=1e-12)
    assert np.allclose(ea, L.expected_counts(pieces, table[:, 0], short, np.ones(len(short))), rtol=1e-9)


def test_expected_counts_are_derivatives_of_the_log_likelihood():
    pieces, table = tables(1)
    words, weight = samples()[:11], np.arange(1.0, 12.0)
    p = table[:, 0].copy()
    counts = L.expected_counts(pieces, p, words, weight)
    assert counts[-1] == 0
    for i in [0, 1, 2, 3, 6, 7, pieces.size + ord("x"), pieces.size + 0xE6]:
        up, down = table.copy(), table.copy()
        up[i], down[i] = up[i] * (1 + 1e-6), down[i] * (1 - 1e-6)
        slope = ((L.log_likelihoods(pieces, up, words) - L.log_likelihoods(pieces, down, words))[:, 0] * weight).sum() / 2e-6
        assert counts[i] == pytest.approx(slope, rel=1e-4, abs=1e-4)


def test_letters_outside_the_vocabulary_tell_languages_apart(spark):
    from kiln.llm.queries import public_pieces

    # two syllabaries of which the vocabulary holds few letters
    amharic = ["ሰላም ለዓለም ይህ ጽሑፍ ነው", "እንኳን ደህና መጡ ወደ ከተማ", "ልጆቹ ወደ ትምህርት ቤት ሄዱ"]
    khmer = ["សួស្តី ពិភពលោក នេះ ជា អត្ថបទ", "កុមារ ទៅ សាលារៀន ព្រឹក នេះ", "សូម ស្វាគមន៍ មក ទីក្រុង"]
    rows = [("am", t) for t in amharic] + [("km", t) for t in khmer]
    model = L.fit(spark.createDataFrame(rows * 3, "lang string, text string"), public_pieces())
    test = spark.createDataFrame([("am", "ይህ ከተማ ሰላም ነው"), ("km", "ទីក្រុង នេះ ជា ពិភពលោក")], "lang string, text string")
    assert all(r.lang_pred == r.lang and r.score > 0.9 for r in L.predict(test, model).collect())


def test_ties_clashing_columns_and_nothing(spark):
    rows = [("b", "wort wort"), ("a", "wort wort")]
    model = L.fit(spark.createDataFrame(rows, "lang string, text string"), ["▁", "w", "o", "r", "t", "wort"])
    docs = spark.createDataFrame([(1, "wort", "x", 5.0), (1, "wort", "x", 5.0), (2, None, "y", None)], "doc_id long, text string, lang_pred string, score double")
    out = L.predict(docs, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    assert sorted(map(tuple, out.select("doc_id", "lang_pred", "score").collect())) == [(1, "a", 0.5), (1, "a", 0.5), (2, "und", 0.0)]
    assert L.predict(docs.limit(0), model).count() == 0
    long = spark.createDataFrame([(1, "wort" * 5000), (2, "wort " * 5000)], "doc_id long, text string")
    assert {r.lang_pred for r in L.predict(long, model).collect()} == {"a"}
