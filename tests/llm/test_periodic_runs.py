"""Periodic runs against a direct search."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from kiln.llm import periodic_runs as P
from kiln.llm import queries
from sample_tables import SMALL

BLANKS = r"[^\x20\x09-\x0D]+"


def brute(w, min_length=6, min_exponent=4):
    """Every stretch in which words q apart are equal, kept if q is its smallest period."""
    n, out = len(w), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(min_length, min_exponent * q):
                if not any(all(w[k] == w[k + r] for k in range(i, i + size - r)) for r in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def found(texts):
    runs, collapsed, n = P.collapse_batch(pa.array(texts, pa.string()))
    return [[tuple(r.values()) for r in rs] for rs in runs.to_pylist()], collapsed.to_pylist(), n.to_pylist()


def test_random_texts_equal_the_direct_search():
    rng = random.Random(5)
    docs = []
    for _ in range(800):
        n, kinds = rng.randint(0, 100), rng.choice([1, 2, 3, 5, 40])
        w = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n else 0):
            a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        docs.append([f"w{x}" for x in w])
    runs, collapsed, n = found([" ".join(w) for w in docs])
    want = [brute(w) for w in docs]
    assert runs == want and sum(map(len, want)) > 200
    assert collapsed == [kept_words(w, r) for w, r in zip(docs, want)]
    assert n == [len(w) for w in docs]


def test_runs_do_not_cross_texts_and_slices_are_read_right():
    texts = ["x", "a a a", "a a a", "b a b a", "b a b a", "c C c c c c c"]
    assert found(texts)[0][:5] == [[]] * 5
    whole, cut = found(texts), P.collapse_batch(pa.array(texts).slice(3))
    assert cut[1].to_pylist() == whole[1][3:]
    assert whole[0][5] == []  # five equal words after one other
    assert found(["c C c c c c c c"])[0] == [[(2, 6, 1)]]


def test_nested_and_touching_runs():
    w = (["a"] * 6 + ["b"]) * 4 + ["z"] * 7
    assert found([" ".join(w)])[0][0] == brute(w)
    assert {q for _, _, q in brute(w)} == {1, 7}


def test_long_text_and_long_words():
    rng = random.Random(2)
    head = [str(rng.random()) for _ in range(1000)]
    period = [rng.choice(["x" * 3000, "y" * 3000, "z"]) + str(i) for i in range(700)]
    w = head + period * 5 + period[:13] + ["end"] * 4000
    runs, collapsed, n = found([" ".join(w), None])
    assert runs == [[(1000, 3513, 700), (4513, 4000, 1)], []]
    assert collapsed == [" ".join(head + period + ["end"]), ""]
    assert n == [len(w), 0]


def test_blanks_and_other_white_space():
    # only six characters part words: no-break and file separators belong to words
    text = "\ta b\n\x0ba b\x0c a b\r\na b a b a b \x1c"
    assert found([text]) == ([[(0, 6, 1)]], ["a b \x1c"], [7])
    assert found(["", " \n ", None]) == ([[], [], []], ["", "", ""], [0, 0, 0])


def test_short_exponents_are_refused():
    with pytest.raises(ValueError):
        P.find_runs(np.zeros(3, np.int64), np.zeros(3, np.int64), min_exponent=3)


def test_frames_with_clashing_columns_repeats_and_nothing(spark):
    rows = [(1, "a a a a a a", 9, "q"), (1, "a a a a a a", 9, "q"), (None, None, 8, "q"), (2, "", None, None)]
    docs = spark.createDataFrame(rows, "id long, text string, n_words int, collapsed string")
    got = sorted(P.collapse_runs(docs).select("id", "runs", "collapsed", "n_words").collect(), key=str)
    assert [(r.id, len(r.runs), r.collapsed, r.n_words) for r in got] == [(1, 1, "a", 6), (1, 1, "a", 6), (2, 0, "", 0), (None, 0, "", 0)]
    empty = P.collapse_runs(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["id", "text", "runs", "collapsed", "n_words"]
    top = P.collapse_runs(spark.createDataFrame([(1, "a a a a a a x b b b b b b")], "id long, text string")).select(P.longest("runs").alias("t")).first().t
    assert (top.start, top.length, top.period) == (0, 6, 1)  # ties: the smallest start


def test_query_equals_the_direct_search(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SMALL, "documents").select("doc_id", "text").collect()}
    seen = 0
    for r in queries.op12_periodic_runs(spark, SMALL).collect():
        w = re.findall(BLANKS, texts.pop(r.doc_id) or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = brute(w)
        seen += len(runs)
        top = min(((-m, s, q) for s, m, q in runs), default=(None,) * 3)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (top[1], top[0] and -top[0], top[2])
        assert r.exponent_milli == (1000 * -top[0] // top[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept_words(w, runs).encode()).hexdigest()
    assert not texts and seen > 10


def test_periodic_tails_of_odd_rows(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    docs = spark.createDataFrame([(ids[0], ""), (ids[1], None), (None, "a b c")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in queries.with_periods(docs).collect()), key=str) == sorted([(ids[0], ""), (ids[1], None), (None, "a b c")], key=str)
