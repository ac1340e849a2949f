"""Context-tree weighting against a direct computation over all texts."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kiln.llm import context_tree as C
from kiln.llm import queries
from sample_tables import SMALL

lg = math.lgamma


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def decisions(w, depth=C.DEPTH):
    """``(context, node, bit)`` of every binary decision of a text."""
    b = b"\n" * depth + " ".join(w).encode() + b"\n"
    for p in range(depth, len(b)):
        for k in range(8):
            yield b[p - depth : p], 1 << k | b[p] >> (8 - k), b[p] >> (7 - k) & 1


class Direct:
    """The tree as dictionaries."""

    def __init__(self, texts, depth=C.DEPTH):
        self.depth, self.counts = depth, defaultdict(lambda: [0, 0])
        for w in texts:
            for ctx, node, bit in decisions(w, depth):
                for d in range(depth + 1):
                    self.counts[ctx[depth - d :], node][bit] += 1
        self.estimate = {k: lg(a + 0.5) + lg(b + 0.5) - lg(a + b + 1) - math.log(math.pi) for k, (a, b) in self.counts.items()}
        self.weighted, below = {}, defaultdict(float)
        for k in sorted(self.counts, key=lambda k: -len(k[0])):
            self.weighted[k] = self.estimate[k] if len(k[0]) == depth else np.logaddexp(self.estimate[k] + math.log(0.5), below[k] + math.log(0.5))
            if k[0]:
                below[k[0][1:], k[1]] += self.weighted[k]

    def score(self, w):
        total = 0.0
        for ctx, node, bit in decisions(w, self.depth):
            p = None
            for d in range(self.depth, -1, -1):
                k = ctx[self.depth - d :], node
                c = self.counts.get(k, [0, 0])
                here = (c[bit] + 0.5) / (sum(c) + 1)
                share = math.exp(self.estimate[k] + math.log(0.5) - self.weighted[k]) if k in self.weighted else 0.5
                p = here if p is None else share * here + (1 - share) * p
            total += math.log10(p)
        return total


def check(rows, texts, training):
    """``rows`` of score_texts with ids that name their texts."""
    learnt = [words(t) for i, t in texts.items() if training(i)]
    direct, counts = Direct(learnt), Counter(x for w in learnt for x in w)
    n, v = sum(counts.values()) + len(learnt), len(counts) + (len(learnt) > 0)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        w = words(texts[r.doc_id])
        base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*[counts[x] for x in w], len(learnt)])
        assert (r.n_tokens, r.train_tokens) == (len(w) + 1, n)
        assert r.n_known == sum(x in counts for x in w) + (len(learnt) > 0)
        assert abs(r.base_score - base) <= 1e-9 * max(1, abs(base))
        assert abs(r.score - direct.score(w)) <= 1e-9 * max(1, abs(r.score))


def test_log_gamma():
    x = np.concatenate([np.arange(0.5, 30, 0.5), [1e3, 1e6 + 0.5, 1e12]])
    assert np.allclose(C.log_gamma(x), [lg(v) for v in x], rtol=1e-12, atol=1e-12)
    assert C.log_kt(np.array([0.0, 1.0, 2.0]), np.array([0.0, 0.0, 1.0])).tolist()[0] == 0
    assert np.allclose(np.exp(C.log_kt(np.array([1.0, 2.0]), np.array([0.0, 1.0]))), [0.5, 0.0625])


def test_probabilities_of_a_context_sum_to_one(spark):
    texts = ["a b", "ab ab", "b"]
    direct = Direct([words(t) for t in texts], 2)
    for ctx in (b"ab", b"\n\n", b"zz"):
        total = 0.0
        for y in range(256):
            p = 1.0
            for k in range(8):
                node, bit, q = 1 << k | y >> (8 - k), y >> (7 - k) & 1, None
                for d in (2, 1, 0):
                    key = ctx[2 - d :], node
                    c = direct.counts.get(key, [0, 0])
                    share = math.exp(direct.estimate[key] + math.log(0.5) - direct.weighted[key]) if key in direct.weighted else 0.5
                    here = (c[bit] + 0.5) / (sum(c) + 1)
                    q = here if q is None else share * here + (1 - share) * q
                p *= q
            total += p
        assert abs(total - 1) < 1e-12


def test_small_texts_equal_the_direct_tree(spark, monkeypatch):
    texts = {1: "The cat  sat", 2: None, 3: "", 4: " \n", 5: "the cat sat\ton THE mat", 6: "naïve Ångström ÄÖ 中文 words", 7: "x" * 3000, 8: "a b " * 400, 9: "the cat sat"}
    docs = spark.createDataFrame([(i, t, "clash", 7) for i, t in texts.items()], "doc_id long, text string, score string, training int")
    check(C.score_texts(docs, F.col("doc_id") % 4 != 1).collect(), texts, lambda i: i % 4 != 1)


def test_blocks_and_pieces_do_not_change_scores(spark):
    import random

    rng = random.Random(3)
    texts = {i: " ".join(rng.choice(["alpha", "beta", "gämma", "d" * 50, "ep"]) for _ in range(rng.randint(0, 60))) for i in range(60)}
    texts[60] = "one " * 900 + "w" * 900 + " two" * 300
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    whole = {r.doc_id: r for r in C.score_texts(docs, F.col("doc_id") % 5 != 1).collect()}
    check(whole.values(), texts, lambda i: i % 5 != 1)
    data = b"".join(C.pieces(texts[60].encode() + b"\n", 100))
    cut = list(C.pieces(texts[60].encode() + b"\n", 100))
    assert b"".join(p[C.DEPTH :] for p in cut) == texts[60].encode() + b"\n" and len(cut) > 30 and len(data) > 4000
    assert all(p[-1:] in (b" ", b"\n") for p in cut)
    for before, p in zip(cut, cut[1:]):
        assert before[-C.DEPTH :] == p[: C.DEPTH]


def test_pieces_of_one_text_add_up():
    """The keys of a text cut into pieces are those of the whole text."""
    text = ("lorem ipsum dolor " * 300).encode() + b"\n"

    def block(parts):
        return C.Block({"bytes": C._packed(b"".join(parts)), "lengths": [len(p) for p in parts], "training": [True] * len(parts)})

    whole, cut = block(list(C.pieces(text))), block(list(C.pieces(text, 64)))
    assert len(cut.lengths) > 50
    for a, b in zip(whole.grams(), cut.grams()):
        assert (a == b).all()
    assert whole.words()[0].to_pylist() == cut.words()[0].to_pylist() and (whole.words()[1] == cut.words()[1]).all()


def test_slices_of_batches_are_read_right():
    texts = pa.array(["A b", "CC  dd", None, "ff GG hh"])
    assert C.normalised(texts) == [b"a b\n", b"cc dd\n", b"\n", b"ff gg hh\n"]
    assert C.normalised(texts.slice(1, 3)) == [b"cc dd\n", b"\n", b"ff gg hh\n"]


def test_repeats_nulls_no_training_and_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a c")], "doc_id long, text string")
    rows = C.score_texts(docs, F.lit(None).cast("boolean")).collect()
    assert len(rows) == 3 and {r.train_tokens for r in rows} == {9} and all(r.training for r in rows)
    assert len({(r.doc_id, r.score) for r in rows}) == 2
    for r in C.score_texts(docs, F.lit(False)).collect():
        assert (r.base_score, r.n_known, r.train_tokens, r.n_tokens) == (0.0, 0, 0, 3)
        assert abs(r.score - 4 * 8 * math.log10(0.5)) < 1e-12
    assert C.score_texts(docs.limit(0), F.lit(True)).count() == 0


def test_query_over_the_small_tables(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SMALL, "documents").collect()}
    rows = queries.op11_lm_scoring(spark, SMALL).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)
    check(rows, texts, lambda i: zlib.crc32(str(i).encode()) % 5 != 1)
