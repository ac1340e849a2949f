"""Deduplication operators against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from kiln.llm import embedding_dedup, exact_dedup, simhash, substring_dedup
from kiln.llm.components import connected_components
from kiln.llm.fm_index import window_owners

SCHEMA = "doc_id long, text string, lang string, keep_id string, row string"


def frame(spark, rows, schema=SCHEMA):
    n = len(schema.split(","))
    return spark.createDataFrame([(*r, *["x"] * (n - len(r))) for r in rows], schema)


def least_reachable(ids, pairs):
    to = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(to[a], to[b])
            changed |= to[a] != m or to[b] != m
            to[a] = to[b] = m
    return to


def test_components_of_chain_star_and_ring(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(203, 201), (201, 202), (202, 203), (7, 7)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(pairs, "x long, y long")).collect()}
    assert got == least_reachable({x for p in pairs for x in p}, pairs)
    assert connected_components(spark.createDataFrame([], "x long, y long")).count() == 0


def words_text(rng, n, vocabulary=200):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_exact_duplicates(spark):
    rows = [(5, "a b"), (3, "a\t\n b"), (9, "a  b"), (1, ""), (4, None), (8, " "), (7, " "), (2, "x" * 300_000), (6, "x" * 300_000), (6, "x" * 300_000), (None, "a b"), (None, "only")]
    got = {(r.doc_id, r.text_sha256): tuple(r)[1:4] for r in exact_dedup.exact_duplicates(frame(spark, rows)).collect()}
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        least = min((j for j in ids if j is not None), default=None)
        assert got[i, hashlib.sha256(t.encode()).hexdigest()] == (least, len(ids), i == least)
    assert exact_dedup.exact_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_trie_splits_spills_and_keeps_the_least():
    rng = random.Random(1)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    trie, want, got = exact_dedup.PatriciaTrie(), {}, []
    for i, k in enumerate(keys):
        trie.insert(k, -i)
        want[k] = (-i, want.get(k, (0, 0))[1] + 1)
    got += trie.spill()
    assert {k[0] for k, _, _ in got} == {got[0][0][0]}
    got += trie.drain()
    assert {k: (i, n) for k, i, n in got} == want and len(got) == len(want) and trie.bytes() == 0


def test_sorted_insertion_spills_what_is_complete():
    rng = random.Random(2)
    keys = sorted(bytes(rng.choice(b"ab\xff") for _ in range(rng.randrange(0, 9))) for _ in range(600))
    trie, want, got = exact_dedup.PatriciaTrie(), {}, []
    for i, k in enumerate(keys):
        trie.insert(k, i)
        want[k] = (want.get(k, (i, 0))[0], want.get(k, (i, 0))[1] + 1)
        if rng.random() < 0.2:
            got += trie.spill_before(k)
            assert trie.bytes() <= len(k) + trie.NODE_BYTES
    got += trie.drain()
    assert {k: (i, n) for k, i, n in got} == want and len(got) == len(want) and trie.bytes() == 0


def test_common_beginnings_share_their_edges():
    trie = exact_dedup.PatriciaTrie()
    for i in range(50):
        trie.insert(b"x" * 10_000 + bytes([i]), i)
    assert trie.bytes() < 10_000 + 60 * (trie.NODE_BYTES + 1)


def test_small_trie_budget_changes_nothing(spark):
    rows = [(i, f"text {i % 37} " * 20) for i in range(500)] + [(900, ""), (901, None), (902, "text"), (903, "text")]
    a = exact_dedup.exact_duplicates(frame(spark, rows)).collect()
    b = exact_dedup.exact_duplicates(frame(spark, rows), budget=2000).collect()
    assert sorted(a) == sorted(b) and sum(r.kept for r in a) == 39


def brute_fingerprint(text):
    import xxhash

    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())) if x]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_covering_masks_hide_every_difference():
    rng = random.Random(3)
    for bits in (list(range(64)), list(range(5, 35))):
        masks = simhash.covering_masks(bits, 3)
        assert len(masks) == 15 and max(m.bit_count() for m in masks) - min(m.bit_count() for m in masks) <= 8
        for _ in range(2000):
            d = sum(1 << b for b in rng.sample(bits, 3))
            assert any(m & d == 0 for m in masks)


def test_hubs_connect_what_pairs_connect():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 20, (400, 3), dtype=np.uint64)
    fps = np.unique(np.concatenate([b ^ np.bitwise_xor.reduce(flips, axis=1) for b in base] + [base]))
    pairs = simhash._components(len(fps), *np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3))
    assert (simhash._components(len(fps), *simhash._hub_links(fps, 3)) == pairs).all()


@pytest.mark.parametrize("small", [simhash.SMALL, 4])
def test_simhash_components(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(5)
    base = [words_text(rng, 80) for _ in range(15)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(15, 120):
        t = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            t[rng.randrange(len(t))] = "new"
        rows.append((i, " ".join(t).upper() if i % 3 else "\t".join(t)))
    rows += [(200, None), (201, "  "), (202, "one"), (203, "One"), (204, "a b"), (204, "a b"), (None, "a b")]
    fps = {(i, t): brute_fingerprint(t) for i, t in rows if i is not None}
    pairs = [(a, b) for (a, _), x in fps.items() for (b, _), y in fps.items() if (x ^ y).bit_count() <= 3]
    want = least_reachable({i for i, _ in fps}, pairs)
    got = simhash.simhash_components(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted((i, f"{fps[i, t]:016x}", want[i]) for i, t in rows if i is not None)
    assert simhash.simhash_components(frame(spark, rows).limit(0)).count() == 0


def brute_remove(rows, window):
    first = {}
    for i, t in rows:
        w = (t or "").split()
        for at in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[at : at + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        w = (t or "").split()
        gone = {at + k for at in range(len(w) - window + 1) if i is not None and first[tuple(w[at : at + window])] < i for k in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for at, x in enumerate(w) if at not in gone)))
    return out


@pytest.mark.parametrize("shard", [substring_dedup.SHARD, 0, 300])
def test_substring_dedup(spark, monkeypatch, shard):
    monkeypatch.setattr(substring_dedup, "SHARD", max(1, shard))
    rng = random.Random(6)
    passage = words_text(rng, 25)
    rows = []
    for i in range(60):
        t = words_text(rng, rng.randrange(60), 30 if i % 4 else 2)
        rows.append((i, f"{t}\n{passage} {words_text(rng, rng.randrange(9))}" if i % 3 == 0 else t))
    rows += [(70, rows[3][1]), (71, rows[3][1]), (71, rows[3][1]), (72, "na " * 90), (73, "na " * 70), (74, None), (75, ""), (None, rows[3][1]), (2, "short")]
    got = substring_dedup.remove_repeats(frame(spark, rows), window=12).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, str(r))) == sorted(brute_remove(rows, 12), key=lambda r: (r[0] is None, str(r)))
    assert substring_dedup.remove_repeats(frame(spark, rows).limit(0)).count() == 0


def test_fm_index_owners():
    rng = random.Random(2)
    for _ in range(30):
        window, sigma = rng.choice([1, 2, 3, 8]), rng.choice([3, 40])
        texts = [[rng.randrange(1, sigma) for _ in range(rng.randrange(25))] for _ in range(rng.randrange(1, 15))]
        texts += [texts[0][:10] + texts[-1][3:]] * 2
        owners, least = np.array([rng.randrange(100) for _ in texts]), {}
        for t, o in zip(texts, owners):
            for i in range(len(t) - window + 1):
                least[tuple(t[i : i + window])] = min(least.get(tuple(t[i : i + window]), 1000), o)
        for t, g in zip(texts, window_owners(texts, owners, sigma, window)):
            assert g.tolist() == [least[tuple(t[i : i + window])] for i in range(len(t) - window + 1)]


def near(rng, x, cosine):
    z = rng.standard_normal(len(x))
    z -= z @ x * x
    return cosine * x + np.sqrt(1 - cosine**2) * z / np.linalg.norm(z)


@pytest.mark.parametrize("block", [embedding_dedup.BLOCK, 8])
def test_embedding_components(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(7)
    base = [v / np.linalg.norm(v) for v in rng.standard_normal((30, 64))]
    vecs = [*base, *[near(rng, base[i % 3], 0.99) * rng.uniform(0.1, 9) for i in range(60)], *[near(rng, base[5 + i % 20], 0.8) for i in range(20)], base[4], base[4]]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vecs)]
    odd = [(900, None), (901, []), (902, [0.0] * 64), (903, [float("nan")] * 64), (904, [float("inf")] + [1.0] * 63), (905, [None] + [1.0] * 63), (906, [1.0, 0.0]), (907, [2.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in [*rows, *odd, (None, rows[0][1])]], "vec_id long, embedding array<float>, rep string, cell int")
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(x @ x.T >= 0.9)
    pairs = [(i, j) for i, j in zip(a.tolist(), b.tolist()) if i != j] + [(906, 907), (907, 906)]
    want = least_reachable([i for i, _ in [*rows, *odd]], pairs)
    n = {i: sum(p[0] == i for p in pairs) for i in want}
    got = embedding_dedup.embedding_components(df).collect()
    assert sorted(tuple(r) for r in got) == sorted((i, n[i], want[i], i == want[i]) for i in want)
    assert embedding_dedup.embedding_components(df.limit(0)).count() == 0


def test_lattice_recall_at_the_threshold():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lattice = embedding_dedup.Lattice()
    for cosine, least in ((0.9, 0.9), (0.95, 0.99)):
        y = np.array([near(rng, v, cosine) for v in x])
        a, b = lattice.keys(x), lattice.keys(y)
        met = np.zeros(len(x), dtype=bool)
        for t in range(lattice.tables):
            met |= (a[:, t, :1] == b[:, t]).any(axis=1) | (b[:, t, :1] == a[:, t]).any(axis=1)
        assert met.mean() >= least


def signed(n):
    """Words of n bytes that alternate by the parity of their place's bits, and their mirror: polynomial hashes modulo 2**64 can't tell them apart."""
    return tuple("".join("ab"[(i.bit_count() + k) % 2] for i in range(n)) for k in (0, 1))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_that_share_a_polynomial_hash_are_told_apart(spark, n):
    a, b = signed(n)
    head, tail = [f"h{i}" for i in range(30)], [f"t{i}" for i in range(30)]
    docs = frame(spark, [(1, " ".join([*head, a, *tail])), (2, " ".join([*head, b, *tail])), (3, " ".join([*head, b, *tail, "x"]))])
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs, 50).collect()}
    assert got == {1: 0, 2: 0, 3: 61}


def test_digests_see_words_and_their_borders():
    import pyarrow as pa

    from kiln.llm.words import digests, joined, words_of

    w = words_of(pa.array(["a  b\tcd", "", "a b cd", "ab  cd", None]))
    assert bytes(joined(w)[0]) == b"a b cd a b cd ab cd "
    first = np.array([0, 3, 6])
    x, y, z = digests(w, first, np.array([3, 6, 8]))
    assert x == y != z
