"""Scoring, mixing, encoding and formatting operators against brute force or held-out rows."""

import hashlib
import json
import random
import zlib

import pytest

from kiln.llm import bpe, chat_format, language_id, mixing, secrets, toxicity
from kiln.llm.queries import QUERIES, byte_bpe, public_pieces

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    texts = ["", None, "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "  x \n\n y\t", "I'S don't 'll", "日本語 🙂🙂 é", "ab" * 2000, " " * 400 + "b", "\x00\x01", "١٢٣ 12 ²"]
    texts += ["".join(rng.choice("ab cdeé\n'srt1<|🙂") for _ in range(rng.randrange(1, 150))) for _ in range(150)]
    lib = Tokenizer.from_file(byte_bpe())
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[5], "again")], "doc_id long, text string, token_ids string")
    got = bpe.encode(docs, byte_bpe(), check_col="same").collect()
    for r in got:
        assert r.same and r.token_ids == lib.encode(r.text or "", add_special_tokens=False).ids
    back = bpe.decode(bpe.encode(docs, byte_bpe()), byte_bpe()).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert bpe.encode(docs.limit(0), byte_bpe()).count() == 0


def test_bpe_merges_agree(spark):
    b = bpe.Bpe(open(byte_bpe()).read())
    rng = random.Random(2)
    for _ in range(300):
        w = bytes(rng.choice(b"theaionrs ") for _ in range(rng.randrange(1, 24)))
        assert b.merge([w])[0] == b._merge_long([b.single[x] for x in w]) == b.encode_words([w.decode()])[0]


@pytest.mark.parametrize("seed", range(8))
def test_min_cost_flow_by_enumeration(seed):
    rng = random.Random(seed)
    supply, quota = [rng.randrange(1, 4) for _ in range(2)], [rng.randrange(5) for _ in range(2)]
    arcs = [(p, s) for p in range(2) for s in range(2) if rng.random() < 0.8]
    flow = mixing.min_cost_flow(supply, quota, arcs, 2)
    best = None

    def price(x):
        return sum(max(0, n - supply[p]) for p in range(2) for n in [sum(v for (q, _), v in x.items() if q == p)])

    def walk(k, x):
        nonlocal best
        if any(sum(v for (q, _), v in x.items() if q == p) > 2 * supply[p] for p in range(2)):
            return
        if any(sum(v for (_, t), v in x.items() if t == s) > quota[s] for s in range(2)):
            return
        if k == len(arcs):
            best = min(best or (1, 0), (-sum(x.values()), price(x)))
            return
        for n in range(7):
            walk(k + 1, {**x, arcs[k]: n})

    walk(0, {})
    assert (-sum(flow.values()), price(flow)) == best


def test_mixing_targets_and_uses(spark):
    rng = random.Random(3)
    names = ["b", "a", "Z", None, "é", "a/1"]
    rows = [(i, " ".join(["w"] * rng.randrange(1, 40)), names[i % 6], 1) for i in range(1200)] + [(5000, None, "b", 1), (5001, "", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, uses int")
    mix, targets = mixing.mix_documents(docs)
    got = mix.collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in mixing.mix_documents(docs)[0].collect())
    size = {n: sum(len(t.split()) for _, t, s, _ in rows if s == n and t) for n in names}
    order = sorted(n for n in names if n is not None) + [None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(order)}
    want, left, free = {}, 1.5 * sum(size.values()), set(names)
    while free:
        level = left / sum(weight[n] for n in free)
        full = {n for n in free if level * weight[n] > 2 * size[n]}
        if not full:
            want |= {n: level * weight[n] for n in free}
            break
        want |= {n: 2.0 * size[n] for n in full}
        left -= sum(want[n] for n in full)
        free -= full
    assert {r.source: r.target for r in targets.collect()} == pytest.approx(want)
    for n in names:
        mine = [r for r in got if r.sources == [n]]
        assert abs(sum(r.uses * r.size for r in mine) - want[n]) <= 40 and all(0 <= r.uses <= 2 for r in mine)
    assert mixing.mix_documents(docs.limit(0))[0].count() == 0


def test_mixing_overlapping_sources(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, "w " * 10, i % 3) for i in range(300)], "doc_id long, text string, k int")
    s = F.when(F.col("k") == 0, F.array(F.lit("a"))).when(F.col("k") == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b")))
    mix, targets = mixing.mix_documents(docs, sources=s)
    assert sum(r.uses * r.size for r in mix.collect()) == pytest.approx(sum(r.target for r in targets.collect()), abs=30)


def test_language_id_held_out(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = QUERIES["op7_language_id"](spark, MEDIUM).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.98
    model = language_id.fit(docs.limit(200), public_pieces(), rounds=1)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "the and of the" * 200), (4, "the")], "doc_id long, text string")
    out = [(r.doc_id, r.lang_pred, r.score) for r in language_id.predict(odd, model).collect()]
    assert out[:3] == [(i, "und", 0.0) for i in (1, 2, 3)] and all(0 <= s <= 1 for _, _, s in out)
    empty = language_id.fit(docs.limit(0), public_pieces())
    assert {r.lang_pred for r in language_id.predict(odd, empty).collect()} == {"und"}


def test_toxicity(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        words = [f"w{rng.randrange(300)}" for _ in range(40)] + (rng.sample(["vilex", "vileyes", "grimm"], 2) if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), "x", 0.5))
        if i < 900:
            labels += [(i, int(i % 7 != 0), int(toxic))] * (1 + i % 2)
    docs = spark.createDataFrame([*rows, (9000, None, "x", 0.5), (9001, "", "x", 0.5), (None, "vilex grimm", "x", 0.5)], "doc_id long, text string, lang string, p_toxic double")
    truth = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, truth).collect()
    held = [r for r in got if r.doc_id is not None and 900 <= r.doc_id < 1500]
    assert all(r.toxic == (r.doc_id % 5 == 0) for r in held)
    assert {r.doc_id: r.toxic for r in got if r.doc_id is None or r.doc_id > 8999} == {9000: False, 9001: False, None: True}
    assert not any(r.toxic for r in toxicity.toxicity(docs, truth.limit(0)).collect())
    assert toxicity.toxicity(docs.limit(0), truth).count() == 0


def test_secret_scan(spark):
    rng = random.Random(5)
    value = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows, secret = [], set()
    for i in range(200):
        if i % 2:
            v = value()
            secret.add(i)
            rows.append((i, f'some words token = "{v}" and more', "src/app.conf"))
        else:
            rows.append((i, rng.choice([f"call {rng.randrange(10**15, 10**16)} now", f"commit {value()} merged"]), None))
    docs = spark.createDataFrame([*rows, (900, None, "p"), (901, "", "p"), (902, "no digits inthislongword", "p"), (1, rows[1][1], "src/app.conf")], "doc_id long, text string, value string")
    from pyspark.sql import functions as F

    got = secrets.scan(docs, path=F.col("value")).collect()
    assert {r.doc_id for r in got if r.is_secret} == secret and {r.doc_id for r in got} == set(range(200))
    assert len(got) == 201 and secrets.scan(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(rows[1][1].split('"')[1], 1)], "value string, label int")
    assert all(r.is_secret for r in secrets.scan(docs, labels=one).collect())


def test_secrets_without_digits_short_or_with_marks(spark):
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(n))
    rows = [(i, f'set password = "{letters(16)}" and go on') for i in range(60)] + [(100 + i, f"Remark: {w} of the day is here") for i, w in enumerate(["however", "several", "people", "letters"] * 15)]
    odd = {500: ("app password: qhvzmxwtrkplbndf", "qhvzmxwtrkplbndf"), 501: ("password=Tr0ub4d.r&", "Tr0ub4d.r&"), 502: ("set password = 'pfft mnop xzkw qrst' now", "pfft mnop xzkw qrst"),
           503: ("pwd: pa$s!w@o#r~d.x", "pa$s!w@o#r~d.x"), 504: ("secret = 'zqx9'.", "zqx9"), 505: ("token=token", "token")}
    docs = spark.createDataFrame([*rows, *[(i, t) for i, (t, _) in odd.items()], (506, "letters withoutanythingbeside")], "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.scan(docs).collect() if r.doc_id < 500 or r.value_sha256 == hashlib.sha256(odd[r.doc_id][1].encode()).hexdigest()}
    assert set(odd) <= set(got) and 506 not in got and got[502].word == 3
    found = {i for i, r in got.items() if r.is_secret}
    assert {*range(60), 500, 502, 503} <= found and not found & set(range(100, 160))


def test_chat_linking(spark):
    calls = [("c", "a", None, "sum", '{"y": 1, "x": [1, {"b": 2, "a": null}]}'), ("c", "b", "a", "sum", '{"x": "no"}'), ("c", "d", "b", "nope", None),
             ("c", "e", "gone", "sum", "not json"), ("c", "f", "e", "sum", '{"x": [], "z": 1}'), ("c", "p", "q", "sum", "[]"), ("c", "q", "p", "sum", '{"x": [2]}'),
             (None, "n", None, "sum", "{}"), ("c", "a", None, "sum", '{"y": 1, "x": [1, {"b": 2, "a": null}]}'), *[("long", str(i), str(i - 1) if i else None, "sum", '{"x": []}') for i in range(70)]]
    results = [("c", "a", 'say "hi"\n'), ("c", "zz", "lost"), ("c", "b", None), (None, "a", "x")]
    schemas = [("sum", "x", "array", True), ("sum", "y", "number", False), (None, "x", "array", True)]
    df = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    args = (df(calls, "conv_id string, call_id string, after_id string, name string, arguments string"), df(results, "conv_id string, call_id string, content string"), df(schemas, "name string, param string, type string, required boolean"))
    got = {(r.conv_id, r.call_id): r for r in chat_format.link_tool_calls(*args).collect()}
    assert len(got) == 78
    short = {k[1]: (r.position, r.state, r.status, r.errors) for k, r in got.items() if k[0] == "c"}
    assert short == {
        "a": (0, "ok", "answered", []), "b": (1, "ok", "answered", ["wrong type x"]), "d": (2, "ok", "unanswered", ["unknown tool"]),
        "e": (0, "dangling", "unanswered", ["not an object"]), "f": (1, "dangling", "unanswered", ["unexpected z"]),
        "p": (None, "cycle", "unanswered", ["not an object"]), "q": (None, "cycle", "unanswered", []), "zz": (None, None, "orphan", None),
    }
    assert all(got["long", str(i)].position == i for i in range(70))
    want = {"arguments": {"x": [1, {"a": None, "b": 2}], "y": 1}, "content": 'say "hi"\n', "id": "a", "name": "sum", "type": "tool_call"}
    assert got["c", "a"].message == json.dumps(want, separators=(",", ":"), sort_keys=True)
    assert chat_format.link_tool_calls(*[a.limit(0) for a in args]).count() == 0


def test_chat_messages_pass(spark):
    df = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    args = (df([("c", 1, None, "sum", "{}")], "conv_id string, call_id int, after_id int, name string, arguments string"), df([("c", 0, "lost")], "conv_id string, call_id int, content string"), df([("sum", "x", "array", False)], "name string, param string, type string, required boolean"))
    plain = [("c", 0, "system", 'be "kind"'), ("c", 2, None, None), ("c", 2, None, None), (None, None, "critic", "x")]
    got = chat_format.link_tool_calls(*args, df(plain, "conv_id string, call_id int, role string, content string")).collect()
    assert sorted(r.status for r in got) == [*["message"] * 4, "orphan", "unanswered"]
    assert [r.message for r in got if r.status == "message" and r.call_id == 0] == ['{"content":"be \\"kind\\"","id":0,"role":"system","type":"message"}']


def test_every_turn_reaches_the_chat_output(spark):
    import duckdb

    from kiln.llm.queries import ORACLE_SQL

    turns = spark.read.parquet(f"{MEDIUM}/conversations.parquet")
    got = QUERIES["op6_chat_turns"](spark, MEDIUM).collect()
    other = turns.where("role NOT IN ('user', 'assistant')").count()
    assert other > 0 and sum(r.status == "message" for r in got) == other
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{MEDIUM}/conversations.parquet')")
    want = con.execute(f"SELECT conv_id, call_id, position, state, status, errors, message FROM ({ORACLE_SQL['op6_chat_turns']})").fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    # the same turns leave op6_chat_format, one row a turn
    assert sorted(map(str, QUERIES["op6_chat_format"](spark, MEDIUM).collect())) == sorted(map(str, got))
    turns = spark.read.parquet(f"{MEDIUM}/conversations.parquet")
    assert {"system"} <= {r[0] for r in turns.select("role").distinct().collect()} and sum(r.status == "message" for r in got) == turns.where("role NOT IN ('user', 'assistant')").count()


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    from test_dedup import brute_fingerprint, least_reachable

    docs, seen = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        out = corpus_pipeline.keep(out, name)
        seen[name] = docs.collect(), out.collect()
        if name != "bpe":
            assert out.columns == docs.columns
        docs = out
    toxic = {r.doc_id for r in toxicity.toxicity(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")).where("toxic").collect()}
    before, after = seen["toxicity"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - toxic
    before, after = seen["exact_dedup"]
    least = {}
    for r in before:
        key = " ".join(f"|{r.text or ''}|".replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" "))
        least[key] = min(least.get(key, r.doc_id), r.doc_id)
    assert {r.doc_id for r in after} == set(least.values())
    before, after = seen["simhash_near_dedup"]
    fps = {r.doc_id: brute_fingerprint(r.text) for r in before}
    root = least_reachable(fps, [(a, b) for a in fps for b in fps if (fps[a] ^ fps[b]).bit_count() <= 3])
    assert {r.doc_id for r in after} == {i for i in fps if root[i] == i}
    before, after = seen["mixing"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} and len(after) > len(before)
    assert all(r.round_trip and len(r.token_ids) == r.n_tokens for r in seen["bpe"][1]) and len(seen["bpe"][1]) == len(after)
    ones = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", None, 0), (2, "", None, "s", 0), (2, "", None, "s", 0)], spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    for frame in (ones, ones.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, SMALL).count() <= 8


def test_pipeline_dedup_acts_on_rows(spark):
    import corpus_pipeline
    from test_dedup import brute_fingerprint

    rng = random.Random(8)
    text = lambda: " ".join(f"w{rng.randrange(400)}" for _ in range(80))
    a, b, c, d, e, f = (text() for _ in range(6))

    def close(t):
        for at in range(80):
            w = t.split()
            w[at] = "new"
            if 0 < (brute_fingerprint(t) ^ brute_fingerprint(" ".join(w))).bit_count() <= 3:
                return " ".join(w)

    frame = lambda rows: spark.createDataFrame(rows, spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, a, "de", "s", 1), (None, a, "en", "s", 1), (None, b, "en", "s", 1), (None, b, "en", "s", 1), (2, c, "en", "s", 1), (2, d, "en", "s", 1)]
    got = corpus_pipeline.exact(spark, frame(rows), SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([rows[2], rows[4], *rows[6:]], key=repr)
    # 5 stands beside c (near 3) and d (near 9): the first copy goes, of the second pair the smallest stays
    rows = [(3, c, "en", "s", 1), (5, close(c), "en", "s", 1), (5, d, "en", "s", 1), (9, close(d), "en", "s", 1), (None, close(e), "en", "s", 1), (7, e, "en", "s", 1), (None, f, "en", "s", 1)]
    got = corpus_pipeline.near(spark, frame(rows), SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([rows[0], rows[2], rows[5], rows[6]], key=repr)
    # 40 rows without an id of a source that a large one outweighs: the mix decides on each
    rows = [(None, text(), "en", "a", 1) for _ in range(40)] + [(i, text(), "en", "b", 1) for i in range(40)]
    uses = {}
    for r in corpus_pipeline.mix(spark, frame(rows), SMALL).where("doc_id IS NULL").collect():
        uses[r.text] = uses.get(r.text, 0) + 1
    assert max(uses.values(), default=0) == 2
