"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

import pyarrow as pa
import pytest

from kiln.llm import bpe
from kiln.llm.queries import byte_bpe


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    with open(byte_bpe(), encoding="utf-8") as f:
        return bpe.Bpe(f.read()), Tokenizer.from_file(byte_bpe())


def differing(both, texts):
    own, lib = both
    want = [x.ids for x in lib.encode_batch(texts, add_special_tokens=False)]
    return [t for t, a, b in zip(texts, own.encode_batch(texts), want) if a != b]


def test_every_code_point_is_split_as_by_the_library(both):
    points = [*range(0xD800), *range(0xE000, 0x34000), *range(0xE0000, 0xE1000), 0x10FFFF]
    texts = [f"ab{c}cd {c}e 12{c}34 !{c}! {c}{c}," for c in map(chr, points) if c != "\0"]
    assert differing(both, texts) == []


def test_random_texts(both):
    rng = random.Random(7)
    pick = [" ", " ", "\n", "\t", "  ", "'s", "'", "a", "the", "Zé", "ß", "日", "١", "12", "²", "!", ".,", "🙂", " ", " ", "\x1c", "\x85", "́", "<|", "<|endoftext|>", "ʼ", "ª"]
    texts = ["".join(rng.choice(pick) for _ in range(rng.randrange(0, 40))) for _ in range(10_000)]
    assert differing(both, texts) == []
    words = [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 14))) for _ in range(30)) for _ in range(400)]
    assert differing(both, words) == []


def test_long_words_and_texts(both):
    rng = random.Random(3)
    texts = ["x" * 70_000, "ab" * 30_000 + " tail", "".join(rng.choice("abc") for _ in range(20_000)), " " * 9000 + "b", "word " * 40_000, "é" * 5000]
    assert differing(both, texts) == []


def test_digests_and_decoding_of_slices(both):
    own, lib = both
    texts = pa.array(["first", "A b, c.", None, "", "tail  end ", "naïve <|endoftext|> x"]).slice(1)
    ids, at = own.encode_texts(texts)
    for k, t in enumerate(texts.to_pylist()):
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert ids[at[k] : at[k + 1]].tolist() == want
        assert own.spell(own.written, ids, at)[k] == "".join(f"{i}," for i in want).encode()
        assert own.spell(own.spelled, ids, at)[k].decode() == lib.decode(want, skip_special_tokens=False)


def test_digest_rows(spark, both):
    _, lib = both
    rows = [(1, "Hello there", 5), (1, "Hello there", 5), (None, None, 6), (3, " \n", None)]
    got = bpe.encode_digests(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), byte_bpe()).collect()
    want = []
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.encode_digests(spark.createDataFrame([], "doc_id long, text string"), byte_bpe()).count() == 0
