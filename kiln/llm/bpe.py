"""Byte-level BPE encoding by speculation and verification, and decoding.

Greedy longest match proposes the tokens of a pre-token. A sequence is the BPE
encoding exactly if every adjacent pair of its tokens is: two tokens are
compatible when merging their concatenation from single bytes yields the two
again. The adjacent pairs of all proposals of a batch are tested at once
against a sorted table of verdicts; unknown pairs are decided once and join the
table. Only pre-tokens with a failing pair undergo exact merging.

The tokenizer file (vocabulary, merges, pre-token pattern, added tokens) is
read on the driver and sent to the tasks; its size is fixed.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from kiln.llm.common import chunks, compact

#: Letters and numbers that Unicode took in after version 16, by which the
#: public pre-tokenizer goes; for it they are neither.
NEWER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D),
    (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB),
    (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5),
    (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479),
]
_NEW = "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in NEWER) + "]"
LETTER, NUMBER, OTHER = rf"[\p{{L}}--{_NEW}]", rf"[\p{{N}}--{_NEW}]", rf"[[^\s\p{{L}}\p{{N}}]{_NEW}]"
#: The published pre-token pattern of byte-level BPE.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?{LETTER}+| ?{NUMBER}+| ?{OTHER}+|\s+(?!\S)|\s+"
#: A text of which no space stands before white space or the end is cut before every
#: space without a change to its pre-tokens (a superset of white space is on the safe side).
UNEVEN = r" ([\s\x0b\x1c-\x1f\x{85}\p{Z}]|\z)"
#: Parts that are letters and then ASCII punctuation without an apostrophe: two pre-tokens.
MARKED = r"^(?P<word> ?\p{L}+)(?P<mark>[!-&(-/:-@\[-`{-~]+)$"
BATCH = 1 << 20  # bytes of texts encoded together (one text at least); output batches stay small as well
SHORT = 24
NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the bytes: visible Latin-1 stands for itself, the rest follows U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model, alphabet = spec["model"], byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.id_of = {raw(t): i for t, i in model["vocab"].items() if t not in self.added}
        self.bytes_of = {i: t for t, i in self.id_of.items()} | {i: t.encode() for t, i in self.added.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(self.id_of[raw(a)], self.id_of[raw(b)]): (n, self.id_of[raw(a) + raw(b)]) for n, (a, b) in enumerate(pairs)}
        keys = np.array([a << 32 | b for a, b in self.rank] or [-1], dtype=np.int64)
        order = np.argsort(keys)
        self.pairs, self.pair_rank = keys[order], order
        self.made = np.array([made for _, made in self.rank.values()] or [-1], dtype=np.int64)
        self.single = [self.id_of[bytes([b])] for b in range(256)]
        self._grow_trie()
        self.split = regex.compile(PATTERN, regex.V1)
        pre = json.dumps(spec.get("pre_tokenizer") or {})
        self.prefix_space = '"add_prefix_space": true' in pre
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.known = np.zeros(0, dtype=np.int64)  # sorted pairs left << 32 | right
        self.fits = np.zeros(0, dtype=bool)
        size = 1 + max(self.bytes_of)
        self.written = pa.array([b"%d," % i for i in range(size)], pa.large_binary())  # ids as text, a comma behind
        self.spelled = pa.array([self.bytes_of.get(i, b"") for i in range(size)], pa.large_binary())

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Exact encodings: lowest rank first, leftmost among equals."""
        out: list = [None] * len(words)
        short = sorted((i for i, w in enumerate(words) if len(w) <= SHORT), key=lambda i: len(words[i]))
        for lo in range(0, len(short), 1 << 14):
            block = short[lo : lo + (1 << 14)]
            for i, ids in zip(block, self._merge_matrix([words[i] for i in block])):
                out[i] = ids
        for i, w in enumerate(words):
            if out[i] is None:
                out[i] = self._merge_long([self.single[b] for b in w])
        return out

    def _merge_matrix(self, words: list[bytes]) -> list[list[int]]:
        """Many short words at once: a row per word, one merge per row and round."""
        sizes = np.array([len(w) for w in words])
        width = int(sizes.max(initial=1))
        ids = np.full((len(words), width + 1), -1, dtype=np.int64)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids[np.arange(width + 1) < sizes[:, None]] = np.array(self.single)[flat]
        rank = self._ranks(ids[:, :-1], ids[:, 1:])
        rows = np.arange(len(words))
        column = np.arange(width + 1)
        live, live_ids, live_rank = rows, ids, rank
        while len(live):
            at = live_rank.argmin(axis=1)
            best = live_rank[np.arange(len(live)), at]
            more = best < NEVER
            if not more.all():
                ids[live[~more]] = live_ids[~more]
                live, live_ids, live_rank, at, best = live[more], live_ids[more], live_rank[more], at[more], best[more]
                if not len(live):
                    break
            r = np.arange(len(live))
            # close the gap: what stands right of the merged pair moves left by one
            take = column + (column > at[:, None])
            take[take > width] = width
            live_ids = np.take_along_axis(live_ids, take, axis=1)
            live_ids[:, width] = -1
            live_ids[r, at] = self.made[best]
            live_rank = np.take_along_axis(live_rank, take[:, :-1].clip(max=width - 1), axis=1)
            live_rank[:, width - 1] = NEVER
            live_rank[r, at] = self._ranks(live_ids[r, at], live_ids[r, np.minimum(at + 1, width)])
            back = at > 0
            live_rank[r[back], at[back] - 1] = self._ranks(live_ids[r[back], at[back] - 1], live_ids[r[back], at[back]])
        return [row[:n].tolist() for row, n in zip(ids, (ids >= 0).sum(axis=1).tolist())]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, ``NEVER`` if it has none (or an id is -1)."""
        pairs = a << 32 | b
        at = np.searchsorted(self.pairs, pairs)
        at[at == len(self.pairs)] = 0
        return np.where((self.pairs[at] == pairs) & (a >= 0) & (b >= 0), self.pair_rank[at], NEVER)

    def _merge_long(self, ids: list[int | None]) -> list[int]:
        """By a heap over a linked list."""
        left, right = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        heap = []

        def push(i: int) -> None:
            j = right[i]
            if j < len(ids) and (r := self.rank.get((ids[i], ids[j]))):
                heapq.heappush(heap, (r[0], i, ids[i], ids[j], r[1]))

        for i in range(len(ids) - 1):
            push(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue  # either was merged meanwhile
            ids[i], ids[j] = made, None
            right[i] = right[j]
            if right[j] < len(ids):
                left[right[j]] = i
            push(i)
            if left[i] >= 0:
                push(left[i])
        return [i for i in ids if i is not None]

    def _grow_trie(self) -> None:
        """Tokens as a trie: sorted edges (node << 8 | byte), their children, and the token that ends at each node."""
        nodes, edges = {b"": 0}, {}
        token = [-1]
        for t, i in self.id_of.items():
            at = 0
            for n in range(1, len(t) + 1):
                to = nodes.get(t[:n])
                if to is None:
                    to = nodes[t[:n]] = len(token)
                    token.append(-1)
                    edges[at << 8 | t[n - 1]] = to
                at = to
            token[at] = i
        keys = np.fromiter(edges, dtype=np.int64, count=len(edges))
        order = np.argsort(keys)
        self.edges, self.children = keys[order], np.fromiter(edges.values(), dtype=np.int64, count=len(edges))[order]
        self.token = np.array(token, dtype=np.int64)

    def propose(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of many words at once: all walk the trie byte by byte.

        Word k is ``data[first[k]:first[k + 1]]``; its tokens are ``ids[at[k]:at[k + 1]]`` of the returned pair.
        """
        data = np.append(data, np.uint8(0))
        who = np.flatnonzero(first[1:] > first[:-1])
        at, end = first[who], first[who + 1]
        node, best, stop = np.zeros(len(who), dtype=np.int64), np.zeros(len(who), dtype=np.int64), at.copy()
        owners, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(who):
            key = node << 8 | data[at]
            edge = np.searchsorted(self.edges, key)
            edge[edge == len(self.edges)] = 0
            hit = (self.edges[edge] == key) & (at < end)
            node = np.where(hit, self.children[edge], 0)
            found = self.token[node]
            at = at + hit
            ended = hit & (found >= 0)
            best = np.where(ended, found, best)
            stop = np.where(ended, at, stop)
            miss = ~hit
            if miss.any():  # the longest token is known: go on behind it
                owners.append(who[miss])
                tokens.append(best[miss])
                at = np.where(miss, stop, at)
                live = ~(miss & (stop == end))
                if not live.all():
                    who, end, at, node, best, stop = who[live], end[live], at[live], node[live], best[live], stop[live]
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], np.searchsorted(owner[order], np.arange(len(first)))

    def _verdicts(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each pair (left << 32 | right) is compatible."""
        unique, back = np.unique(pairs, return_inverse=True)
        at = np.searchsorted(self.known, unique)
        at[at == len(self.known)] = 0
        new = unique[self.known[at] != unique] if len(self.known) else unique
        if len(new):
            two = [[p >> 32, p & 0xFFFFFFFF] for p in new.tolist()]
            fits = np.array([x == y for x, y in zip(self.merge([self.bytes_of[a] + self.bytes_of[b] for a, b in two]), two)])
            order = np.argsort(all_pairs := np.concatenate([self.known, new]), kind="stable")
            self.known, self.fits = all_pairs[order], np.concatenate([self.fits, fits])[order]
            at = np.searchsorted(self.known, unique)
        return self.fits[at][back]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of pre-tokens."""
        ids, at = self.encode_array(pa.array(words, pa.large_string()))
        flat = ids.tolist()
        return [flat[a:b] for a, b in zip(at.tolist(), at[1:].tolist())]

    def encode_array(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens one after the other, and where each word's begin."""
        data, first = _bytes(words)
        flat, at = self.propose(data, first)
        owner = np.repeat(np.arange(len(words)), np.diff(at))
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        ok = self._verdicts(flat[inside] << 32 | flat[inside + 1]) if len(inside) else np.zeros(0, bool)
        fail = np.unique(owner[inside[~ok]])
        if not len(fail):
            return flat, at
        exact = self.merge([data[a:b].tobytes() for a, b in zip(first[fail].tolist(), first[fail + 1].tolist())])
        sizes = np.diff(at)
        good = np.ones(len(words), dtype=bool)
        good[fail] = False
        sizes[fail] = [len(x) for x in exact]
        to = np.concatenate(([0], np.cumsum(sizes)))
        out = np.empty(to[-1], dtype=np.int64)
        out[np.repeat(good, sizes)] = flat[good[owner]]
        out[np.repeat(~good, sizes)] = np.fromiter(chain.from_iterable(exact), dtype=np.int64, count=int(sizes[fail].sum()))
        return out, to

    def pieces(self, text: str) -> list[str | tuple[str]]:
        """Pre-tokens as strings, added tokens as tuples of one string."""
        if self.specials is None or not self.specials.search(text):
            return self._split(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [*self._split(text[at : m.start()]), (m.group(),)]
            at = m.end()
        return out + self._split(text[at:])

    def _split(self, text: str) -> list[str]:
        return self.split.findall(text)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none) one after the other, and where each text's begin; added tokens match as such.

        Texts are cut before spaces where that leaves their pre-tokens as they are;
        every distinct part, and every distinct pre-token, is handled once a batch.
        """
        texts = compact(texts)
        if self.prefix_space:
            texts = pc.replace_substring_regex(texts, r"\A([^ ])", r" \1")
        odd = pc.match_substring_regex(texts, UNEVEN)
        for content in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, content))
        odd = odd.to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        tails = cut.flatten()
        n = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.concatenate(([0], np.cumsum(n)))
        head = np.zeros(len(tails), dtype=bool)
        head[starts[:-1]] = True  # a cut text has one part at least
        spaced = pc.binary_join_element_wise(pc.if_else(pa.array(head), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())), tails, pa.scalar("", pa.large_string()))
        parts = pa.concat_arrays([spaced, texts.filter(pa.array(odd))]).dictionary_encode()
        number = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ids, at = self._encode_parts(parts.dictionary)
        # where the parts of each text stand in ``number``
        order = np.argsort(odd, kind="stable")
        begin = np.empty(len(odd) + 1, dtype=np.int64)
        sizes = np.empty(len(odd), dtype=np.int64)
        sizes[order] = np.concatenate([n, np.ones(int(odd.sum()), dtype=np.int64)])
        begin = np.empty(len(odd), dtype=np.int64)
        begin[order] = np.concatenate([starts[:-1], len(tails) + np.arange(int(odd.sum()))])
        number = number[_ranges(begin, sizes)]
        size = np.diff(at)[number]
        ends = np.concatenate(([0], np.cumsum(size)))
        return ids[_ranges(at[number], size)], ends[np.concatenate(([0], np.cumsum(sizes)))]

    def _encode_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts one after the other, and where each part's begin."""
        begin, sizes = np.zeros(len(parts), dtype=np.int64), np.ones(len(parts), dtype=np.int64)
        letters = pc.utf8_is_alpha(pc.replace_substring_regex(parts, "^ ", "")).to_numpy(zero_copy_only=False)
        one = np.flatnonzero(letters)  # letters after at most one space are one pre-token
        begin[one] = np.arange(len(one))
        rest = np.flatnonzero(~letters)
        marked = pc.extract_regex(parts.take(pa.array(rest)), MARKED)
        plain = pc.is_null(marked).to_numpy(zero_copy_only=False)
        two, rest = rest[~plain], rest[plain]
        begin[two], sizes[two] = len(one) + 2 * np.arange(len(two)), 2
        marked = marked.filter(pa.array(~plain))
        both = pa.concat_arrays([marked.field("word"), marked.field("mark")])
        both = both.take(pa.array(np.arange(2 * len(two)).reshape(2, -1).T.reshape(-1)))

        words: list[str] = []
        special: list[tuple[int, int]] = []
        done = len(one) + 2 * len(two)
        for k, p in zip(rest.tolist(), parts.take(pa.array(rest)).to_pylist()):
            found = self.pieces(p)
            begin[k], sizes[k] = done + len(words), len(found)
            for x in found:
                if isinstance(x, tuple):
                    special.append((done + len(words), self.added[x[0]]))
                words.append("" if isinstance(x, tuple) else x)
        coded = pa.concat_arrays([parts.take(pa.array(one)), both, pa.array(words, pa.large_string())]).dictionary_encode()
        ids, at = self.encode_array(coded.dictionary)
        number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        size, start = np.diff(at)[number], at[number]
        if special:  # added tokens are ids of their own
            where, which = np.array(special).T
            start[where], size[where] = len(ids) + np.arange(len(which)), 1
            ids = np.concatenate([ids, which])
        of_part = _ranges(begin, sizes)
        size, start = size[of_part], start[of_part]
        ends = np.concatenate(([0], np.cumsum(size)))
        return ids[_ranges(start, size)], ends[np.concatenate(([0], np.cumsum(sizes)))]

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, added tokens matched as such."""
        ids, at = self.encode_texts(pa.array(texts, pa.string()))
        flat = ids.tolist()
        return [flat[a:b] for a, b in zip(at.tolist(), at[1:].tolist())]

    def spell(self, tokens: pa.Array, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """Of each text the strings of its tokens, ``written`` or ``spelled``, joined."""
        data, first = _bytes(tokens.take(pa.array(ids)))
        raw, edges = data.tobytes(), first[at].tolist()
        return [raw[a:b] for a, b in zip(edges, edges[1:])]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, added tokens included; invalid UTF-8 is replaced."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def utf8(raw: bytes) -> bytes:
    """Bytes of the text that ``raw`` decodes to (invalid parts replaced)."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode()


def _bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of large strings one after the other, and where each begins."""
    first = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    data = strings.buffers()[2] if len(strings) else None
    data = np.frombuffer(data, dtype=np.uint8)[first[0] : first[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, first - first[0]


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``begin[0], ..., begin[0] + size[0] - 1, begin[1], ...``"""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


_loaded: dict[int, Bpe] = {}


def loaded(spec: str) -> Bpe:
    """The encoder of a tokenizer file, one per worker process."""
    if (key := hash(spec)) not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(spec)
    return _loaded[key]


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "token_ids", check_col: str | None = None) -> DataFrame:
    """``docs`` with the token ids of each text (null: none) in a new column.

    With ``check_col`` a second new column tells whether the ids decode to the
    text. Every other column is passed on; columns of the new names are replaced.
    """

    def make(texts, bpe):
        ids, at = bpe.encode_texts(texts)
        out = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))]
        if check_col:
            back = bpe.spell(bpe.spelled, ids, at)
            out.append(pa.array([utf8(x) == (t or "").encode() for x, t in zip(back, texts.to_pylist())], pa.bool_()))
        return out

    more = f"`{ids_col}` array<int>" + (f", `{check_col}` boolean" if check_col else "")
    return _batches(docs.drop(ids_col, *[check_col] * bool(check_col)), tokenizer, more, make, text_col)


def decode(docs: DataFrame, tokenizer: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of each id list (null: empty) in a new column."""

    def make(lists, bpe):
        return [pa.array([bpe.decode(ids or []) for ids in lists.to_pylist()], pa.string())]

    return _batches(docs.drop(text_col), tokenizer, f"`{text_col}` string", make, ids_col)


def encode_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: encodes, decodes and digests in one pass."""

    def digests(texts, bpe):
        ids, at = bpe.encode_texts(texts)
        listed = [hashlib.sha256(x[:-1]).hexdigest() for x in bpe.spell(bpe.written, ids, at)]
        decoded = [hashlib.sha256(utf8(x)).hexdigest() for x in bpe.spell(bpe.spelled, ids, at)]
        return [pa.array(np.diff(at), pa.int64()), pa.array(listed, pa.string()), pa.array(decoded, pa.string())]

    out = _batches(docs.select(id_col, text_col), tokenizer, "n_tokens long, ids_sha256 string, decoded_sha256 string", digests, text_col)
    return out.drop(text_col) if text_col != id_col else out


def _batches(docs: DataFrame, tokenizer: str, more: str, make, col: str) -> DataFrame:
    """``docs`` with the columns that ``make(column, bpe)`` returns for its column ``col``.

    ``tokenizer`` is the path of the file on the driver. Columns are addressed
    by name, so ``docs`` must not repeat one.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(more).fields])

    def task(batches):
        bpe = loaded(spec.value)
        for batch in batches:
            given = batch.column(col)
            for lo, hi in chunks(given, BATCH) if pa.types.is_string(given.type) else [(0, batch.num_rows)]:
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, *make(part.column(col), bpe)], names=schema.names)

    return docs.mapInArrow(task, schema)
