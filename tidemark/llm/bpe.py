"""Byte-pair encoding and decoding with a contiguous rank array.

A word is a short array of parts; beside it lies the array of the ranks of neighbouring pairs. Each step scans the ranks for their
minimum (the leftmost on ties), deletes the boundary of that pair and looks up the two neighbouring ranks anew, until no pair has a
rank. All new words of a batch take their steps together: one row of the arrays a word, one numpy operation a step. Words over
``WIDE`` parts are merged one at a time with a heap over a linked list, which gives the same merges in O(n log n).

The vocabulary is a file for the tokenizers library of the kind "word BPE": NFC, lower case, split into letters, single digits and other
runs, byte symbols, and an end-of-word mark. Encoded words are kept in a cache of bounded size.

Null and empty texts: no ids, empty decoding. Repeated rows give repeated results. Texts are taken whole, whatever their length.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from . import common

WIDE = 64
#: Words in a worker's cache; when it is full, it starts anew.
CACHE = 300_000
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte: itself where printable, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 0
    for b in range(256):
        letters.append(chr(b if b in plain else 256 + extra))
        extra += b not in plain
    return letters


class WordBpe:
    """Encodes and decodes as the tokenizers library does with the same file (no special tokens added)."""

    def __init__(self, path: str, cache: int = CACHE):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.cache_size = spec["model"], cache
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.final = np.array([vocab[x + suffix] for x in letters], np.int32)
        # (left, right) -> rank and merged id, in a sorted array of left * 2**20 + right
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        codes = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks, self.merged = codes[order], order.astype(np.int32), merged
        self.table = {int(c): r for r, c in enumerate(codes)}
        self.token = [""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for t, i in vocab.items():
            self.token[i] = t
        self.special = {}
        for t in spec["added_tokens"]:
            self.token[t["id"]] = t["content"]
            self.special[t["content"]] = t["id"]
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        # Letters beyond the Latin blocks: the library itself says how they are normalised and split, as its Unicode version may differ.
        self.library, self.beyond, self.byte = Tokenizer.from_file(path), regex.compile(r"[^\x00-\u024f]").search, {x: b for b, x in enumerate(letters)}
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.cache: dict[str, bytes] = {}

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        return np.where(self.codes[at] == code, self.ranks[at], NONE)

    def merge_rows(self, parts: np.ndarray, n: np.ndarray) -> None:
        """Merges in place; row i has n[i] parts, n falls as boundaries go."""
        rows, width = parts.shape
        ranks = np.full((rows, max(1, width - 1)), NONE, np.int32)
        if width > 1:
            ranks[:] = self.lookup(parts[:, :-1], parts[:, 1:])
            ranks[np.arange(width - 1)[None, :] >= (n - 1)[:, None]] = NONE
        live = np.arange(rows)
        while len(live):
            at = ranks[live].argmin(1)
            best = ranks[live, at]
            going = best != NONE
            live, at, best = live[going], at[going], best[going]
            if not len(live):
                return
            # delete the boundary after part `at`: what stands behind moves one place forward
            keep = np.arange(width - 1)[None, :]
            source = keep + (keep > at[:, None])
            parts[live, : width - 1] = np.take_along_axis(parts[live], source, 1)
            parts[live, at] = self.merged[best]
            source = np.minimum(source, width - 2)
            moved = np.take_along_axis(ranks[live], source, 1)
            n[live] -= 1
            ranks[live] = moved
            ranks[live, n[live] - 1] = NONE
            # refresh the neighbours
            has = at > 0
            r, a = live[has], at[has]
            ranks[r, a - 1] = self.lookup(parts[r, a - 1], parts[r, a])
            has = at + 1 < n[live]
            r, a = live[has], at[has]
            ranks[r, a] = self.lookup(parts[r, a], parts[r, a + 1])

    def merge_long(self, parts: list[int]) -> list[int]:
        after, before, table = [*range(1, len(parts)), -1], [-1, *range(len(parts) - 1)], self.table
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(parts) - 1) if (r := table.get(parts[i] << 20 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        dead = bytearray(len(parts))
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if dead[i] or j < 0 or parts[i] != left or parts[j] != right:
                continue
            parts[i], dead[j], after[i] = int(self.merged[rank]), 1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := table.get(parts[a] << 20 | parts[b])) is not None:
                    heapq.heappush(heap, (r, a, parts[a], parts[b]))
        return [p for p, d in zip(parts, dead, strict=True) if not d]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each of some pre-tokenised, non-empty words, without the cache."""
        raw = [w.encode() for w in words]
        size = np.array([len(r) for r in raw])
        out: list = [None] * len(raw)
        for i in np.flatnonzero(size > WIDE):
            b = np.frombuffer(raw[i], np.uint8)
            out[i] = np.array(self.merge_long([*self.inner[b[:-1]].tolist(), int(self.final[b[-1]])]), np.uint32)
        # rows of like width together, so that padding stays small
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 20), (20, 32), (32, WIDE)):
            some = np.flatnonzero((size > low) & (size <= high))
            if len(some):
                n = size[some].copy()
                parts = np.zeros((len(some), high), np.int32)
                flat = np.frombuffer(b"".join(raw[i] for i in some), np.uint8)
                row, start = np.repeat(np.arange(len(some)), n), np.repeat(np.cumsum(n) - n, n)
                column = np.arange(len(flat)) - start
                parts[row, column] = np.where(column == n[row] - 1, self.final[flat], self.inner[flat])
                self.merge_rows(parts, n)
                parts = parts.astype(np.uint32)
                for i, p, k in zip(some.tolist(), parts, n.tolist(), strict=True):
                    out[i] = p[:k]
        return out

    def chunks(self, text: str) -> list:
        """Runs without white space, in order, lower case; an int stands for a special token, a tuple for a run that is split already."""
        if self.split_special is not None and any(s in text for s in self.special):
            return [c for part in self.split_special.split(text) for c in ([self.special[part]] if part in self.special else self.chunks_of(part))]
        return self.chunks_of(text)

    def chunks_of(self, text: str) -> list:
        if self.beyond(text):
            normal = self.library.normalizer.normalize_str(text)
            return [tuple(bytes(self.byte[x] for x in p).decode() for p, _ in self.library.pre_tokenizer.pre_tokenize_str(run)) for run in normal.split(" ") if run]
        text = unicodedata.normalize("NFC", text).lower()
        # str.split() also splits at U+001C to U+001F, which are no white space here
        return text.split() if not any(c in text for c in "\x1c\x1d\x1e\x1f") else [c for c in regex.split(r"\s+", text) if c]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self.chunks(t or "") for t in texts]
        cache, met = self.cache, set().union(*split)
        new = met.difference(cache)
        if len(cache) + len(new) > self.cache_size:
            cache.clear()
            new = met
        words = {}
        for c in [c for c in new if isinstance(c, int)]:
            cache[c] = np.array([c], np.uint32).tobytes()
            new.discard(c)
        pieces = {c: c if isinstance(c, tuple) else (c,) if c.isalpha() else self.pieces(c) for c in new}
        for ps in pieces.values():
            for p in ps:
                words.setdefault(p, len(words))
        ids = [x.astype("<u4").tobytes() for x in self.encode_words(list(words))]
        for c, ps in pieces.items():
            cache[c] = b"".join([ids[words[p]] for p in ps])
        return [b"".join(map(cache.__getitem__, chunks)) for chunks in split]

    def decode(self, ids: bytes) -> str:
        """The tokens with a space between: what decode() gives for a file without a decoder."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) for each row."""

    def make():
        bpe = WordBpe(vocabulary)

        def f(ids, texts):
            coded = bpe.encode_batch(texts)
            return [ids, [len(c) // 4 for c in coded], coded]

        return f

    return common.map_rows(df, [id_col, text_col], {"doc_id": "long", "n_tokens": "long", "ids": "binary"}, make)


def decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: the ids of each row decoded; null ids give an empty text."""

    def make():
        bpe = WordBpe(vocabulary)
        return lambda rows, ids: [rows, [bpe.decode(i or b"") for i in ids]]

    return common.map_rows(df, [id_col, ids_col], {"doc_id": "long", "text": "string"}, make)


def digests(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding, then decoding of the same ids, without the ids and texts themselves."""

    def make():
        bpe = WordBpe(vocabulary)

        def f(ids, texts):
            coded = bpe.encode_batch(texts)
            return [ids, [len(c) // 4 for c in coded], [hashlib.sha256(c).hexdigest() for c in coded], [hashlib.sha256(bpe.decode(c).encode()).hexdigest() for c in coded]]

        return f

    return common.map_rows(df, [id_col, text_col], {"doc_id": "long", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}, make)
