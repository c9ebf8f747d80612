import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing

from .conftest import EDGE_IDS, EDGE_TEXTS

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


def random_texts(n, seed):
    r = random.Random(seed)
    parts = ["a", "B", " ", "  ", "\n", "\n\n\n", "é", "É", "Σ", "1", "23", "'s", "'re", "!", "...", "\t", "\x1c", "\x85", " ", "word", "longerword", "ß", "日本", "🎉", "İ", "á", "<|endoftext|>", "<|startoftext|>"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(14))) for _ in range(n)]


def test_word_ids_equal_the_library(word):
    coder, texts = bpe.WordBpe(WORD, cache=50), [t or "" for t in EDGE_TEXTS] + random_texts(3000, 3)
    for at in range(0, len(texts), 200):
        for t, got in zip(texts[at : at + 200], coder.encode_batch(texts[at : at + 200]), strict=True):
            want = word.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(got, "<u4").tolist() == want, t
            assert coder.decode(got) == word.decode(want, skip_special_tokens=False)


def test_every_letter_splits_as_in_the_library(word):
    coder = bpe.WordBpe(WORD)
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(1, 0x3000)]
    for t, got, want in zip(texts, coder.encode_batch(texts), word.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == want.ids, t


def test_long_words_merge_as_short_ones(word):
    coder = bpe.WordBpe(WORD)
    for t in ("ab" * 40, "thethere" * 30, "é" * 70):
        assert np.frombuffer(coder.encode_batch([t])[0], "<u4").tolist() == word.encode(t, add_special_tokens=False).ids


def test_byte_ids_equal_the_library(byte):
    coder, texts = packing.ByteBpe(BYTE, cache=50), [t or "" for t in EDGE_TEXTS] + random_texts(5000, 4)
    for t, got in zip(texts, coder.encode_batch(texts), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == byte.encode(t, add_special_tokens=False).ids, t


def test_bpe_rows(edge, empty, word):
    got = bpe.digests(edge, WORD).collect()
    want = []
    for i, t in zip(EDGE_IDS, EDGE_TEXTS, strict=True):
        ids = word.encode(t or "", add_special_tokens=False).ids
        text = word.decode(ids, skip_special_tokens=False) if ids else ""
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe.digests(empty, WORD).count() == 0
    back = bpe.decode(bpe.encode(edge, WORD), WORD)
    assert back.count() == len(EDGE_IDS)


def test_packing(edge, empty, make, byte):
    assert packing.pack(empty, BYTE).count() == 0
    for df in (edge, make([t for t in EDGE_TEXTS] * 3, parts=5)):
        pieces = packing.pack(df, BYTE, window=64, with_ids=True).collect()
        assert all(p.length > 0 and p.ids_crc32 == zlib.crc32(bytes(p.ids)) and p.length * 4 == len(p.ids) for p in pieces)
        # every sequence but the last is full and has no gaps
        by = {}
        for p in pieces:
            by.setdefault(p.sequence_id, []).append((p.offset, p.length))
        for s, found in by.items():
            end = 0
            for offset, n in sorted(found):
                assert offset == end
                end += n
            assert end == 64 or s == max(by)
        assert sorted(by) == list(range(len(by)))
        # the stream holds each document's ids and the end id
        stream = np.concatenate([np.frombuffer(bytes(p.ids), "<u4") for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset))]).tolist()
        want = sorted(byte.encode(r.text or "", add_special_tokens=False).ids + [0] for r in df.collect())
        assert len(stream) == sum(map(len, want))
        docs, start = [], None
        for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
            ids = np.frombuffer(bytes(p.ids), "<u4").tolist()
            if p.start == 0:
                docs.append([])
            assert p.start == len(docs[-1])
            docs[-1] += ids
        assert sorted(docs) == want and start is None
