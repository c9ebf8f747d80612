"""Concatenate and cut: all documents' tokens stand in one stream, cut into windows of a fixed number of tokens.

Pass one tokenises each partition and gives each document its offset inside the partition; the ids go to a table in the shared folder, as
unsigned 16-bit integers. The partitions' token totals, one row a partition, give each partition's offset by a prefix sum. Pass two reads
the table and cuts each document at the windows' borders: every piece is a boundary record (sequence, offset, first and last piece).
Only the last sequence is shorter than the window.

Null and empty texts: the end-of-document id alone. Repeated rows are packed as often as they come. Documents longer than a window
take as many pieces as they need. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .bpe import byte_letters

WINDOW = 1024
#: Words in a worker's cache; when it is full, it starts anew.
CACHE = 300_000
# Fixed value: how byte-level vocabularies of this kind split a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBpe:
    """The ids that the tokenizers library gives for a byte-level BPE file, with add_special_tokens=False.

    The file's merges stand in the order of their ids, so tiktoken's merging of single pieces by rank gives the same ids. Texts are cut
    before each single space and around each single line break, where pieces always end; the runs between are encoded once a batch and
    kept in a cache of bounded size. Texts with other white space or letters beyond the Latin blocks go through the library itself.
    """

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte, vocab = {x: b for b, x in enumerate(byte_letters())}, spec["model"]["vocab"]
        ranks = {bytes(byte[x] for x in t): i for t, i in vocab.items()}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        if [vocab[m] for m in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("the ids of this vocabulary don't follow its merges")
        self.piece = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.library, self.special = Tokenizer.from_file(path), [t["content"] for t in spec["added_tokens"]]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.code = "H" if size <= 65536 else "I"
        self.rare = re.compile("[^\n\x20-\x7e\xa1-\u024f]").search
        self.pieces = regex.compile(SPLIT).findall
        self.cache: dict[str, bytes] = {}
        self.cache_size = cache

    def unusual(self, text: str) -> bool:
        """Whether white space stands otherwise than singly (line breaks: in twos) between words, or letters are beyond the Latin blocks."""
        blank = text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text
        return blank or self.rare(text) is not None or any(s in text for s in self.special)

    def encode_run(self, run: str) -> bytes:
        """Ids of a run of characters without inner white space, one leading space aside."""
        # letters alone, or letters and one mark behind them, need no pattern
        word, piece = run[run[0] == " " :], self.piece
        if word.isalpha():
            return array(self.code, piece(run.encode())).tobytes()
        if word[-1] in ".,!" and word[:-1].isalpha():
            return array(self.code, piece(run[:-1].encode()) + piece(run[-1].encode())).tobytes()
        return array(self.code, [i for p in self.pieces(run) for i in piece(p.encode())]).tobytes()

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids as 16-bit integers (32-bit for vocabularies over 65,536), in this machine's byte order."""
        out, plain, runs = [b""] * len(texts), [], []
        for k, text in enumerate(texts):
            if not text:
                continue
            if self.unusual(text):
                out[k] = array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()
            else:
                plain.append(k)
                runs.append(text.replace("\n", "\x1f\n\x1f").replace(" ", "\x1f ").split("\x1f"))
        met = set().union(*runs)
        new = met.difference(self.cache)
        if len(self.cache) + len(new) > self.cache_size:
            self.cache.clear()
            new = met
        new.discard("")
        self.cache[""] = b""
        encode_run, cache = self.encode_run, self.cache
        for run in new:
            cache[run] = encode_run(run)
        get = cache.__getitem__
        for k, run in zip(plain, runs, strict=True):
            out[k] = b"".join(map(get, run))
        return out


def tokenise(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end: int = 0) -> DataFrame:
    """part, start_in_part, doc_id, doc_tokens, ids: pass one, the end id included; start_in_part counts the tokens before it in its partition."""
    common.find_package(df.sparkSession)
    schema = {"part": "long", "start_in_part": "long", "doc_id": "long", "doc_tokens": "long", "ids": "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, at = ByteBpe(vocabulary), TaskContext.get().partitionId(), 0
        last = array(bpe.code, [end]).tobytes()
        for b in batches:
            for k in range(0, b.num_rows, common.OUT_ROWS):
                ids, texts = (c.to_pylist() for c in b.slice(k, common.OUT_ROWS).columns)
                coded = [c + last for c in bpe.encode_batch(texts)]
                sizes = [len(c) // len(last) for c in coded]
                starts = [at, *(at + np.cumsum(sizes)[:-1]).tolist()] if sizes else []
                at += sum(sizes)
                yield common.batch(schema, [[part] * len(ids), starts, ids, sizes, coded])

    return df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, common.ddl(schema))


PIECES = {"doc_id": "long", "start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long", "sequence_id": "long", "offset": "long", "first_piece": "boolean", "last_piece": "boolean"}


def pack(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row a piece with PIECES, and with the piece's ids (32-bit) if asked for."""
    docs = common.written(tokenise(df, vocabulary, id_col, text_col))
    # One row a partition of the input: the prefix sum over so few rows may run in one task, and they may be broadcast.
    totals = docs.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select(F.col("part"), F.coalesce(before, F.lit(0)).alias("part_start"))
    placed = docs.join(F.broadcast(starts), "part").select("doc_id", "doc_tokens", (F.col("part_start") + F.col("start_in_part")).alias("at"), "ids")
    schema = PIECES | ({"ids": "binary"} if with_ids else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, common.OUT_ROWS):
                rows = []
                for doc, total, at, raw in zip(*(c.to_pylist() for c in b.slice(k, common.OUT_ROWS).columns), strict=True):
                    ids = np.frombuffer(raw, np.uint16 if len(raw) == 2 * total else np.uint32).astype("<u4")
                    start = 0
                    while start < total:
                        sequence, offset = divmod(at + start, window)
                        piece = ids[start : start + window - offset].tobytes()
                        n = len(piece) // 4
                        rows.append((doc, start, n, zlib.crc32(piece), total, sequence, offset, start == 0, start + n == total, *([piece] if with_ids else [])))
                        start += n
                yield common.batch(schema, [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in schema])

    return placed.mapInArrow(run, common.ddl(schema))
