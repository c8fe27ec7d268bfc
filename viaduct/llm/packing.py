"""Packing token sequences with Karmarkar-Karp multiway differencing.

A map task tokenises its documents and packs them in shards of about
``SHARD_WINDOWS`` windows, so no token is ever shuffled and a task holds
one shard. Documents longer than a window give full windows first. What is
left is divided into the smallest possible number of windows by multiway
differencing: partial partitions with the largest spread are merged, large
sums against small ones, which gives near-equal windows. If the largest window
exceeds the capacity, left-overs are first cut at their binary digits (finer
parts level better), then the window count rises until the windows fit.
Parts of one document that meet in one window are joined again.

A sequence never leaves its task; ``sequence_id`` is the partition number in
the upper bits and a running number. A lost task is run again on the same
input split and gives the same rows.

Tokens: a whole text is split at blanks and line feeds, where the tokeniser's
pre-tokens end anyway; ids of words and of pre-tokens are kept in bounded
per-worker caches. Words outside plain Latin, and texts that spell a special
token, go through the tokeniser itself.

Defined results: null and empty texts are the closing id alone; rows that
repeat an id are packed as documents of their own; a null id stays null; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_arrow, text_or_empty, worker_cache

CAPACITY = 2048
CLOSING_ID = 1
SHARD_WINDOWS = 64
CACHE_WORDS = 500_000
TOKENIZER = "word_bpe_49k.json"

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_TYPES = [pa.int64()] * 7
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

# Fixed value: the pre-token pattern of the vocabulary file.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words that lower-case and compose the same way everywhere.
PLAIN = r"[\x21-\x7e\xa1-įı-ɏ]+"


# Byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes, in order, for the letters from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_BYTE_LETTERS = {b: 256 + n for n, b in enumerate(_HIDDEN)}


class Encoder:
    """Ids of a text as packed little-endian 32-bit numbers."""

    def __init__(self, file: str = TOKENIZER) -> None:
        import public_tokenizers
        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file if os.path.isabs(file) else public_tokenizers.path(file))
        self.tokenize = self.tokenizer.model.tokenize
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.find = regex.compile(PRE_TOKEN).findall
        self.plain = regex.compile(PLAIN).fullmatch
        self.pieces: dict[str, bytes] = {}
        encoder = self

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                ids = encoder.word(word)
                if len(self) < CACHE_WORDS:
                    self[word] = ids
                return ids

        self.words = Words()

    def packed(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of a lower-cased pre-token."""
        if not piece.isascii():
            piece = piece.encode("utf-8").decode("latin-1").translate(_BYTE_LETTERS)
        return np.array([t.id for t in self.tokenize(piece)], "<u4").tobytes()

    def word(self, word: str) -> bytes:
        if not self.plain(word):
            return self.packed(word) if word else b""
        out = []
        for piece in self.find(word.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                if len(self.pieces) >= 2 * CACHE_WORDS:
                    self.pieces.clear()
                ids = self.pieces[piece] = self.piece(piece)
            out.append(ids)
        return b"".join(out)

    def text(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.packed(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


_encoders: dict[str, Encoder] = {}
worker_cache(__name__, _encoders.clear)


def encoder(file: str = TOKENIZER) -> Encoder:
    """One encoder per worker."""
    if file not in _encoders:
        _encoders[file] = Encoder(file)
    return _encoders[file]


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: item numbers of k windows with near-equal sums."""
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = size
        heap.append((-size, i, sums, [(i,)] + [()] * (k - 1)))
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)
        _, _, b, b_items = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        items = [(x, y) if x and y else x or y for x, y in zip(a_items, reversed(b_items), strict=True)]
        sums = sums[order]
        sums -= sums[-1]
        heapq.heappush(heap, (-int(sums[0]), tie, sums, [items[j] for j in order]))
        tie += 1
    windows = []
    for tree in heap[0][3] if heap else []:
        flat, todo = [], [tree]
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo.extend(node)
            else:
                flat.append(node)
        windows.append(sorted(flat))
    return windows


def binary_parts(length: int, least: int = 8) -> list[int]:
    """A length cut at its binary digits; what is below ``least`` stays with the last part."""
    parts, bit = [], 1 << max(length.bit_length() - 1, 0)
    while bit >= least and length >= least:
        if length >= bit:
            parts.append(bit)
            length -= bit
        bit >>= 1
    if length:
        parts = parts[:-1] + [parts[-1] + length] if parts else [length]
    return parts


def pack_parts(parts: list[tuple[int, int, int]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of parts (document, start, length), each window at most ``capacity``."""
    total = sum(p[2] for p in parts)
    k = -(-total // capacity)
    fine: list[tuple[int, int, int]] = []
    for doc, start, length in parts:
        for n in binary_parts(length):
            fine.append((doc, start, n))
            start += n
    attempt = parts
    while True:
        windows = differencing([p[2] for p in attempt], k)
        if max((sum(attempt[i][2] for i in w) for w in windows), default=0) <= capacity:
            break
        if attempt is fine:
            k += 1
        attempt = fine
    out = []
    for window in windows:
        joined: list[tuple[int, int, int]] = []
        for doc, start, length in sorted(attempt[i] for i in window):
            if joined and joined[-1][0] == doc and joined[-1][1] + joined[-1][2] == start:
                joined[-1] = (doc, joined[-1][1], joined[-1][2] + length)
            else:
                joined.append((doc, start, length))
        if joined:
            out.append(joined)
    return out


def _packer(capacity: int, closing: int, file: str):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file).text
        end = np.array([closing], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 33
        shard: list[tuple] = []
        tokens = 0

        def close():
            nonlocal sequence
            full, rest = [], []
            for d, (_, ids) in enumerate(shard):
                n = len(ids) // 4
                cut = n - n % capacity
                full.extend([(d, s, capacity)] for s in range(0, cut, capacity))
                if cut < n:
                    rest.append((d, cut, n - cut))
            rows = []
            for window in full + pack_parts(rest, capacity):
                offset = 0
                for d, start, length in window:
                    doc_id, ids = shard[d]
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    rows.append((doc_id, start, length, crc, len(ids) // 4, sequence, offset))
                    offset += length
                sequence += 1
            shard.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)

        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encode(text) + end
                shard.append((doc_id, ids))
                tokens += len(ids) // 4 % capacity
                if tokens >= SHARD_WINDOWS * capacity or len(shard) >= 4096:
                    yield close()
                    tokens = 0
        if shard:
            yield close()

    return pack


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    closing: int = CLOSING_ID, tokenizer: str = TOKENIZER,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    return map_arrow(rows, _packer(capacity, closing, tokenizer), _SCHEMA)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
