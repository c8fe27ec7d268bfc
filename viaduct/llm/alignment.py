"""Cross-tokenizer alignment with sparse incidence products.

Two tokenizers read the same bytes (a blank and the text). Their tokens are rows of
two token-byte incidence matrices ``A`` and ``B`` in CSR form; the Gustavson row product
``A B^T`` gives the links (tokens whose byte ranges overlap, with the number of shared bytes).
Offsets where tokens of both end cut the bytes into groups; with ``G`` the
token-group incidence, the row sizes of ``G_A G_B^T`` count the pairs that share a group.

Work per text. A text is cut before each white space that follows another character.
No token of either vocabulary goes over such a cut (checked when the vocabularies are
loaded; texts with the few characters for which it doesn't hold are one segment), so
segments are independent: they are tokenised and multiplied once per worker, in batches,
and kept in a bounded cache.

Corpus counts. A pair of ids counts the rows of the corpus that hold it linked. A map task
closes a shard after about ``SHARD_BYTES`` of text and writes, beside its documents (links as positions in
the shard's list of distinct pairs), that list with the number of documents of each pair. Spark sums
the lists by pair, finds each A id's highest count, joins the sums back to the shards' lists and
brings list and documents of a shard together. So a pair that every document holds
costs one row per shard, documents are shuffled once as packed
numbers, and no table is collected or broadcast. Written tables cut the lineage.

Defined results: texts that are null, empty, or that one of the tokenizers doesn't give back byte by
byte have no tokens: zeros and empty groups; rows that repeat an id are documents of their own, also
in the counts; a null id stays null; special tokens inside texts are plain text; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_arrow, staged

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
SHARD_BYTES = 16 << 20
CACHE_SEGMENTS = 300_000
# Longer segments are read anew each time.
CACHE_CHARS = 64
# Segments that are read together, in characters.
BLOCK_CHARS = 1 << 16


class Csr:
    """Sparse matrix by rows: columns of row i are ``indices[indptr[i]:indptr[i + 1]]``."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, columns: int) -> None:
        self.indptr, self.indices, self.columns = indptr, indices, columns

    @classmethod
    def of_lengths(cls, lengths: np.ndarray) -> Csr:
        """Row i holds the next ``lengths[i]`` columns."""
        indptr = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        return cls(indptr, np.arange(indptr[-1]), int(indptr[-1]))

    @classmethod
    def of_members(cls, member: np.ndarray, columns: int) -> Csr:
        """Row i holds the one column ``member[i]``."""
        return cls(np.arange(len(member) + 1), member, columns)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        count = np.bincount(self.indices, minlength=self.columns)
        return Csr(np.concatenate([[0], np.cumsum(count)]).astype(np.int64), self.rows()[order], len(self.indptr) - 1)

    def product_sizes(self, other: Csr) -> np.ndarray:
        """Terms that each row of the product adds up (the symbolic half of the row product)."""
        terms = np.concatenate([[0], np.cumsum(np.diff(other.indptr)[self.indices])])
        return terms[self.indptr[1:]] - terms[self.indptr[:-1]]

    def product(self, other: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, value) of the product, rows and columns rising: row i adds up the rows of ``other`` that its columns name."""
        size = np.diff(other.indptr)[self.indices]
        first = np.repeat(other.indptr[self.indices] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        column = other.indices[first + np.arange(size.sum())]
        row = np.repeat(self.rows(), size)
        key, value = np.unique(row * max(other.columns, 1) + column, return_counts=True)
        return key // max(other.columns, 1), key % max(other.columns, 1), value


def byte_letters() -> dict[str, int]:
    """Byte of each letter of the byte-level alphabet: visible Latin-1 stands for itself, the other bytes, in order, for the letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(hidden)}


# Of a segment: its numbers of A tokens, B tokens, groups and pairs that share a group (32-bit each), its links (A id in the
# upper, B id in the lower half of 64 bits), and its groups as text, a semicolon before each.
Segment = tuple[bytes, bytes, str]


class Aligner:
    """Both tokenizers and the segments met so far."""

    def __init__(self, file_a: str = TOKENIZER_A, file_b: str = TOKENIZER_B) -> None:
        import re

        import public_tokenizers
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        place = lambda f: f if os.path.isabs(f) else public_tokenizers.path(f)
        self.a = Tokenizer.from_file(place(file_a))
        self.a.encode_special_tokens = True
        letters = byte_letters()
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.bytes_a = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=place(file_b))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.blank = self.b.piece_to_id("▁")
        self.text_a, self.text_b = [str(i) for i in range(size)], [str(i) for i in range(len(pieces))]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # White space (in some definition) that ends no segment: other control characters, and what B's pieces hold inside.
        inside = {c for i, p in enumerate(pieces) if not self.b.is_byte(i) for c in p if c.isspace()}
        joined = any(c == "▁" and p[k] != "▁" for p in pieces for k, c in enumerate(p[1:]))
        odd = "".join(sorted(inside | set("\x1c\x1d\x1e\x1f\x85᠎﻿")))
        self.odd = re.compile("(?s)." if joined or self.blank == self.b.unk_id() else f"[{re.escape(odd)}]").search
        self.cut = re.compile(r"\s*\S+|\s+").findall
        self.known: dict[str, Segment | None] = {}

    def segments(self, text: str) -> list[str]:
        """Of a blank and the text."""
        return [" " + text] if self.odd(text) else self.cut(" " + text)

    def ids_b(self, segment: str) -> list[int]:
        """B puts a blank before what it reads: the first one of a segment is left to it, or taken off again."""
        if segment == " ":
            return [self.blank]
        if segment[0] == " ":
            return self.b.encode(segment[1:])
        ids = self.b.encode(segment)
        return ids[1:] if ids[:1] == [self.blank] else [self.b.unk_id()]

    def same_bytes(self, raw: bytes, a: list[int], b: list[int]) -> bool:
        return raw == b"".join([self.bytes_a[i] for i in a]) == b"".join([self.bytes_b[i] for i in b])

    def alone(self, segment: str) -> Segment | None:
        """A segment by itself; None where one of the tokenizers doesn't give the bytes back."""
        a, b = self.a.encode(segment, add_special_tokens=False).ids, self.ids_b(segment)
        raw = segment.encode("utf-8", "surrogatepass")
        return self.multiplied(a, b, [len(raw)])[0] if self.same_bytes(raw, a, b) else None

    def together(self, segments: list[str]) -> list[Segment | None]:
        """Segments that may follow each other, read as one text."""
        text = "".join(segments)
        a, b = self.a.encode(text, add_special_tokens=False).ids, self.ids_b(text)
        if not self.same_bytes(text.encode("utf-8", "surrogatepass"), a, b):
            return [self.alone(s) for s in segments]
        return self.multiplied(a, b, [len(s) if s.isascii() else len(s.encode("utf-8", "surrogatepass")) for s in segments])

    def multiplied(self, ids_a: list[int], ids_b: list[int], lengths: list[int]) -> list[Segment]:
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        matrix_a, matrix_b = Csr.of_lengths(self.length_a[a]), Csr.of_lengths(self.length_b[b])
        row, column, _ = matrix_a.product(matrix_b.transposed())
        pairs = (a[row] << 32 | b[column]).tobytes()
        end_a, end_b = matrix_a.indptr[1:], matrix_b.indptr[1:]
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        shared = Csr.of_members(group_a, len(cuts)).product_sizes(Csr.of_members(group_b, len(cuts)).transposed())
        # Tokens by group, A's first, each with the sign before it: ; opens a group, | its B tokens.
        opens_a = np.diff(group_a, prepend=-1) > 0
        opens_b = np.diff(group_b, prepend=-1) > 0
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        written = [
            sign + text[i] for signs, ids, text in ((np.where(opens_a, ";", ","), ids_a, self.text_a), (np.where(opens_b, "|", ","), ids_b, self.text_b))
            for sign, i in zip(signs.tolist(), ids, strict=True)
        ]
        written = [written[i] for i in order.tolist()]
        # Segment boundaries are cuts, so each segment is a range of tokens, links and groups.
        ends = np.cumsum(lengths)
        last_a, last_b = np.searchsorted(end_a, ends) + 1, np.searchsorted(end_b, ends) + 1
        last_group = np.searchsorted(cuts, ends) + 1
        last_shared = np.concatenate([[0], np.cumsum(shared)])[last_a]
        numbers = np.diff(np.stack([last_a, last_b, last_group, last_shared], 1), axis=0, prepend=0).astype("<i4").tobytes()
        links = (8 * np.searchsorted(row, last_a)).tolist()
        words = (last_a + last_b).tolist()
        out, low_link, low_word = [], 0, 0
        for n, (link, word) in enumerate(zip(links, words, strict=True)):
            out.append((numbers[16 * n : 16 * n + 16], pairs[low_link:link], "".join(written[low_word:word])))
            low_link, low_word = link, word
        return out

    def learn(self, segments: list[str], into: dict[str, Segment | None]) -> None:
        block: list[str] = []
        size = 0
        for s in segments:
            if s[-1].isspace() or self.odd(s):
                into[s] = self.alone(s)
                continue
            block.append(s)
            size += len(s)
            if size > BLOCK_CHARS:
                into.update(zip(block, self.together(block), strict=True))
                block, size = [], 0
        if block:
            into.update(zip(block, self.together(block), strict=True))

    def texts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, str] | None]:
        """(the four numbers, links, groups) of each text; None for texts without tokens."""
        if len(self.known) > CACHE_SEGMENTS:
            self.known.clear()
        known = self.known
        parts = [self.segments(t) if t else [] for t in texts]
        new = set().union(*parts).difference(known)
        own: dict[str, Segment | None] = {}
        self.learn(sorted(s for s in new if len(s) <= CACHE_CHARS), known)
        self.learn(sorted(s for s in new if len(s) > CACHE_CHARS), own)
        for segments in parts:
            found = [known[s] if s in known else own[s] for s in segments] if own else [known[s] for s in segments]
            if not found or None in found:
                yield None
                continue
            numbers, links, groups = zip(*found, strict=True)
            yield np.frombuffer(b"".join(numbers), "<i4").reshape(-1, 4).sum(0, dtype=np.int64), np.frombuffer(b"".join(links), np.int64), "".join(groups)[1:]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(file_a: str, file_b: str) -> Aligner:
    """One pair of tokenizers per worker."""
    if (file_a, file_b) not in _aligners:
        _aligners[file_a, file_b] = Aligner(file_a, file_b)
    return _aligners[file_a, file_b]


def squeezed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, their bytes by significance, compressed."""
    return pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8)
    return planes.reshape(4, n).T.copy().view("<u4").ravel()


_COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]
_ANALYSED = "shard long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups string, n_pairs int, pairs binary, times binary, list_codes array<long>, list_docs array<int>"


def _analyser(file_a: str, file_b: str):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(file_a, file_b)
        shard = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal shard, rows, held, size
            codes, docs = np.unique(np.concatenate([h[0] for h in held]), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            packed = []
            for own, times in held:
                at = np.searchsorted(codes, own)
                packed.append((len(own), squeezed(np.diff(at, prepend=0)) if len(own) else b"", squeezed(times) if len(own) else b""))
            out = [pa.array([shard] * len(rows), pa.int64())]
            out += [pa.array([r[i] for r in rows], pa.int64()) for i in range(6)]
            out += [pa.array([r[6] for r in rows], pa.string())]
            out += [pa.array([p[0] for p in packed], pa.int32()), pa.array([p[1] for p in packed], pa.binary()), pa.array([p[2] for p in packed], pa.binary())]
            out += [pa.nulls(len(rows), pa.list_(pa.int64())), pa.nulls(len(rows), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(out, _NAMES)
            # The shard's list of pairs, in rows of bounded length (positions go on from row to row).
            for low in range(0, len(codes), 1 << 16):
                some = slice(low, low + (1 << 16))
                lists = [pa.array([codes[some]], pa.list_(pa.int64())), pa.array([docs[some].astype(np.int32)], pa.list_(pa.int32()))]
                nothing = [pa.nulls(1, t) for t in (*[pa.int64()] * 6, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int64()), *nothing, pa.array([low], pa.int32()), *[pa.nulls(1, pa.binary())] * 2, *lists], _NAMES
                )
            shard, rows, held, size = shard + 1, [], [], 0

        for whole in batches:
            for low in range(0, whole.num_rows, 64):
                batch = whole.slice(low, 64)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids = batch.column("doc_id").to_pylist()
                for doc_id, text, found in zip(ids, texts, align.texts(texts), strict=True):
                    if found is None:
                        rows.append((doc_id, 0, 0, 0, 0, 0, ""))
                        held.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    else:
                        (n_a, n_b, n_groups, n_shared), links, groups = found
                        held.append(np.unique(links, return_counts=True))
                        rows.append((doc_id, n_a, n_b, n_groups, len(links), n_shared, groups))
                    size += len(text)
                    if size >= SHARD_BYTES or len(rows) >= 65_536:
                        yield from close()
        if rows:
            yield from close()

    return scan


_NAMES = ["shard", "doc_id", *_COUNTS, "groups", "n_pairs", "pairs", "times", "list_codes", "list_docs"]


def _scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with n_best and count_sum; rows come sorted by shard, its list of pairs first, in order."""
    shard, parts, table = None, [], None
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        kind = batch.column("kind").to_numpy()
        turn = np.flatnonzero(np.concatenate([[True], (shards[1:] != shards[:-1]) | (kind[1:] != kind[:-1])]))
        out = []
        for low, high in zip(turn, [*turn[1:], batch.num_rows], strict=True):
            if shards[low] != shard:
                shard, parts, table = shards[low], [], None
            if kind[low] == 0:
                some = batch.slice(low, high - low)
                parts.append((some.column("docs").to_numpy(), some.column("best").to_numpy(zero_copy_only=False)))
                continue
            if table is None:
                table = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1)]
                parts = []
            some = batch.slice(low, high - low)
            scores = []
            for n, pairs, times in zip(*(some.column(c).to_pylist() for c in ("n_pairs", "pairs", "times")), strict=True):
                if not n:
                    scores.append((0, 0))
                    continue
                at, many = np.cumsum(unsqueezed(pairs, n), dtype=np.int64), unsqueezed(times, n).astype(np.int64)
                scores.append((int(many[table[1][at].astype(bool)].sum()), int((many * table[0][at]).sum())))
            n_best, count_sum = (pa.array([s[i] for s in scores], pa.int64()) for i in (0, 1))
            columns = [some.column(c) for c in ("doc_id", *_COUNTS)]
            out.append(pa.RecordBatch.from_arrays([*columns, n_best, count_sum, some.column("groups")], _RESULT_NAMES))
        yield from out


_RESULT_NAMES = ["doc_id", *_COUNTS, "n_best", "count_sum", "groups"]
_RESULT = ", ".join(f"{c} long" for c in _RESULT_NAMES[:-1]) + ", groups string"


def alignments(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B,
    digest: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_group_links, n_best, count_sum, groups, the last as
    ``a1,a2|b1;a3|b2,b3`` or, with ``digest``, the SHA-256 of that ('' without tokens).
    Pairs: a, b (ids), docs (documents that hold them linked), best (no other b has more for that a).
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    analysed = map_arrow(rows, _analyser(tokenizer_a, tokenizer_b), _ANALYSED)
    if digest:
        analysed = analysed.withColumn("groups", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))
    analysed = staged(analysed, "alignment")
    lists = analysed.where("list_codes IS NOT NULL").select(
        "shard", F.col("n_pairs").alias("low"), F.posexplode(F.arrays_zip("list_codes", "list_docs")).alias("at", "pair")
    )
    lists = lists.select("shard", (F.col("low") + F.col("at")).alias("at"), F.col("pair.list_codes").alias("code"), F.col("pair.list_docs").alias("docs"))
    counts = lists.groupBy("code").agg(F.sum(F.col("docs").cast("long")).alias("docs"))
    counts = staged(counts.select("code", F.shiftright("code", 32).alias("a"), "docs"), "alignment-counts")
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    pairs = counts.join(top, "a").select("a", "code", "docs", (F.col("docs") == F.col("top")).alias("best"))
    replies = lists.select("shard", "at", "code").join(pairs.select("code", "docs", "best"), "code")
    empty = {c: F.lit(None).cast(t) for c, t in analysed.dtypes if c not in ("shard", "list_codes", "list_docs")}
    replies = replies.select("shard", F.lit(0).alias("kind"), "at", "docs", "best", *[c.alias(n) for n, c in empty.items()])
    own = analysed.where("list_codes IS NULL").select(
        "shard", F.lit(1).alias("kind"), F.lit(0).alias("at"), F.lit(0).cast("long").alias("docs"), F.lit(False).alias("best"), *empty
    )
    both = replies.unionByName(own).repartition("shard").sortWithinPartitions("shard", "kind", "at")
    pairs = pairs.select("a", F.col("code").bitwiseAND(0xFFFFFFFF).alias("b"), "docs", "best")
    return map_arrow(both, _scored, _RESULT), pairs


def op12_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    result, _ = alignments(documents(spark, sf_dir), digest=True)
    return result.withColumnRenamed("groups", "groups_sha256")
