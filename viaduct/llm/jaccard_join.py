"""N-gram Jaccard join with PartEnum signatures.

A document's set holds 64-bit hashes of its distinct ``n``-word shingles (A-Z
lower-cased; with fewer words, the whole sequence is one shingle; without
words, empty and linked with nothing). Two documents link when
``100 * intersection >= percent * union``.

Signatures. Set sizes fall into bands ``[l, u]``, ``u`` being ``WIDTH`` times ``l`` and at
least ``100 l / percent``, so linked sets lie in the same or in neighbouring bands; a
set takes part in the instance of its own band, and of the next one if it is large enough
to link with a set there. In an instance, linked sets differ in at most ``k`` shingles. The shingle
domain is hashed into ``k // 2 + 1 + SPARE`` partitions, so at least ``SPARE + 1`` of them hold at most one
difference. Each is cut into ``CELLS`` cells, and each subset that leaves out one cell is a region: where a partition holds
at most one difference, the sets agree on the region without that cell and share its
signature. A partition whose shingles lie in one cell has an empty region, which says nothing: a set
with at most ``SPARE`` such partitions leaves empty regions out, only sets with more emit them (of ``SPARE + 1`` good
partitions, one then has no empty region in that set, nor in the other where they agree).

Work. Equal sets are one node. Map tasks send signatures as packed numbers, by bucket; a
task orders a bucket's signatures and sends on the nodes that share one, a group. Groups that many signatures
repeat are kept once; a group beyond ``GROUP`` nodes becomes groups of each two of its parts, so no task holds more.
Candidates become links in three steps, each verified by exact intersection of the sets:

1. every node against the smallest leader of its groups;
2. in groups that join several components, all pairs of different components are tested in memory by
   size and parity sketch (each shingle flips one bit, so sketches of linked sets differ in at most as many bits as
   the sets may differ in shingles; this loses no link), and the pairs of a minimum spanning forest of those that
   pass are written: fewer than the group has nodes;
3. in groups that had more such pairs and still join several components, every pair that passes and isn't verified yet is written.

So a large group of alike sets, linked or not, writes pairs in proportion to its size, apart from pairs
of unlinked sets so near the threshold that their sketches can't tell. For
verification members go to their leader's task, a leader with many members to several
tasks of ``PART`` members each. Verified pairs inside one component say nothing more about it and aren't sought: the returned
links are connecting ones (a subset of all links with the same components), not every link.

Defined results: null text is empty; rows that repeat an id with another text
are documents of their own under that id; a null id links with nothing and has a
null component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import bounded_batches, connected_components, documents, joined_components, map_arrow, mix64, staged, text_or_empty

SPARE = 1
CELLS = 3
WIDTH = 1.25
FLUSH_ROWS = 800_000
CHUNK = 1 << 20
# Texts whose sets are in memory together.
TEXTS = 256
# Signatures in a bucket (14 bytes each in its task), nodes in a group, members in a task of a leader.
BUCKET = 500_000
GROUP = 2048
PART = 512
# Bits of a parity sketch, two to four for each shingle.
LEAST_SKETCH, MOST_SKETCH = 256, 65_536
# Ids, and roles of nodes, that may be broadcast (some 10 bytes each); beyond that the join shuffles.
BROADCAST_IDS = 2_000_000
BROADCAST_ROLES = 2_000_000
_P = np.uint64(0x9E3779B97F4A7C15)


# A number for each byte, the same for both cases of A-Z; 0 for white space.
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _P)
_BYTE[65:91] = _BYTE[97:123]
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


class WordHashes(dict):
    """64-bit hashes of words, a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 400_000:
            self.clear()
        self[word] = value
        return value


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte's offset) of each word: a polynomial in random numbers for its bytes."""
    b = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(~_SPACES[b])
    if not len(at):
        return np.zeros(0, np.uint64), at
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
    size = np.diff(np.concatenate([first, [len(at)]]))
    place = np.arange(len(at)) - np.repeat(first, size)
    power = np.cumprod(np.full(int(size.max()), _P, np.uint64), dtype=np.uint64)
    return mix64(np.add.reduceat(_BYTE[b[at]] * power[place], first)), at[first]


def shingle_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Per text the sorted hashes of its distinct ``n``-word shingles; texts are hashed about ``CHUNK`` bytes at a time."""
    out: list[np.ndarray] = []
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    low = 0
    while low < len(raw):
        high, size = low, 0
        while high < len(raw) and (high == low or size + len(raw[high]) <= CHUNK):
            size += len(raw[high]) + 1
            high += 1
        h, at = word_hashes(b" ".join(raw[low:high]))
        ends = np.searchsorted(at, np.cumsum([len(r) + 1 for r in raw[low:high]]))
        begin = 0
        for end in ends.tolist():
            words = h[begin:end]
            begin = end
            if not len(words):
                out.append(words)
                continue
            width = min(n, len(words))
            s = np.full(len(words) - width + 1, width, np.uint64)
            for i in range(width):
                s *= _P
                s += words[i : len(words) - width + 1 + i]
            s = mix64(s)
            s.sort()
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        low = high
    return out


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit fingerprints of a set, as signed numbers."""
    a = np.add.reduce(mix64(s + _P), dtype=np.uint64) + np.uint64(len(s))
    b = np.bitwise_xor.reduce(mix64(s ^ np.uint64(0xD6E8FEB86659FD93)))
    return int(np.int64(a.astype(np.int64))), int(np.int64(b.astype(np.int64)))


def size_bands(largest: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper set size of each band, up to the one after ``largest``."""
    low, high = [], []
    while len(low) < 2 or low[-2] <= largest:
        low.append(high[-1] + 1 if high else 1)
        high.append(max(low[-1], int(WIDTH * low[-1]), 100 * low[-1] // percent))
    return np.array(low, np.int64), np.array(high, np.int64)


def signatures(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, number of its set) of non-empty sets."""
    every = np.array([len(s) for s in sets], np.int64)
    low, high = size_bands(int(every.max()), percent)
    own = np.searchsorted(low, every, "right") - 1
    out_sig, out_set = [], []
    for step in (0, 1):
        # The next band's smallest set links with sets of at least percent / 100 of its size.
        which = np.arange(len(sets)) if step == 0 else np.flatnonzero(100 * every >= percent * low[own + 1])
        if not len(which):
            continue
        sizes, instance = every[which], own[which] + step
        elements = np.concatenate([sets[i] for i in which])
        owner = np.repeat(np.arange(len(which)), sizes)
        # |r - s| + |s - r| <= (1 - t) / (1 + t) * (|r| + |s|), both sizes at most the band's upper end
        k = 2 * high[instance] * (100 - percent) // (100 + percent)
        parts = np.where(k > 0, k // 2 + 1 + SPARE, 1)
        start = np.concatenate([[0], np.cumsum(parts * CELLS)])
        cells = (parts * CELLS).astype(np.uint64)
        # Upper bits of a shingle's hash choose its cell, all bits its value.
        slot = start[owner] + ((elements >> np.uint64(32)) * cells[owner] >> np.uint64(32)).astype(np.int64)
        value = elements * np.uint64(0xE7037ED1A0B428DB)
        value ^= value >> np.uint64(32)
        count = np.bincount(slot, minlength=start[-1]).reshape(-1, CELLS)
        total = np.bincount(slot, value & np.uint64(0xFFFFFFFF), start[-1]).astype(np.uint64)
        total += np.bincount(slot, value >> np.uint64(32), start[-1]).astype(np.uint64) << np.uint64(32)
        total = total.reshape(-1, CELLS)
        # Region c of a partition holds its cells but for c.
        count = count.sum(1, keepdims=True) - count
        total = total.sum(1, keepdims=True, dtype=np.uint64) - total
        thin = (count == 0).any(1)
        of = np.repeat(np.arange(len(which)), parts)
        many = np.bincount(of, thin, len(which)) > SPARE
        # Where no difference is allowed, linked sets are equal and one node.
        use = (((count > 0) | many[of][:, None]) & (k[of] > 0)[:, None]).ravel()
        of = np.repeat(of, CELLS)
        number = np.arange(start[-1]) - start[of]
        total, count = total.ravel(), count.ravel()
        tag = (instance[of[use]] * 1_000_003 + number[use]).astype(np.uint64) * _P + count[use].astype(np.uint64)
        out_sig.append(mix64(total[use] ^ mix64(tag)))
        out_set.append(which[of[use]])
    return np.concatenate(out_sig), np.concatenate(out_set)


def sketch(s: np.ndarray) -> bytes:
    """Parity of the number of shingles that fall on each bit; a longer sketch folds into a shorter one."""
    size = min(max(LEAST_SKETCH, 1 << (2 * len(s) - 1).bit_length()), MOST_SKETCH) if len(s) else LEAST_SKETCH
    bits = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(bool)).tobytes()


def folded(data: bytes, words: int) -> np.ndarray:
    """A sketch as 64-bit words, folded to so many."""
    a = np.frombuffer(data, np.uint64)
    while len(a) > words:
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return a


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, whole.num_rows, TEXTS):
            yield whole.slice(low, TEXTS)


def _info(n: int):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = shingle_sets(batch.column("text").to_pylist(), n)
            prints = [fingerprint(s) if len(s) else (0, 0) for s in sets]
            columns = [
                batch.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([p[0] for p in prints], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "node", "payload"])

    return scan


def _row_nodes(n: int):
    """Rows with the fingerprint of their text's set."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            node = [fingerprint(s)[0] if len(s) else 0 for s in shingle_sets(batch.column("_text").to_pylist(), n)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node, pa.int64())], [*batch.schema.names, "node"])

    return scan


def _binary(lengths: np.ndarray, data: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def _signature_rows(n: int, percent: int, buckets: int):
    """(bucket, sigs, nodes): signatures (their lower six bytes) and nodes, packed by bucket."""

    def pack(sig: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        bucket = ((sig >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sig, node = sig[order], node[order]
        count = np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(count)
        short = np.ascontiguousarray(sig.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), _binary(6 * count[some], short.tobytes()), _binary(8 * count[some], node.tobytes())],
            ["bucket", "sigs", "nodes"],
        )

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sigs, nodes, held = [], [], 0
        for batch in _slices(batches):
            sets, prints = [], []
            for s in shingle_sets(batch.column("text").to_pylist(), n):
                if len(s) and (f := fingerprint(s)[0]) not in seen:
                    seen.add(f)
                    sets.append(s)
                    prints.append(f)
            if not sets:
                continue
            sig, of = signatures(sets, percent)
            sigs.append(sig)
            nodes.append(np.array(prints, np.int64)[of])
            held += len(sig)
            if held > FLUSH_ROWS:
                yield pack(np.concatenate(sigs), np.concatenate(nodes))
                sigs, nodes, held = [], [], 0
        if held:
            yield pack(np.concatenate(sigs), np.concatenate(nodes))

    return scan


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g0, g1, members): sorted nodes that share a signature, each group of a bucket once; rows come sorted by bucket."""

    def shared(sigs: list[bytes], nodes: list[bytes]) -> Iterator[pa.RecordBatch]:
        short = np.frombuffer(b"".join(sigs), np.uint8).reshape(-1, 6)
        sig = np.zeros((len(short), 8), np.uint8)
        sig[:, :6] = short
        sig, node = sig.view("<u8").ravel(), np.frombuffer(b"".join(nodes), np.int64)
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
        sig, node = sig[fresh], node[fresh]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(np.concatenate([first, [len(sig)]]))
        seen: set[bytes] = set()
        held = 0
        for low, many in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            for some in _parts(node[low : low + many]):
                data = some.tobytes()
                if data not in seen:
                    seen.add(data)
                    held += len(some)
                if held > FLUSH_ROWS:
                    yield rows(seen)
                    seen, held = set(), 0
        if seen:
            yield rows(seen)

    def rows(groups: set[bytes]) -> pa.RecordBatch:
        listed = sorted(groups)
        # Digests are big-endian: the upper half comes first.
        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, listed)), ">u8").reshape(-1, 2)
        signed = hashes.astype(np.uint64).view(np.int64)
        ends = np.concatenate([[0], np.cumsum([len(g) // 8 for g in listed])]).astype(np.int32)
        members = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(listed), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(signed[:, 0]), pa.array(signed[:, 1]), members], ["g0", "g1", "members"])

    bucket, sigs, nodes = None, [], []
    for batch in batches:
        for b, s, m in zip(*(batch.column(c).to_pylist() for c in ("bucket", "sigs", "nodes")), strict=True):
            if b != bucket:
                if sigs:
                    yield from shared(sigs, nodes)
                bucket, sigs, nodes = b, [], []
            sigs.append(s)
            nodes.append(m)
    if sigs:
        yield from shared(sigs, nodes)


def _parts(nodes: np.ndarray) -> Iterator[np.ndarray]:
    """The nodes, or each two halves of ``GROUP`` of them."""
    if len(nodes) <= GROUP:
        yield nodes
        return
    half = GROUP // 2
    cut = [nodes[i : i + half] for i in range(0, len(nodes), half)]
    for i in range(len(cut)):
        for j in range(i + 1, len(cut)):
            yield np.concatenate([cut[i], cut[j]])


def passing_pairs(percent: int, n: np.ndarray, root: np.ndarray, sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, differing bits), i < j, of pairs of different roots that can link by size and sketch."""
    words = min(len(x) for x in sketches) // 8
    bits = np.stack([folded(x, words) for x in sketches])
    out = []
    step = max(1, (1 << 21) // bits.size)
    for low in range(0, len(n), step):
        high = min(low + step, len(n))
        differ = np.bitwise_count(bits[low:high, None, :] ^ bits[None, low:, :]).sum(2, dtype=np.int64)
        every = n[low:high, None] + n[None, low:]
        can = ((100 + percent) * differ <= (100 - percent) * every) & (root[low:high, None] != root[None, low:])
        can &= 100 * np.minimum(n[low:high, None], n[None, low:]) >= percent * np.maximum(n[low:high, None], n[None, low:])
        i, j = np.nonzero(np.triu(can, 1))
        out.append((i + low, j + low, differ[i, j]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def spanning(i: np.ndarray, j: np.ndarray, differ: np.ndarray, root: np.ndarray) -> list[int]:
    """Numbers of the pairs of a minimum spanning forest over the roots."""
    parent = {r: r for r in root.tolist()}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, keep = len(parent) - 1, []
    for e in np.argsort(differ, kind="stable").tolist():
        a, b = find(int(root[i[e]])), find(int(root[j[e]]))
        if a != b:
            parent[a] = b
            keep.append(e)
            left -= 1
            if not left:
                break
    return keep


def _pairs_in_groups(percent: int, forest: bool):
    """Pairs (a, b) of nodes in each group that can link, or a forest of them and (g0, g1) of the groups that have more; rows come sorted by group and node."""
    kind = pa.int64()

    def found(group: list[int], rows: list[tuple]) -> pa.RecordBatch:
        node, n, root = (np.array([r[i] for r in rows], np.int64) for i in (0, 1, 2))
        i, j, differ = passing_pairs(percent, n, root, [r[3] for r in rows])
        more = 0
        if forest:
            keep = spanning(i, j, differ, root)
            more = int(len(keep) < len(i))
            i, j = i[keep], j[keep]
        a, b = np.minimum(node[i], node[j]).tolist(), np.maximum(node[i], node[j]).tolist()
        g0, g1 = ([None] * len(a) + [g] * more for g in group)
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x in (a + [None] * more, b + [None] * more, g0, g1)], ["a", "b", "g0", "g1"])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        done: list[pa.RecordBatch] = []
        for batch in batches:
            for *g, node, n, root, data in zip(*(batch.column(c).to_pylist() for c in ("g0", "g1", "node", "n", "root", "payload")), strict=True):
                if g != group:
                    if len(rows) > 1:
                        done.append(found(group, rows))
                    group, rows = g, []
                if not rows or rows[-1][0] != node:
                    rows.append((node, n, root, data))
            if done:
                yield pa.concat_batches(done)
                done = []
        if len(rows) > 1:
            yield found(group, rows)

    return scan


def _sets(n: int):
    """(id, node, n, payload): the sets of nodes."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            node, sets = batch.column("node").to_pylist(), shingle_sets(batch.column("text").to_pylist(), n)
            # An id may come with several texts; the node's own one is meant.
            own = pa.array([bool(len(s)) and fingerprint(s)[0] == i for s, i in zip(sets, node, strict=True)], pa.bool_())
            blobs = pa.array([s.tobytes() for s in sets], pa.binary())
            size = pa.array([len(s) for s in sets], pa.int64())
            columns = [batch.column("node"), batch.column("roles"), size, blobs]
            yield pa.RecordBatch.from_arrays(columns, ["node", "roles", "n", "payload"]).filter(own)

    return scan


def sketches_allow(percent: int, n: int, a: bytes, m: int, b: bytes) -> bool:
    """Whether sets of these sizes and sketches can link."""
    words = min(len(a), len(b)) // 8
    differ = int(np.bitwise_count(folded(a, words) ^ folded(b, words)).sum())
    return (100 + percent) * differ <= (100 - percent) * (n + m)


def sets_link(percent: int, n: int, a: bytes, m: int, b: bytes) -> bool:
    both = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
    return 100 * both >= percent * (n + m - both)


def _meet(test, percent: int):
    """Pairs (a, b) that pass the test; rows come sorted by (a, salt), the leader first."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, lead = None, None
        for batch in batches:
            out = []
            for a, salt, member, node, n, payload in zip(*(batch.column(c).to_pylist() for c in _ROLE_COLUMNS), strict=True):
                if not member:
                    leader, lead = (a, salt), (n, payload)
                elif leader == (a, salt) and test(percent, *lead, n, payload):
                    out.append((a, node))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    return scan


def _with_roles(rows: DataFrame, roles: DataFrame, on: list[str]) -> DataFrame:
    """Rows with their roles; broadcast within a checked number of roles."""
    total = roles.agg(F.sum(F.size("roles"))).first()[0] or 0
    return rows.join(F.broadcast(roles) if total <= BROADCAST_ROLES else roles, on)


_ROLE_COLUMNS = ("a", "salt", "member", "node", "n", "payload")


def jaccard_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """(documents, links): (doc_id, n_shingles, node, component_id, kept), and verified connecting links (a, b) between nodes.

    ``kept`` is the node that stays of a class: its smallest id's, the smallest one if that id has several.
    """
    # Every step that runs Python is written in here. Packed signatures take up to some 100 KB a row: by number of
    # rows alone, a batch would hold all that one task reads.
    with bounded_batches(docs.sparkSession):
        return _classes(docs, id_col, text_col, n, percent)


def _classes(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    info = staged(map_arrow(rows, _info(n), "id long, n long, node long, payload binary"), "jaccard-info")
    nodes = staged(
        info.where("n > 0 AND id IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), F.max("n").alias("n")), "jaccard-nodes"
    )
    # A set has about 3 (1 - t) / (1 + t) signatures a shingle in each of up to two instances.
    shingles = nodes.agg(F.sum("n")).first()[0] or 0
    buckets = int(min(max(16, 6 * shingles * (100 - percent) / (100 + percent) / BUCKET), 1 << 30))
    named = rows.where("id IS NOT NULL").select("text")
    signed = map_arrow(named, _signature_rows(n, percent, buckets), "bucket int, sigs binary, nodes binary")
    signed = signed.repartition("bucket").sortWithinPartitions("bucket")
    groups = map_arrow(signed, _groups, "g0 long, g1 long, members array<long>")
    groups = staged(groups.groupBy("g0", "g1").agg(F.first("members").alias("members")), "jaccard-groups")

    size = nodes.select("node", "n")

    def roles_of(pairs: DataFrame) -> DataFrame:
        """(node, id, roles) of the nodes of pairs: a leads, the b follow, ``PART`` of them in a task."""
        tasks = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("tasks"))
        salted = pairs.join(tasks, "a").select("a", F.pmod(F.hash("b"), "tasks").alias("salt"), "b")
        role = lambda member: F.struct("a", "salt", F.lit(member).alias("member")).alias("role")
        members = salted.select(F.col("b").alias("node"), role(1))
        leaders = salted.select("a", "salt").distinct().select(F.col("a").alias("node"), role(0))
        roles = members.unionByName(leaders).groupBy("node").agg(F.collect_list("role").alias("roles"))
        return staged(roles.join(nodes.select("node", "id"), "node"), "jaccard-roles")

    def met(rows: DataFrame, test) -> DataFrame:
        """Pairs that pass the test, from rows (node, roles, n, payload)."""
        each = rows.select(F.inline("roles"), "node", "n", "payload").select(*_ROLE_COLUMNS)
        each = each.repartition("a", "salt").sortWithinPartitions("a", "salt", "member")
        return map_arrow(each, _meet(test, percent), "a long, b long").distinct()

    def verified(near: DataFrame) -> DataFrame:
        """Pairs (a, b) that link."""
        texts = _with_roles(rows, roles_of(near), ["id"]).select("node", "roles", "text")
        kind = "node long, roles array<struct<a long, salt int, member int>>, n long, payload binary"
        return staged(met(map_arrow(texts, _sets(n), kind), sets_link), "jaccard-links")

    def candidates(groups: DataFrame, components: DataFrame, forest: bool, done: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Unverified pairs that can link, in groups that join several components; and the groups with more such pairs than those of the forest."""
        placed = groups.select("g0", "g1", F.explode("members").alias("node")).join(components, "node", "left")
        placed = placed.select("g0", "g1", "node", F.coalesce("component", "node").alias("root"))
        several = placed.groupBy("g0", "g1").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
        apart = staged(placed.join(several.select("g0", "g1"), ["g0", "g1"]), "jaccard-apart")
        own = staged(nodes.join(apart.select("node").distinct(), "node").select("id", "node"), "jaccard-open")
        few = own.limit(BROADCAST_ROLES + 1).count() <= BROADCAST_ROLES
        sketches = info.join(F.broadcast(own) if few else own, ["id", "node"]).select("node", "n", "payload").dropDuplicates(["node"])
        each = apart.join(sketches, "node").repartition("g0", "g1").sortWithinPartitions("g0", "g1", "node")
        found = staged(map_arrow(each, _pairs_in_groups(percent, forest), "a long, b long, g0 long, g1 long"), "jaccard-found")
        pairs = found.where("a IS NOT NULL").select("a", "b").distinct()
        return staged(pairs.join(done, ["a", "b"], "left_anti"), "jaccard-pairs"), found.where("a IS NULL").select("g0", "g1")

    first = groups.select(F.explode(F.slice("members", 2, GROUP)).alias("b"), F.col("members")[0].alias("a"))
    first = first.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    first = first.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b")
    first = staged(first.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b"), "jaccard-first")
    near = _with_roles(info, roles_of(first), ["id", "node"])
    links = verified(staged(met(near, sketches_allow), "jaccard-near"))
    components = staged(connected_components(links), "jaccard-components")
    done, left = first, groups
    for forest in (True, False):
        pairs, more = candidates(left, components, forest, done)
        if not pairs.isEmpty():
            new = verified(pairs)
            links = links.unionByName(new)
            components = staged(joined_components(components, new), "jaccard-components")
        if more.isEmpty():
            break
        done, left = done.unionByName(pairs), groups.join(more, ["g0", "g1"], "left_semi")
    smallest = components.join(nodes, "node").groupBy("component").agg(F.min(F.struct("id", "node")).alias("least"))
    label = components.join(smallest, "component").select("node", F.col("least.id").alias("component_id"), F.col("least.node").alias("kept"))
    label = nodes.join(label, "node", "left").select("node", F.coalesce("component_id", "id").alias("component_id"), F.coalesce("kept", "node").alias("kept"))
    result = info.withColumn("key", F.when(F.expr("n > 0 AND id IS NOT NULL"), F.col("node"))).join(
        label.withColumnRenamed("node", "key"), "key", "left"
    )
    result = result.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "node", F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce("kept", "node").alias("kept"),
    )
    return result, links


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest id of its class, all their columns.

    Rows that repeat an id with another text are decided each by its own text: where an
    id has texts that go and texts that stay, its rows are told apart by their sets.
    """
    classes, _ = jaccard_classes(docs, id_col, text_col, n, percent)
    gone = F.expr("doc_id <> component_id OR node <> kept")
    states = classes.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_drop"), "node").agg(F.max(gone).alias("gone"))
    drop = states.groupBy("_drop").agg(F.max("gone").alias("any"), F.min("gone").alias("all")).where("any")
    drop = staged(drop, "jaccard-drop")
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_drop"),
        text_or_empty(F.col(f"`{text_col}`")).alias("_text"),
    )

    def bounded(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids

    stay = row.join(bounded(drop.select("_drop")), "_drop", "left_anti").select("_row.*")
    mixed = drop.where("NOT all").select("_drop")
    if not mixed.limit(1).count():
        return stay
    part = row.join(bounded(mixed), "_drop", "left_semi").select("_row", "_drop", "_text")
    part = map_arrow(part, _row_nodes(n), StructType([*part.schema.fields, StructField("node", LongType())]))
    lost = states.where("gone").join(bounded(mixed), "_drop", "left_semi").select("_drop", "node")
    return stay.unionByName(part.join(lost, ["_drop", "node"], "left_anti").select("_row.*"))


def op4_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Four-word shingles, Jaccard 0.85 or more."""
    return jaccard_classes(documents(spark, sf_dir), n=4, percent=85)[0].select("doc_id", "n_shingles", "component_id")
