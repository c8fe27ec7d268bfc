"""Suffix-array dedup: bytes covered by a 200-byte string that starts elsewhere too.

Prefix doubling ranks positions by ever longer prefixes and drops a position as
soon as its rank is unique. Ranking every byte of the corpus would ship many
times the corpus, so positions are sampled by content first:

1. *Sample.* Of the 169 positions at which a 32-byte string starts inside a given
   200-byte string, the one with the smallest hash (leftmost on ties) is its
   anchor. It depends on the 200 bytes alone, so equal strings have the same
   anchor at the same distance. An anchor serves a run of starts, 85 on average.
2. *Prefix doubling.* Anchors are ranked by their first 32 bytes; Spark sorts them
   by (rank, rank of the next 32 bytes, rank of the 64 after that), and neighbours
   with equal pairs share the rank at offsets 32, 64 and 128. An anchor with a unique
   rank is dropped; where the rank becomes unique at 64 or 128 bytes, only starts
   whose string ends before that stay. Past the threshold nothing is left to sort.
3. *Exact resolution.* The starts left are taken eight at a time: 193 bytes common
   to their strings (128-bit evidence: a 64-bit name and at least 7 bytes compared)
   and the 7 bytes on either side. Strings are equal when the name, the bytes left
   and the bytes right agree. Runs and bytes removed follow per text.

Equal texts are one text: all bytes of repeated texts of 200 bytes or more go, and
one row of them stands for the others as a partner. Map tasks merge equal rows
before a shuffle, so a passage that a third of all documents share costs one row per
task and position. Texts are identified by 64-bit hashes. Texts are read again
next to what is known of them: joined by broadcast within a checked size, by a
shuffle beyond it.

Defined results: null text is empty; texts below 200 bytes keep all; a null id
stays null; rows that repeat an id are documents of their own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_arrow, mix64, staged
from .jaccard_join import _binary

LENGTH = 200
GRAM = 32
SPAN = LENGTH - GRAM + 1  # starts of a gram inside a string
STRIDE = 8
CORE = LENGTH - STRIDE + 1
SEGMENT = 1 << 19
FLUSH = 300_000
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 32 << 20

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MEMBER = np.dtype([("uid", "<i8"), ("pos", "<i4"), ("far", "u1"), ("near", "u1")])
_CHUNK = np.dtype([("uid", "<i8"), ("pos", "<i4"), ("mask", "u1")])
_PLACE = np.dtype([("pos", "<i4"), ("far", "u1"), ("near", "u1")])


def doubled(h: np.ndarray, m: int) -> np.ndarray:
    """Names of strings twice as long from the names at distance ``m``."""
    x = h[: len(h) - m] * np.uint64(0xC2B2AE3D27D4EB4F)
    x += h[m:]
    x *= np.uint64(0x9E3779B185EBCA87)
    x ^= x >> np.uint64(29)
    return x


def names(data: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Names of all strings of GRAM, 2 GRAM, ... ``longest`` bytes (as far as they fit)."""
    h, m, out = _BYTE[data], 1, {}
    while m < longest:
        h = doubled(h, m) if len(h) > m else h[:0]
        m *= 2
        if m >= GRAM:
            out[m] = h
    return out


def anchors(h: np.ndarray) -> np.ndarray:
    """Leftmost smallest of each SPAN consecutive names."""
    at, low, m = np.arange(len(h), dtype=np.int32), h, 1

    def narrower(at, low, shift):
        a, b = low[: len(low) - shift], low[shift:]
        left = a <= b
        return np.where(left, at[: len(at) - shift], at[shift:]), np.where(left, a, b)

    while m * 2 <= SPAN:
        at, low = narrower(at, low, m)
        m *= 2
    return narrower(at, low, SPAN - m)[0]


def segments(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, bytes) of overlapping pieces, each start of a string in one of them."""
    for start in range(0, max(len(data) - LENGTH + 1, 0), SEGMENT):
        yield start, np.frombuffer(data, np.uint8, min(SEGMENT + LENGTH - 1, len(data) - start), start)


def _grouped(pieces: Iterable[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Several pieces as one array, and (uid, offset in text, begin, end) of each."""
    held, places, size = [], [], 0
    for uid, data in pieces:
        for offset, piece in segments(data):
            held.append(piece)
            places.append((uid, offset, size, size + len(piece)))
            size += len(piece)
            if size >= SEGMENT:
                yield np.concatenate(held), places
                held, places, size = [], [], 0
    if held:
        yield np.concatenate(held), places


def _anchor_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rank, next, members): per task the anchors of one rank and the names that follow it."""
    seen: set[int] = set()
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def texts():
        for batch in batches:
            for uid, data in zip(batch.column("uid").to_pylist(), batch.column("data"), strict=True):
                if uid not in seen:
                    seen.add(uid)
                    yield uid, data.as_py()

    def merged() -> pa.RecordBatch:
        rank, follow = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
        member = np.concatenate([x[2] for x in held])
        order = np.lexsort((follow, rank))
        rank, follow, member = rank[order], follow[order], member[order]
        first = np.flatnonzero(np.concatenate([[True], (rank[1:] != rank[:-1]) | (follow[1:] != follow[:-1])]))
        lengths = np.diff(np.concatenate([first, [len(rank)]])) * _MEMBER.itemsize
        return pa.RecordBatch.from_arrays(
            [pa.array(rank[first].view(np.int64)), pa.array(follow[first].view(np.int64)), _binary(lengths, member.tobytes())],
            ["rank", "next", "members"],
        )

    for data, places in _grouped(texts()):
        known = names(data, 2 * GRAM)
        h32, h64 = known[GRAM], known[2 * GRAM]
        if len(h32) < SPAN:
            continue
        at = anchors(h32)
        begin = np.array([p[2] for p in places])
        end = np.array([p[3] for p in places])
        starts = np.concatenate([np.arange(b, e - LENGTH + 1) for b, e in zip(begin, end, strict=True)])
        piece = np.repeat(np.arange(len(places)), end - LENGTH + 1 - begin)
        b = at[starts].astype(np.int64)
        edge = np.concatenate([[True], (b[1:] != b[:-1]) | (piece[1:] != piece[:-1])])
        first = np.flatnonzero(edge)
        last = np.concatenate([first[1:], [len(b)]]) - 1
        b, of = b[first], piece[first]
        stop = end[of]
        x1 = np.where(b + 2 * GRAM <= stop, mix64(h32[np.minimum(b + GRAM, len(h32) - 1)]), np.uint64(0))
        x2 = np.where(b + 4 * GRAM <= stop, mix64(h64[np.minimum(b + 2 * GRAM, max(len(h64) - 1, 0))]), np.uint64(0))
        member = np.zeros(len(b), _MEMBER)
        member["uid"] = np.array([p[0] for p in places], np.int64)[of]
        member["pos"] = b - begin[of] + np.array([p[1] for p in places])[of]
        member["far"], member["near"] = b - starts[first], b - starts[last]
        held.append((h32[b], (x1 >> np.uint64(32) << np.uint64(32)) | (x2 >> np.uint64(32)), member))
        size += len(b)
        if size >= FLUSH:
            yield merged()
            held, size = [], 0
    if held:
        yield merged()


def _survivors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors whose rank is shared, their starts trimmed to the length up to which it is.

    Rows come sorted by (rank, next); a row is compared with the one before and
    the one after it, so only two rows are carried from batch to batch.
    """
    carried: tuple | None = None

    def settle(rank, follow, blobs, sizes, low: int, high: int) -> pa.RecordBatch | None:
        """Rows ``low`` to ``high``; the rows around them are there for comparison."""
        member = np.frombuffer(blobs, _MEMBER)
        ends = np.cumsum(sizes)
        head = member[ends - sizes]
        one = sizes == 1
        alike = one[1:] & one[:-1] & (head["uid"][1:] == head["uid"][:-1]) & (head["pos"][1:] == head["pos"][:-1])
        level = np.zeros(len(rank), np.int64)
        keys = ((rank,), (rank, follow >> np.int64(32)), (rank, follow))
        for depth, key in enumerate(keys):
            same = ~alike
            for part in key:
                same &= part[1:] == part[:-1]
            shared = np.concatenate([same, [False]]) | np.concatenate([[False], same]) | (sizes > 1)
            level[shared & (level == depth)] = depth + 1
        rows = np.arange(low, high)
        use = rows[level[rows] > 0]
        if not len(use):
            return None
        which = np.repeat(use, sizes[use])
        place = np.arange(len(which)) - np.repeat(np.cumsum(sizes[use]) - sizes[use], sizes[use]) + (ends - sizes)[which]
        found = member[place]
        # Ranks unique at 64 (128) bytes leave only strings with fewer bytes right of the anchor.
        floor = np.array([0, LENGTH - 2 * GRAM + 1, LENGTH - 4 * GRAM + 1, 0])[level[which]]
        near = np.maximum(found["near"], floor)
        keep = near <= found["far"]
        columns = [found["uid"][keep], found["pos"][keep], found["far"][keep].astype(np.int16), near[keep].astype(np.int16)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["uid", "pos", "far", "near"])

    for batch in batches:
        rank, follow = batch.column("rank").to_numpy(), batch.column("next").to_numpy()
        column = batch.column("members")
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        blobs = column.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]] if len(column) else b""
        sizes = np.diff(offsets) // _MEMBER.itemsize
        begun = 0
        if carried:
            rank, follow = np.concatenate([carried[0], rank]), np.concatenate([carried[1], follow])
            blobs, sizes, begun = carried[2] + blobs, np.concatenate([carried[3], sizes]), carried[4]
        if len(rank) > 1:
            out = settle(rank, follow, blobs, sizes, begun, len(rank) - 1)
            if out is not None:
                yield out
            begun = len(rank) - 1
        tail = min(2, len(rank))
        skip = int(sizes[: len(rank) - tail].sum()) * _MEMBER.itemsize
        carried = (rank[-tail:], follow[-tail:], blobs[skip:], sizes[-tail:], begun - (len(rank) - tail))
    if carried and len(carried[0]):
        out = settle(*carried[:4], carried[4], len(carried[0]))
        if out is not None:
            yield out


def _blobs(out: list[tuple[int, bytes]], name: str) -> pa.RecordBatch:
    """(uid, bytes) rows collected so far."""
    uids, blobs = ([r[i] for r in out] for i in (0, 1))
    out.clear()
    return pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(blobs, pa.binary())], ["uid", name])


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, places): the anchors of one text; rows come sorted by uid and pos."""
    uid_held, held, out = None, [], []

    def close():
        out.append((uid_held, np.unique(np.concatenate(held)).tobytes()))
        held.clear()

    for batch in batches:
        uid = batch.column("uid").to_numpy()
        place = np.zeros(len(uid), _PLACE)
        for c in ("pos", "far", "near"):
            place[c] = batch.column(c).to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(uid[1:] != uid[:-1]) + 1, [len(uid)]])
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if z > a:
                if held and uid[a] != uid_held:
                    close()
                uid_held = int(uid[a])
                held.append(place[a:z])
        if len(out) >= 1000:
            yield _blobs(out, "places")
    if held:
        close()
    yield _blobs(out, "places")


def _side(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """STRIDE - 1 bytes from ``at`` as one number, zero outside of the text."""
    out = np.zeros(len(at), np.uint64)
    for j in range(STRIDE - 1):
        p = at + j
        inside = (p >= 0) & (p < len(data))
        out = out << np.uint64(8) | np.where(inside, data[np.clip(p, 0, len(data) - 1)], 0).astype(np.uint64)
    return out


def chunks(data: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """(core, left, right, pos, mask) of the starts that the anchors serve, STRIDE at a time."""
    known = names(data, 4 * GRAM)[4 * GRAM]
    far, near, anchor = (place[c].astype(np.int64) for c in ("far", "near", "pos"))
    low, high = near // STRIDE, far // STRIDE
    n = high - low + 1
    which = np.repeat(np.arange(len(place)), n)
    q = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]
    core = anchor[which] - STRIDE * q
    pos = core - (STRIDE - 1)
    mask = np.zeros(len(which), np.uint8)
    for t in range(STRIDE):
        d, start = STRIDE * q + STRIDE - 1 - t, pos + t
        ok = (d >= near[which]) & (d <= far[which]) & (start >= 0) & (start + LENGTH <= len(data))
        mask |= ok.astype(np.uint8) << np.uint8(t)
    use = mask > 0
    core, pos, mask = core[use], pos[use], mask[use]
    name = mix64(known[core] * np.uint64(0xD6E8FEB86659FD93) + known[core + CORE - 4 * GRAM])
    return name, _side(data, pos), _side(data, core + CORE), pos, mask


def _chunk_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, left, right, members): per task the chunks with equal bytes."""
    held: list[tuple] = []
    size = 0

    def merged() -> pa.RecordBatch:
        core, left, right = (np.concatenate([x[i] for x in held]) for i in range(3))
        member = np.concatenate([x[3] for x in held])
        order = np.lexsort((right, left, core))
        core, left, right, member = core[order], left[order], right[order], member[order]
        differs = (core[1:] != core[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        first = np.flatnonzero(np.concatenate([[True], differs]))
        lengths = np.diff(np.concatenate([first, [len(core)]])) * _CHUNK.itemsize
        columns = [pa.array(x[first].view(np.int64)) for x in (core, left, right)]
        return pa.RecordBatch.from_arrays([*columns, _binary(lengths, member.tobytes())], ["core", "left", "right", "members"])

    for batch in batches:
        for uid, text, places in zip(batch.column("uid").to_pylist(), batch.column("data"), batch.column("places"), strict=True):
            data = text.as_py()
            every = np.frombuffer(places.as_py(), _PLACE)
            # Long texts by anchor ranges, so that names are held for one range only.
            for begin in range(0, len(data), SEGMENT):
                place = every[(every["pos"] >= begin) & (every["pos"] < begin + SEGMENT)].copy()
                if not len(place):
                    continue
                origin = max(begin - LENGTH, 0)
                place["pos"] -= origin
                piece = np.frombuffer(data, np.uint8, min(len(data), begin + SEGMENT + 2 * LENGTH) - origin, origin)
                core, left, right, pos, mask = chunks(piece, place)
                member = np.zeros(len(core), _CHUNK)
                member["uid"], member["pos"], member["mask"] = uid, pos + origin, mask
                held.append((core, left, right, member))
                size += len(core)
            if size >= FLUSH:
                yield merged()
                held, size = [], 0
    if size:
        yield merged()


def _repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, pos, mask): starts of strings that start elsewhere too; rows come sorted by core."""
    carried: tuple | None = None

    def settle(core, left, right, member, sizes) -> pa.RecordBatch | None:
        which = np.repeat(np.arange(len(core)), sizes)
        found = np.zeros(len(member), np.uint8)
        shared_core = np.concatenate([[False], core[1:] == core[:-1]]) | np.concatenate([core[1:] == core[:-1], [False]]) | (sizes > 1)
        rows = np.flatnonzero(shared_core)
        if not len(rows):
            return None
        for t in range(STRIDE):
            has = (member["mask"] >> np.uint8(t) & 1).astype(bool)
            count = np.bincount(which, has, len(core))[rows]
            keep_left = np.uint64((1 << 8 * (STRIDE - 1 - t)) - 1)
            l, r = left[rows] & keep_left, right[rows] >> np.uint64(8 * (STRIDE - 1 - t))
            order = np.lexsort((r, l, core[rows]))
            c, l, r = core[rows][order], l[order], r[order]
            group = np.cumsum(np.concatenate([[0], (c[1:] != c[:-1]) | (l[1:] != l[:-1]) | (r[1:] != r[:-1])]))
            total = np.bincount(group, count[order])[group]
            repeated = np.zeros(len(core), bool)
            repeated[rows[order]] = total > 1
            found |= (has & repeated[which]).astype(np.uint8) << np.uint8(t)
        use = found > 0
        columns = [member["uid"][use], member["pos"][use], found[use].astype(np.int16)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["uid", "pos", "mask"])

    for batch in batches:
        values = [batch.column(c).to_numpy().view(np.uint64) for c in ("core", "left", "right")]
        column = batch.column("members")
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        blob = column.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]] if len(column) else b""
        member, sizes = np.frombuffer(blob, _CHUNK), np.diff(offsets) // _CHUNK.itemsize
        if carried:
            values = [np.concatenate([a, b]) for a, b in zip(carried[:3], values, strict=True)]
            member, sizes = np.concatenate([carried[3], member]), np.concatenate([carried[4], sizes])
        core = values[0]
        if not len(core):
            continue
        cut = int(np.flatnonzero(core == core[-1])[0])
        m = int(sizes[:cut].sum())
        if cut:
            out = settle(core[:cut], values[1][:cut], values[2][:cut], member[:m], sizes[:cut])
            if out is not None:
                yield out
        carried = (core[cut:], values[1][cut:], values[2][cut:], member[m:], sizes[cut:])
    if carried:
        out = settle(*carried)
        if out is not None:
            yield out


def _spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, spans): maximal runs of removed bytes of a text; rows come sorted by uid and pos."""
    uid_held, held, out = None, [], []

    def close():
        starts = np.unique(np.concatenate(held))
        new = np.concatenate([[True], starts[1:] > starts[:-1] + LENGTH])
        begin = starts[new]
        end = starts[np.concatenate([new[1:], [True]])] + LENGTH
        out.append((uid_held, np.stack([begin, end], axis=1).astype("<i4").tobytes()))
        held.clear()

    for batch in batches:
        uid, pos, mask = (batch.column(c).to_numpy() for c in ("uid", "pos", "mask"))
        bits = (mask[:, None] >> np.arange(STRIDE)) & 1 == 1
        edges = np.concatenate([[0], np.flatnonzero(uid[1:] != uid[:-1]) + 1, [len(uid)]])
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if z > a:
                if held and uid[a] != uid_held:
                    close()
                uid_held = int(uid[a])
                held.append((pos[a:z, None].astype(np.int64) + np.arange(STRIDE))[bits[a:z]])
        if len(out) >= 1000:
            yield _blobs(out, "spans")
    if held:
        close()
    yield _blobs(out, "spans")


def _bounded(rows: DataFrame, blob: str) -> DataFrame:
    """Marked for broadcast if rows and bytes are within the checked size."""
    size = rows.agg(F.count("*").alias("n"), F.sum(F.length(blob)).alias("b")).first()
    return F.broadcast(rows) if size["n"] <= BROADCAST_ROWS and (size["b"] or 0) <= BROADCAST_BYTES else rows


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, texts): rows (doc_id, data, uid, place); texts (uid, n, spans), spans as pairs of 32-bit byte offsets.

    ``texts`` has the texts that occur several times (n > 1) or hold a repeated string.
    """
    data = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("data")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), data).withColumn("uid", F.xxhash64("data"))
    rows = rows.withColumn("place", F.coalesce("doc_id", "uid"))
    long_rows = rows.where(F.length("data") >= LENGTH)
    texts = staged(long_rows.groupBy("uid").agg(F.min("place").alias("place"), F.count("*").alias("n")), "substring-texts")

    ranked = map_arrow(long_rows.select("uid", "data"), _anchor_rows, "rank long, next long, members binary")
    ranked = ranked.repartition("rank").sortWithinPartitions("rank", "next")
    left = map_arrow(ranked, _survivors, "uid long, pos int, far short, near short")
    left = left.repartition("uid").sortWithinPartitions("uid", "pos")
    left = staged(map_arrow(left, _packed, "uid long, places binary"), "substring-survivors")
    # One row of each text stands for all of its copies.
    left = staged(left.join(texts.select("uid", "place"), "uid"), "substring-places")

    again = long_rows.join(_bounded(left, "places"), ["uid", "place"]).select("uid", "data", "places")
    parts = map_arrow(again, _chunk_rows, "core long, left long, right long, members binary")
    parts = parts.repartition("core").sortWithinPartitions("core")
    starts = map_arrow(parts, _repeated, "uid long, pos int, mask short")
    starts = starts.repartition("uid").sortWithinPartitions("uid", "pos")
    spans = staged(map_arrow(starts, _spans, "uid long, spans binary"), "substring-spans")
    found = texts.join(spans, "uid", "left").where("n > 1 OR spans IS NOT NULL").select("uid", "n", F.coalesce("spans", F.lit(b"")).alias("spans"))
    return rows, staged(found, "substring-found")


def _removed(n: int, copies: int | None, spans: bytes | None) -> np.ndarray:
    if copies is not None and copies > 1:
        return np.array([[0, n]])
    return np.frombuffer(spans or b"", "<i4").reshape(-1, 2).astype(np.int64)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for data, n, spans in zip(batch.column("data"), batch.column("n").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            raw = data.as_buffer()
            gone = _removed(len(raw), n, spans)
            sha, at = hashlib.sha256(), 0
            for a, z in gone.tolist():
                sha.update(raw[at:a])
                at = z
            sha.update(raw[at:])
            out.append((len(raw), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), sha.hexdigest()))
        n_bytes, n_removed, n_spans, kept = zip(*out, strict=True) if out else ((), (), (), ())
        columns = [*(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, texts = repeated_spans(docs, id_col, text_col)
    joined = rows.join(_bounded(texts, "spans"), "uid", "left").select("doc_id", "data", "n", "spans")
    return map_arrow(joined, _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))
