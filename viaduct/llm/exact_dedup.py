"""Exact dedup with an extendible-hash index on shared files.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` became
one space. The index is built in three steps:

1. *Entries*: 64-bit key and SHA-256 of the normalised text of each row,
   written to the shared folder (about 60 bytes a document).
2. *Directory*: distinct keys are counted by their leading ``max_depth`` bits.
   Starting from one bucket, an overfull bucket is split by one more bit, and
   the directory doubles when the bucket was as deep as the directory. It has
   at most ``2 ** max_depth`` slots, which bounds what is broadcast (65,536
   slots by default); a bucket still overfull at that depth keeps overflow
   chains. Rows with one key count once, so a group of copies never splits.
3. *Owners*: every map task merges its own equal texts first (a group holding
   a third of all rows sends one text per task and flush), rows go to the task
   that owns their bucket's key range, sorted by key, and the owner chains
   the texts of one key and compares their bytes. It holds one chain at a time.

The index (key, SHA-256, smallest id, rows) is a table in the shared folder.

Defined results: null text counts as empty; a null id never is the smallest id
(``keep_id`` is null if all ids of a group are); rows that repeat id and text
are all marked ``kept``, and `unique_rows` returns one of them; an empty table
gives an empty result. Other columns are ignored (`unique_rows` passes them on).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, arrow_rows, documents, map_arrow, staged, text_or_empty

BUCKET_KEYS = 512
MAX_DEPTH = 16
FLUSH_BYTES = 32 << 20

_COMBINED = "bucket int, key long, text string, min_id long, n long"
_INDEX = "bucket int, key long, sha string, keep_id long, group_size long"


def normalised(column: str) -> F.Column:
    return F.regexp_replace(text_or_empty(column), SPACE, " ")


def split_buckets(counts: np.ndarray, capacity: int, max_depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each directory slot, and the local depth of that bucket.

    ``counts`` are distinct keys per slot of a directory of full depth.
    """
    bucket, depth = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for level in range(max_depth):
        load = counts.reshape(len(bucket), -1).sum(axis=1)
        full = np.isin(bucket, np.flatnonzero(np.bincount(bucket, load, len(bucket)) > capacity)) & (depth == level)
        # The directory doubles; slots of a full bucket get one bucket each.
        bucket, depth = np.repeat(bucket * 2, 2), np.repeat(depth, 2)
        split = np.repeat(full, 2)
        bucket[split] = np.flatnonzero(split)
        depth[split] += 1
    return bucket, depth


def _merge_in_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of this task as one row, with the smallest id and the rows."""
    held: dict[tuple, list] = {}
    size = 0

    def flush():
        columns = [
            pa.array([k[0] for k in held], pa.int32()), pa.array([k[1] for k in held], pa.int64()),
            pa.array([k[2] for k in held], pa.string()), pa.array([v[0] for v in held.values()], pa.int64()),
            pa.array([v[1] for v in held.values()], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "key", "text", "min_id", "n"])

    for bucket, key, text, doc_id in arrow_rows(batches, "bucket", "key", "text", "id"):
        entry = held.get((bucket, key, text))
        if entry is None:
            held[bucket, key, text] = [doc_id, 1]
            size += len(text) + 100
            if size > FLUSH_BYTES:
                yield flush()
                held.clear()
                size = 0
        else:
            entry[1] += 1
            if doc_id is not None and (entry[0] is None or doc_id < entry[0]):
                entry[0] = doc_id
    if held:
        yield flush()


def _chain_in_owner(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal bytes; rows come sorted by bucket and key, one key's chain is held."""
    names = ["bucket", "key", "sha", "keep_id", "group_size"]
    types = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    out: list[tuple] = []
    at, chain = None, []

    def close():
        for text, ids, n in chain:
            out.append((*at, hashlib.sha256(text).hexdigest(), min(ids, default=None), n))
        chain.clear()

    def batch():
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for bucket, key, text, min_id, n in arrow_rows(batches, "bucket", "key", "text", "min_id", "n"):
        if at != (bucket, key):
            close()
            at = (bucket, key)
            if len(out) >= 8192:
                yield batch()
        raw = text.encode("utf-8", "surrogatepass")
        for link in chain:
            if link[0] == raw:
                break
        else:
            link = [raw, [], 0]
            chain.append(link)
        if min_id is not None:
            link[1] = [min(link[1] + [min_id])]
        link[2] += n
    close()
    if out:
        yield batch()


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = BUCKET_KEYS, max_depth: int = MAX_DEPTH
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, directory, index) as tables in the shared folder."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), normalised(text_col).alias("text"))
    keyed = rows.withColumn("key", F.xxhash64("text"))
    entries = staged(keyed.select("id", "key", F.sha2("text", 256).alias("sha")), "dedup-entries")

    slot = F.shiftrightunsigned("key", 64 - max_depth).cast("int")
    loads = entries.select("key").distinct().groupBy(slot.alias("slot")).count().collect()  # at most 2 ** max_depth rows
    counts = np.zeros(1 << max_depth, np.int64)
    for r in loads:
        counts[r["slot"]] = r["count"]
    bucket, depth = split_buckets(counts, bucket_keys, max_depth)
    used = np.flatnonzero(counts)
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in ("slot", "bucket", "depth")])
    directory = spark.createDataFrame([(int(s), int(bucket[s]), int(depth[s])) for s in used], schema)
    directory = staged(directory, "dedup-directory")

    placed = keyed.withColumn("slot", slot).join(F.broadcast(directory.select("slot", "bucket")), "slot")
    merged = map_arrow(placed.select("bucket", "key", "text", "id"), _merge_in_task, _COMBINED)
    owned = merged.repartition("bucket").sortWithinPartitions("bucket", "key")
    index = staged(map_arrow(owned, _chain_in_owner, _INDEX), "dedup-index")
    return entries, directory, index


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **index) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    entries, _, groups = build_index(docs, id_col, text_col, **index)
    return entries.join(groups, ["key", "sha"]).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def unique_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **index) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns, one for each distinct text."""
    flags = exact_dedup(docs, id_col, text_col, **index).where("kept")
    stay = flags.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).cast("long").alias("_i"), F.sha2(normalised(text_col), 256).alias("_s"),
    )
    hit = rows.join(stay, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_s") == F.col("_sha")), "left_semi")
    return hit.dropDuplicates(["_i", "_s"]).select("_row.*")


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


ORACLE = r"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
"""
