"""Quality classifier: random indexing, pooled word vectors, two-layer network.

Words (runs of letters, of digits, of other marks) fall into ``SLOTS`` hashed
slots. Each slot has a sparse ternary index vector; a word's vector is the sum of
the index vectors found within ``REACH`` words of it, over every document of
the table. Map tasks add up locally and send blocks of slots, so the shuffle
holds at most one table of ``SLOTS x DIM`` counts per task; the summed table
(4 MB, fixed by these parameters) is broadcast.

A document is the mean of its scaled word vectors, with two numbers on its length and
variety. A two-layer network (numpy) learns the label from at most ``TRAIN_ROWS``
labelled rows, taken in hash order of the id among rows whose ``crc32(id as
text) mod 5`` isn't 0; a tenth of them isn't trained on but sets the temperature
that calibrates the probabilities. Label, language, source and id are no inputs.

Defined results: null and empty texts get the score of a document without
words; a null id is held out; an id with several labels counts by its best one;
without labels of both kinds every score is the smoothed share of good rows; rows
that repeat are scored alike; an empty table gives an empty result; other
columns are ignored (`accepted` passes them on).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import documents, map_arrow, mix64, python_strings, text_or_empty, worker_cache

SLOTS = 1 << 14
DIM = 64
NONZERO = 4
REACH = 2
BLOCK = 256
TRAIN_ROWS = 20_000
HIDDEN = 32
THRESHOLD = 0.3
SEED = 20_240_517
CHUNK = 200_000

_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


class Slots(dict):
    """Slot of a word: letters by case pattern and lower case, digits by their number."""

    def __missing__(self, word: str) -> int:
        if word[0].isdigit():
            key = f"0:{min(len(word), 20)}"
        elif word.isupper() and len(word) > 1:
            key = f"U:{word.lower()}"
        else:
            key = word.lower()
        slot = zlib.crc32(key.encode("utf-8", "surrogatepass")) % SLOTS
        if len(self) >= 400_000:
            self.clear()
        self[word] = slot
        return slot


_slots = Slots()
worker_cache(__name__, _slots.clear)


def slots_of(text: str) -> np.ndarray:
    words = _WORD.findall(text)
    return np.fromiter(map(_slots.__getitem__, words), np.int64, len(words))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero numbers of each slot's index vector; a last row of zeros."""
    h = mix64(np.arange(SLOTS * NONZERO, dtype=np.uint64) + np.uint64(SEED)).reshape(SLOTS, NONZERO)
    # One non-zero number in each quarter of the dimensions.
    place = (h % np.uint64(DIM // NONZERO)).astype(np.int64) + np.arange(NONZERO) * (DIM // NONZERO)
    sign = np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    return np.vstack([place, np.zeros((1, NONZERO), np.int64)]), np.vstack([sign, np.zeros((1, NONZERO))])


def add_contexts(table: np.ndarray, slots: np.ndarray, place: np.ndarray, sign: np.ndarray) -> None:
    """Add the index vectors around each word; slot ``SLOTS`` separates documents."""
    for step in range(1, REACH + 1):
        for word, near in ((slots[:-step], slots[step:]), (slots[step:], slots[:-step])):
            real = word < SLOTS
            word, near = word[real], near[real]
            for k in range(NONZERO):
                table += np.bincount(word * DIM + place[near, k], sign[near, k], SLOTS * DIM).astype(np.int64)


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, counts): this task's sums, blocks of slots that hold any."""
    place, sign = index_vectors()
    table = np.zeros(SLOTS * DIM, np.int64)
    held, size = [], 0
    gap = np.full(REACH, SLOTS, np.int64)
    for batch in batches:
        for text in python_strings(batch.column("text")):
            held += [slots_of(text), gap]
            size += len(held[-2]) + REACH
            if size > 4 * CHUNK:
                add_contexts(table, np.concatenate(held), place, sign)
                held, size = [], 0
    if size:
        add_contexts(table, np.concatenate(held), place, sign)
    blocks = table.reshape(-1, BLOCK * DIM)
    used = np.flatnonzero(blocks.any(axis=1))
    rows = [zlib.compress(blocks[b].astype("<i8").tobytes(), 1) for b in used]
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(rows, pa.binary())], ["block", "counts"])


def _sum_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
            part = np.frombuffer(zlib.decompress(counts.as_buffer()), "<i8")
            sums[block] = sums[block] + part if block in sums else part
    rows = [zlib.compress(v.tobytes(), 1) for v in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(rows, pa.binary())], ["block", "counts"])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Scaled word vectors of all slots from all texts (``SLOTS x DIM`` single floats)."""
    texts = docs.select(text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    parts = map_arrow(texts, _contexts, "block int, counts binary").repartition("block")
    table = np.zeros((SLOTS // BLOCK, BLOCK * DIM), np.int64)
    for row in map_arrow(parts, _sum_blocks, "block int, counts binary").collect():  # SLOTS / BLOCK rows
        table[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), "<i8")
    vectors = table.reshape(SLOTS, DIM).astype(np.float64)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(norm, 1e-9)).astype(np.float32)


def document_vector(slots: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, length and variety."""
    n = len(slots)
    out = np.zeros(DIM + 2, np.float64)
    if n:
        for start in range(0, n, CHUNK):
            out[:DIM] += vectors[slots[start : start + CHUNK]].sum(axis=0, dtype=np.float64)
        out[:DIM] /= n
        out[DIM] = np.log1p(n) / 10
        out[DIM + 1] = len(np.unique(slots)) / n
    return out


class Network:
    """Two layers, logistic output divided by a temperature."""

    def __init__(self, base: float, weights: list[np.ndarray] | None = None, mean=None, scale=None, temperature: float = 1.0):
        self.base, self.weights, self.mean, self.scale, self.temperature = base, weights, mean, scale, temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train(x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 256) -> Network:
    """Adam on the cross entropy; a tenth of the rows calibrates the temperature."""
    base = float((y.sum() + 1) / (len(y) + 2))
    if len(np.unique(y)) < 2:
        return Network(base)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    held = order[: len(y) // 10] if len(y) >= 50 else order
    use = order[len(y) // 10 :] if len(y) >= 50 else order
    mean, scale = x[use].mean(axis=0), x[use].std(axis=0) + 1e-3
    net = Network(base, [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)], mean, scale)
    m, v, t = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    z = (x - mean) / scale
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 1e-4
        for rows in np.array_split(rng.permutation(use), max(1, len(use) // batch)):
            w1, _, w2, _ = net.weights
            h = np.tanh(z[rows] @ w1 + net.weights[1])
            d = (1 / (1 + np.exp(-np.clip(h @ w2 + net.weights[3], -40, 40))) - y[rows]) / len(rows)
            dh = np.outer(d, w2) * (1 - h * h)
            grads = [z[rows].T @ dh + 1e-4 * w1, dh.sum(axis=0), h.T @ d + 1e-4 * w2, np.array([d.sum()])]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                net.weights[i] = net.weights[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    logits = net.logits(x[held])
    net.temperature = min(np.geomspace(0.25, 8, 61), key=lambda c: _loss(logits / c, y[held]))
    return net


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """(word vectors, network). Statistics cover all rows; labels at most ``TRAIN_ROWS``."""
    vectors = word_vectors(docs, text_col)
    key = F.col(f"`{id_col}`")
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(key)).groupBy(key.alias("_id")).agg(F.max(label_col).alias("_y"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_ROWS)  # the documented bound of the training rows
    rows = docs.select(key.alias("_id"), text_or_empty(F.col(f"`{text_col}`")).alias("text")).join(F.broadcast(known), "_id")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batches):
        for b in batches:
            x = [document_vector(slots_of(t), shared.value).astype("<f8").tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_id").cast(pa.int64()), b.column("_y").cast(pa.int32()), pa.array(x, pa.binary())], ["i", "y", "x"])

    found = sorted((r["i"], r["y"], bytes(r["x"])) for r in map_arrow(rows, pooled, "i long, y int, x binary").collect())
    x = np.array([np.frombuffer(r[2], "<f8") for r in found]).reshape(len(found), DIM + 2)
    return vectors, train(x, np.array([min(max(r[1], 0), 1) for r in found], np.float64))


def _scorer(docs: DataFrame, model) -> tuple:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(column: pa.Array) -> np.ndarray:
        vectors, net = shared.value
        x = [document_vector(slots_of(t), vectors) for t in python_strings(column)]
        return net.score(np.array(x).reshape(len(x), DIM + 2))

    return score


def classify(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    score = _scorer(docs, model)

    def scan(batches):
        for b in batches:
            s = score(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    key = F.col(f"`{id_col}`")
    rows = docs.select(key.cast("long").alias("doc_id"), held_out(key).alias("held_out"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    return map_arrow(rows, scan, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted good, all their columns."""
    score = _scorer(docs, model)

    def scan(batches):
        for b in batches:
            yield b.filter(pa.array(score(b.column(b.schema.get_field_index(text_col))) >= THRESHOLD))

    return map_arrow(docs, scan, docs.schema)


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return classify(docs, fit(docs, read_table(spark, sf_dir, "labels")))
