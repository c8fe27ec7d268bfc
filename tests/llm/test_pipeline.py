"""The corpus pipeline, stage by stage, against what each stage must do."""

import collections
import re

import numpy as np
import pyarrow as pa
import xxhash

import corpus_pipeline
from viaduct.llm import common, jaccard_join, mixing, quality
from viaduct.llm.common import documents, staged

from .conftest import SF001
from .test_dedup import classes_by_brute_force
from .test_models import check_packing


def test_stages_work_on_what_the_one_before_kept(spark):
    docs, kept = documents(spark, SF001), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        kept[name, "in"] = docs
        docs = staged(stage(spark, docs, SF001), "test-stage")
        kept[name] = docs
        assert name == "packing" or docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "mixing", "packing"]

    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    every = documents(spark, SF001)
    scores = {r["doc_id"]: r["predicted"] for r in quality.op5_quality_classifier(spark, SF001).collect()}
    assert sorted(rows(kept["quality_classifier"])) == sorted((i, t) for i, t in rows(every) if scores[i])

    smallest = {}
    for i, t in rows(kept["quality_classifier"]):
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        smallest[key] = min(smallest.get(key, i), i)
    assert sorted(i for i, _ in rows(kept["exact_dedup"])) == sorted(smallest.values())

    classes = classes_by_brute_force(rows(kept["exact_dedup"]), 5, 80)
    assert sorted(i for i, _ in rows(kept["ngram_jaccard_join"])) == sorted({c for _, _, c in classes})

    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    taken = collections.Counter()
    for i, t in rows(kept["mixing"]):
        taken[i] += words(t)
    assert taken == {r["doc_id"]: r["taken"] for r in mixing.mix(kept["mixing", "in"]).collect() if r["taken"]}

    check_packing(kept["packing"].collect(), rows(kept["mixing"]))


def test_run_applies_all_stages(spark):
    pieces = corpus_pipeline.run(spark, SF001)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and pieces.count() > 0


def test_the_near_copy_stage_takes_five_words(spark):
    assert jaccard_join.one_of_each.__defaults__[-2:] == (5, 80)


def test_batches_for_python_are_bounded_by_bytes(spark, monkeypatch):
    """Rows of 100 KB, as packed signatures are: by number of rows alone, a task's rows came in one batch."""
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"]) for b in batches)
    rows = spark.range(0, 200, 1, 1).selectExpr("repeat('x', 100000) AS long")
    before = spark.conf.get(common._BATCH_SETTING, None)
    with common.bounded_batches(spark):
        seen = [r["size"] for r in common.map_arrow(rows, sizes, "size long").collect()]
    assert sum(seen) >= 200 * 100_000 and max(seen) <= common.BATCH_BYTES + 200_000
    assert spark.conf.get(common._BATCH_SETTING, None) == before

    inside = []
    monkeypatch.setattr(jaccard_join, "_classes", lambda docs, *a: inside.append(docs.sparkSession.conf.get(common._BATCH_SETTING)))
    spark.conf.unset(common._BATCH_SETTING)
    default = spark.conf.get(common._BATCH_SETTING, None)
    jaccard_join.jaccard_classes(documents(spark, SF001))
    assert inside == [str(common.BATCH_BYTES)] and spark.conf.get(common._BATCH_SETTING, None) == default
    corpus_pipeline.stage_pack(spark, documents(spark, SF001), SF001)
    assert spark.conf.get(common._BATCH_SETTING) == str(common.BATCH_BYTES)


def test_a_worker_keeps_the_caches_of_the_operator_it_runs_only(monkeypatch):
    own, other, freed = {"a": 1}, {"b": 2}, []
    monkeypatch.setattr(common, "_caches", {})
    monkeypatch.setattr(common, "_release", lambda: freed.append(True))
    common.worker_cache(__name__, own.clear)
    common.worker_cache("another", other.clear)

    def twice(batches):
        for b in batches:
            yield b
            yield b

    out = common.released(twice)(iter([1, 2]))
    assert next(out) == 1 and own == {"a": 1} and other == {} and not freed
    assert list(out) == [1, 2, 2] and freed == [True]


def test_the_pipelines_caches_are_named():
    assert {"viaduct.llm.quality", "viaduct.llm.packing"} <= set(common._caches)


def test_groups_are_named_by_both_halves_of_their_hash():
    sig = np.array([[1, 0, 0, 0, 0, 0]] * 3, np.uint8).tobytes()
    nodes = np.array([7, -5, 9], np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([sig]), pa.array([nodes.tobytes()])], ["bucket", "sigs", "nodes"])
    (out,) = jaccard_join._groups([batch])
    h = xxhash.xxh3_128_intdigest(np.sort(nodes).tobytes())
    halves = [int(np.uint64(x).astype(np.int64)) for x in (h >> 64, h & (1 << 64) - 1)]
    assert out.to_pydict() == {"g0": halves[:1], "g1": halves[1:], "members": [[-5, 7, 9]]}
