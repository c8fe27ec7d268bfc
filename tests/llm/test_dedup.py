"""Substring, exact, near-copy and line dedup against brute force."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viaduct.llm import exact_dedup, jaccard_join, line_dedup, substring_dedup

from .conftest import SF001, tuples


# -- substrings ----------------------------------------------------------------
def removed_by_brute_force(rows, length=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[p : p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = collections.Counter()
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out[i, len(b), int(gone.sum()), int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])[: len(b)]).sum() if len(b) else 0), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_substrings_equal_brute_force(spark, odd, odd_docs):
    edge = [(2000, "y" * 199), (2001, "y" * 200), (2002, "q" + "y" * 230 + "z" * 220 + "y" * 210), (2003, "lorem ipsum dolor " * 30), (2004, odd[7][1][:400]), (2005, "w" + odd[7][1][1:380] + "w")]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(edge, "doc_id long, text string"))
    assert collections.Counter(tuples(substring_dedup.substring_dedup(docs))) == removed_by_brute_force([(i, t) for i, t in odd] + edge)


def test_substrings_of_no_table(no_docs):
    assert tuples(substring_dedup.substring_dedup(no_docs)) == []


def test_a_long_text_is_cut_in_segments_without_loss(spark, monkeypatch, texts):
    """Repeats across segment borders are found (one process: small segments)."""
    monkeypatch.setattr(substring_dedup, "SEGMENT", 700)
    data = "".join(t for _, t in texts[:6]).encode()[:6000]
    starts = [s + np.arange(len(p) - 199) for s, p in substring_dedup.segments(data)]
    assert (np.concatenate(starts) == np.arange(len(data) - 199)).all()


def test_anchors_are_the_leftmost_smallest():
    h = np.random.default_rng(1).integers(0, 50, 900).astype(np.uint64)
    want = [i + int(np.argmin(h[i : i + substring_dedup.SPAN])) for i in range(len(h) - substring_dedup.SPAN + 1)]
    assert substring_dedup.anchors(h).tolist() == want


# -- exact copies --------------------------------------------------------------
def same_texts(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = collections.Counter()
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            out[i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def test_exact_dedup_of_odd_rows(odd, odd_docs, no_docs):
    assert collections.Counter(tuples(exact_dedup.exact_dedup(odd_docs, bucket_keys=2))) == same_texts(odd)
    assert tuples(exact_dedup.exact_dedup(no_docs)) == []


def test_exact_dedup_equals_its_sql(spark, duck):
    got = exact_dedup.op3_exact_dedup(spark, SF001)
    want = duck.sql(exact_dedup.ORACLE)
    assert got.columns == want.columns
    assert sorted(tuples(got)) == sorted(want.fetchall())


def test_unique_rows_keep_all_columns(odd, odd_docs, no_docs):
    rows = exact_dedup.unique_rows(odd_docs)
    assert rows.columns == odd_docs.columns and exact_dedup.unique_rows(no_docs).count() == 0
    want = {(k[1], k[4]) for k in same_texts(odd)}
    got = [(r["doc_id"], hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "").encode()).hexdigest()) for r in rows.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_colliding_keys_are_chained_by_bytes():
    columns = {"bucket": [0] * 4, "key": [7] * 4, "text": ["a", "b", "a", "b"], "min_id": [5, 2, 3, None], "n": [1, 2, 3, 4]}
    types = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    batch = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), types, strict=True)], list(columns))
    rows = [r for b in exact_dedup._chain_in_owner([batch.slice(0, 1), batch.slice(1)]) for r in b.to_pylist()]
    assert [(r["keep_id"], r["group_size"]) for r in rows] == [(3, 4), (2, 6)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=16, max_size=16), st.integers(1, 60))
def test_buckets_hold_their_capacity_unless_at_full_depth(counts, capacity):
    counts = np.array(counts)
    bucket, depth = exact_dedup.split_buckets(counts, capacity, 4)
    for b in set(bucket.tolist()):
        slots = np.flatnonzero(bucket == b)
        assert (np.diff(slots) == 1).all() and len(set(depth[slots].tolist())) == 1 and len(slots) == 1 << (4 - depth[slots[0]])
        assert counts[slots].sum() <= capacity or depth[slots[0]] == 4


# -- near copies ---------------------------------------------------------------
def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def classes_by_brute_force(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (ia, sa) in enumerate(sets):
        for b in range(a):
            ib, sb = sets[b]
            if None not in (ia, ib) and sa and sb and 100 * len(sa & sb) >= percent * len(sa | sb):
                root[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            low[find(a)] = min(low.get(find(a), i), i)
    return collections.Counter((i, len(s), low.get(find(a)) if i is not None else None) for a, (i, s) in enumerate(sets))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_near_copies_equal_brute_force(odd, odd_docs, n, percent):
    got = jaccard_join.jaccard_classes(odd_docs, n=n, percent=percent)[0].select("doc_id", "n_shingles", "component_id")
    assert collections.Counter(tuples(got)) == classes_by_brute_force(odd, n, percent)


def test_a_group_of_near_copies_stays_linked(spark):
    """Every text differs from the first in other words; many link only through others."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        words = [f"w{k}" for k in range(120)]
        for p in rng.choice(120, rng.integers(0, 6), replace=False):
            words[p] = f"z{rng.integers(0, 9)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = jaccard_join.jaccard_classes(docs, n=4, percent=85)[0].select("doc_id", "n_shingles", "component_id")
    want = classes_by_brute_force(rows, 4, 85)
    assert collections.Counter(tuples(got)) == want and len({k[2] for k in want}) > 1


def test_near_copies_of_no_table(no_docs):
    assert tuples(jaccard_join.jaccard_classes(no_docs)[0]) == []
    assert jaccard_join.one_of_each(no_docs).columns == no_docs.columns


def test_one_of_each_class_stays(odd, odd_docs):
    want = {c for _, _, c in classes_by_brute_force(odd, 5, 80)}
    assert {r["doc_id"] for r in jaccard_join.one_of_each(odd_docs).collect()} == want


def test_texts_of_one_id_are_decided_each(spark):
    """A clean text stays when its id's other text goes; near copies under one id leave one."""
    words = lambda tag, k=60: [f"{tag}{i}" for i in range(k)]
    a, c, clean = words("a"), words("c"), words("b")
    rows = [(1, " ".join(a)), (5, " ".join([*a, "more"])), (5, " ".join(clean)), (7, " ".join(c)), (7, " ".join([*c, "more"])), (8, " ".join([*c, "less"])), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter(tuples(jaccard_join.one_of_each(docs)))
    near = [k for k in got if k[0] == 7]
    assert got == collections.Counter([rows[0], rows[2], rows[6], *near]) and len(near) == 1 and near[0] in rows


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.integers(0, 30), st.integers(0, 30), st.integers(0, 99), st.sampled_from([80, 85]))
def test_linked_sets_share_a_signature(common, a, b, seed, percent):
    e = np.random.default_rng(seed).integers(0, 1 << 64, common + a + b, np.uint64)
    r, s = np.unique(e[: common + a]), np.unique(np.concatenate([e[:common], e[common + a :]]))
    both = len(np.intersect1d(r, s))
    if 100 * both >= percent * (len(r) + len(s) - both) and a + b:
        assert jaccard_join.sketches_allow(percent, len(r), jaccard_join.sketch(r), len(s), jaccard_join.sketch(s))
        assert jaccard_join.sets_link(percent, len(r), r.tobytes(), len(s), s.tobytes())
        sig, of = jaccard_join.signatures([r, s], percent)
        assert set(sig[of == 0].tolist()) & set(sig[of == 1].tolist())


@pytest.mark.parametrize("size,percent", [(60, 85), (200, 85), (3000, 85), (200, 80), (3000, 80)])
def test_unlike_sets_share_few_signatures(size, percent):
    """Pairs of similarity 0.5 share one signature in some pairs only, of 0.3 and less hardly ever."""
    rng = np.random.default_rng(size + percent)
    shared = {}
    for similarity in (0.5, 0.3, 0.0):
        common = round(2 * size * similarity / (1 + similarity))
        met = []
        for _ in range(100):
            e = rng.integers(0, 1 << 64, 2 * size - common, np.uint64)
            r, s = np.sort(e[:size]), np.sort(np.concatenate([e[:common], e[size:]]))
            sig, of = jaccard_join.signatures([r, s], percent)
            met.append(len(set(sig[of == 0].tolist()) & set(sig[of == 1].tolist())) / len(sig))
        shared[similarity] = np.mean(met)
    assert shared[0.0] < 0.0005 and shared[0.3] < 0.005 and shared[0.5] < (0.02 if percent == 85 else 0.03)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(1, 3000), st.integers(0, 99))
def test_sketches_of_different_lengths_fold(n, m, seed):
    e = np.random.default_rng(seed).integers(0, 1 << 64, n + m, np.uint64)
    r, s = np.unique(e[:n]), np.unique(e[n // 2 :])
    a, b = jaccard_join.sketch(r), jaccard_join.sketch(s)
    words = min(len(a), len(b)) // 8
    differ = int(np.bitwise_count(jaccard_join.folded(a, words) ^ jaccard_join.folded(b, words)).sum())
    assert differ <= len(np.setxor1d(r, s))


def group_texts(members, differing, seed, words=200):
    """Near copies of one text, each with ``differing`` words of its own."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(members):
        t = base.copy()
        for p in rng.choice(words, differing, replace=False):
            t[p] = f"m{i}p{p}"
        out.append(" ".join(t))
    return out


def test_large_group_of_alike_but_unlinked_texts(spark):
    """Thousands of texts that resemble each other without linking: nothing is joined, and the pairs written stay few."""
    rows = list(enumerate(group_texts(3000, 8, 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    classes, links = jaccard_join.jaccard_classes(docs, n=4, percent=85)
    got = {r.doc_id: r.component_id for r in classes.collect()}
    sets = jaccard_join.shingle_sets([t for _, t in rows], 4)
    linked = {(i, j) for i in range(0, 3000, 10) for j in range(i + 1, 3000, 7) if jaccard_join.sets_link(85, len(sets[i]), sets[i].tobytes(), len(sets[j]), sets[j].tobytes())}
    assert all(got[i] == got[j] for i, j in linked)
    if not linked:
        assert all(k == v for k, v in got.items()) and links.count() == 0


def test_large_group_of_linked_texts(spark):
    rows = list(enumerate(group_texts(3000, 2, 2)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    classes, links = jaccard_join.jaccard_classes(docs, n=4, percent=85)
    assert {r.component_id for r in classes.collect()} == {0}
    assert 2999 <= links.count() < 10 * 3000


def test_groups_are_cut_into_pairs_of_parts(spark, monkeypatch):
    """Parts of a group still meet each other."""
    nodes = np.arange(5000)
    parts = list(jaccard_join._parts(nodes))
    assert max(map(len, parts)) <= jaccard_join.GROUP
    met = set()
    for p in parts:
        met |= {(int(a), int(b)) for a in p[::97] for b in p[::89] if a < b}
    for a, b in [(0, 4999), (10, 1030), (1023, 1024), (1, 2), (4000, 4700)]:
        assert any(a in p and b in p for p in parts)
    assert met


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7), st.integers(0, 9)), max_size=30), st.lists(st.integers(0, 3), min_size=8, max_size=8))
def test_forest_joins_what_the_pairs_join(edges, roots):
    root = np.array(roots)
    edges = [e for e in edges if root[e[0]] != root[e[1]]]
    i, j, d = (np.array([e[k] for e in edges], np.int64) for k in range(3))

    def classes(which):
        label = {r: r for r in roots}
        for e in which:
            a, b = label[roots[i[e]]], label[roots[j[e]]]
            label = {k: min(a, b) if v in (a, b) else v for k, v in label.items()}
        return label

    keep = jaccard_join.spanning(i, j, d, root)
    assert classes(keep) == classes(range(len(edges))) and len(keep) < len(set(roots))


# -- lines ---------------------------------------------------------------------
def within(a, b, k):
    if abs(len(a) - len(b)) > k:
        return False
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            cur[j] = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y))
        prev = cur
    return prev[-1] <= k


def lines_by_brute_force(rows, edits=2, least=24):
    order = lambda i: (i is None, i or 0)
    first, near = {}, {}
    lines = sorted(((order(i), p, line) for i, t in rows for p, line in enumerate((t or "").split("\n")) if len(line) >= least))
    for at, p, line in lines:
        if line not in first:
            first[line] = (at, p)
            near[line] = sum(within(line, o, edits) for o in first if o != line and abs(len(o) - len(line)) <= edits)
    out = {}
    for i, t in rows:
        every = (t or "").split("\n")
        eq = [p for p, x in enumerate(every) if len(x) >= least and first[x] != (order(i), p)]
        nr = [p for p, x in enumerate(every) if len(x) >= least and first[x] == (order(i), p) and near[x]]
        out.setdefault(i, (len(every), len(eq), len(nr), ",".join(map(str, sorted(eq + nr)))))
    return out


def test_lines_equal_brute_force(spark):
    base = ["the quick brown fox jumps over the lazy dog", "a line that nobody else has written", "short", "Größe und Länge der Straße sind bekannt"]
    rows = [
        (1, "\n".join(base)), (2, base[0].replace("fox", "fix") + "\n" + base[0]), (3, base[0][1:-1] + "\nshort\n" + base[3][:-2]),
        (4, base[0][:-3] + "\n" + base[3].replace("ö", "o") + "\n"), (5, None), (6, ""), (None, base[1] + "\n" + base[1] + "!"), (7, base[1] + "!!"),
        (8, "x" * 3000 + "\n" + "x" * 3001 + "\n" + "x" * 3003), (9, "\n" * 5),
    ]
    docs = spark.createDataFrame([(i, t, "z", "z") for i, t in rows], "doc_id long, text string, lid string, pos string").repartition(4)
    want = lines_by_brute_force(rows)
    drop = collections.defaultdict(list)
    for r in line_dedup.dropped_lines(docs, short=False).collect():
        drop[r["doc"]].append((r["pos"], r["near"]))
    assert {i: (sum(not n for _, n in v), sum(n for _, n in v), ",".join(map(str, sorted(p for p, _ in v)))) for i, v in drop.items()} == {
        i: v[1:] for i, v in want.items() if v[1] + v[2]
    }
    cut = line_dedup.without_repeated_lines(docs, short=False)
    assert cut.columns == docs.columns
    for r in cut.collect():
        t = dict(rows)[r["doc_id"]]
        gone = {p for p, _ in drop[r["doc_id"]]}
        assert r["text"] == (None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone))


def test_banded_matching_equals_the_edit_distance(spark):
    rng = np.random.default_rng(11)
    letters = list("etaoin shrdluß😀")
    rows = []
    for _ in range(150):
        a = list(rng.choice(letters, rng.integers(1, 60)))
        b = a.copy()
        for _ in range(rng.integers(0, 6)):
            p, kind = int(rng.integers(0, len(b) + 1)), rng.integers(0, 3)
            b[p : p + (kind > 0)] = [] if kind == 1 else [rng.choice(letters)]
        rows.append(("".join(a), "".join(b)))
    rows += [("", "a"), ("a", ""), ("abc", "abc"), ("x" * 400, "x" * 399 + "y"), ("ab" * 150, "ba" * 150)]
    df = spark.createDataFrame(rows, "a string, b string")
    for k in (1, 2, 4):
        frame = F.lit(bytes(4 * k))
        wide = df.select("a", "b", F.encode("b", "UTF-32").alias("y"), F.concat(frame, F.encode("a", "UTF-32"), frame).alias("x")).cache()
        got = wide.select("a", "b", line_dedup.within_edits(F.col("x"), F.col("y"), k).alias("w")).collect()
        assert all(r["w"] == (within(r["a"], r["b"], k) and r["b"] != "") for r in got)


def test_lines_of_documents(spark, texts):
    got = {r[0]: (r[1], r[2], r[3], r[5]) for r in tuples(line_dedup.op7_line_dedup(spark, SF001))}
    assert got == lines_by_brute_force(texts)


def test_links_of_near_lines_equal_brute_force(spark):
    """All earlier neighbours count, also those of lines that one of them settles."""
    base = "every line of this group is alike but for few letters"
    rows = [(i, base[:p] + c + base[p + 1 :]) for i, (p, c) in enumerate((p, c) for p in (3, 20, 37, 50) for c in "xyz")]
    rows += [(100, rows[0][1] + "\n" + base), (101, base[1:]), (102, base + "!!"), (103, base + "!!!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    first, want = [], {}
    for i, t in rows:
        for p, line in enumerate(t.split("\n")):
            if line not in first:
                want[i, p] = sum(within(line, o, 2) for o in first)
                first.append(line)
    got = {(r["doc"], r["pos"]): r["links"] for r in line_dedup.dropped_lines(docs, short=False).collect() if r["near"]}
    assert got == {k: n for k, n in want.items() if n} and max(got.values()) > 10


def test_short_lines_that_stand_earlier_are_found(spark, texts):
    """Lines of 1 to 23 characters take part in exact dedup."""
    seen, want = set(), {}
    for i, t in texts:
        gone = [p for p, x in enumerate((t or "").split("\n")) if 0 < len(x) < 24 and (x in seen or seen.add(x))]
        want[i] = (len(gone), ",".join(map(str, gone)))
    rows = line_dedup.op7_line_dedup(spark, SF001).collect()
    assert {r["doc_id"]: (r["n_equal_short"], r["dropped_short"]) for r in rows} == want and any(n for n, _ in want.values())
    docs = spark.createDataFrame([(1, "short\n\nshort\nb"), (2, "b\n\nc"), (None, "c")], "doc_id long, text string")
    assert {(r["doc_id"], r["text"]) for r in line_dedup.without_repeated_lines(docs, short=True).collect()} == {(1, "short\n\nb"), (2, "\nc"), (None, "")}


def test_lines_of_texts_under_one_id(spark):
    """Null ids and repeated ids with other texts: a line that stands nowhere else always stays."""
    a, b, c = "a line that several of the texts have", "only the second text says this here", "another one that stands in a single text"
    rows = [(None, f"{a}\n{b}"), (None, f"{c}\n{a}"), (None, None), (4, f"{a}\nx"), (4, f"{c} and more of it\n{a}"), (4, f"{a}\nx"), (3, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for short in (False, True):
        got = [r["text"] for r in line_dedup.without_repeated_lines(docs, short=short).collect()]
        assert len(got) == len(rows) and got.count(None) == 1
        kept = "\n".join(t for t in got if t)
        assert all(line in kept.split("\n") for line in (a, b, c, f"{c} and more of it"))
        assert sum(a in t.split("\n") for t in got if t) == 1
    result = line_dedup.dropped_lines(docs).collect()
    assert len({(r["doc"], r["tid"], r["pos"]) for r in result}) <= len(result)


def test_lines_of_no_table(no_docs):
    assert tuples(line_dedup.dropped_lines(no_docs)) == []


@settings(max_examples=25, deadline=None)
@given(st.integers(24, 90), st.integers(1, 3))
def test_segments_cover_a_line(length, edits):
    def cut(i):
        base, longer = length // (edits + 1), length % (edits + 1)
        return base * (i - 1) + max(0, i - 1 - (edits + 1 - longer)) + 1, base + (i > edits + 1 - longer)

    at = 1
    for i in range(1, edits + 2):
        start, size = cut(i)
        assert start == at
        at += size
    assert at == length + 1


def components_by_walking(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {x: find(x) for x in parent}


def test_components_and_more_links(spark):
    """Chains, stars, cycles, repeated and self links; links that come later join what is there."""
    rng = np.random.default_rng(3)
    first = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(5, 5), (7, 6), (6, 7)] + [tuple(map(int, x)) for x in rng.integers(300, 420, (90, 2))]
    later = [(160, 259), (6, 300), (1, 2), (130, 131)]
    frame = lambda links: spark.createDataFrame(links, "a long, b long").repartition(3)
    one = jaccard_join.connected_components(frame(first))
    assert dict(tuples(one)) == components_by_walking(first) and one.count() == len(dict(tuples(one)))
    both = jaccard_join.joined_components(one, frame(later))
    assert dict(tuples(both)) == components_by_walking(first + later) and both.count() == len(dict(tuples(both)))
    assert jaccard_join.connected_components(frame([(1, 1)])).count() == 0
