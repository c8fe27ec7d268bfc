import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from viaduct.llm import alignment

from .conftest import tuples

ODD = [
    "a\tb", "a \n b", " x ", "x  ", "\n", "  ", "\r\n a; \r b", "▁x", "y ▁", "</s> [INST]", "<|endoftext|> a", "<0x41> é 漢字 漢字", "a b 　 c",
    "foo\x85bar", "\x1c a", "don't 's  's", "😀 😀‍👩", "a\x00b", "ab" * 300, "é" * 50 + " " + "á" * 2, "word " * 20_000, "漢" * 3000,
]


@pytest.fixture(scope="module")
def both():
    return alignment.Aligner()


def whole_text(both, text):
    """(A ids, B ids, overlapping pairs, groups) by whole-text tokenisation and plain loops; None without tokens."""
    if not text:
        return None
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(both.bytes_a[i] for i in a) != raw or b"".join(both.bytes_b[i] for i in b) != raw:
        return None
    end_a = np.cumsum([len(both.bytes_a[i]) for i in a]).tolist()
    end_b = np.cumsum([len(both.bytes_b[i]) for i in b]).tolist()
    links, i, j = [], 0, 0
    while i < len(a):
        links.append((a[i], b[j]))
        x, y = end_a[i], end_b[j]
        i, j = i + (x <= y), j + (y <= x)
    groups, i, j = [], 0, 0
    for end in sorted(set(end_a) & set(end_b)):
        x, y = end_a.index(end, i) + 1, end_b.index(end, j) + 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return a, b, links, groups


def written(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def by_brute_force(both, docs):
    read = [whole_text(both, t) for _, t in docs]
    count = Counter(p for r in read if r for p in set(r[2]))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for (doc_id, _), r in zip(docs, read, strict=True):
        if not r:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = r
        best = sum(count[p] == top[p[0]] for p in links)
        shared = sum(len(x) * len(y) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), shared, best, sum(count[p] for p in links), hashlib.sha256(written(groups).encode()).hexdigest()))
    return out, count


def test_documents_and_pairs_equal_brute_force(spark, both, odd_docs, odd, monkeypatch):
    docs = odd + [(2000 + i, t) for i, t in enumerate(ODD)]
    more = spark.createDataFrame([(i, t) for i, t in docs if i and i >= 2000], "doc_id long, text string").repartition(3)
    table = odd_docs.unionByName(more, allowMissingColumns=True)
    result, pairs = alignment.alignments(table, digest=True)
    want, count = by_brute_force(both, docs)
    order = lambda r: (r[0] is None, r)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(tuples(result), key=key) == sorted(want, key=key), order
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    assert sorted(tuples(pairs)) == sorted((a, b, n, n == top[a]) for (a, b), n in count.items())


def test_several_shards(spark, both, texts, monkeypatch):
    monkeypatch.setattr(alignment, "SHARD_BYTES", 1 << 16)
    table = spark.createDataFrame([(i, t) for i, t in texts], "doc_id long, text string").repartition(2)
    scan = alignment._analyser(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    assert scan
    result, _ = alignment.alignments(table)
    got = {r.doc_id: r for r in result.collect()}
    for (doc_id, _), want in zip(texts, by_brute_force(both, texts)[0], strict=True):
        assert tuple(got[doc_id])[:8] == want[:8]
        assert hashlib.sha256(got[doc_id].groups.encode()).hexdigest() == want[8]


def test_empty_table(spark, no_docs):
    result, pairs = alignment.alignments(no_docs)
    assert result.count() == 0 and pairs.count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 's.\n\t\r  éß漢▁<>1\x1c"), max_size=40))
def test_segments_read_as_whole_texts(both, text):
    got = next(both.texts([text]))
    want = whole_text(both, text)
    assert (got is None) == (want is None)
    if want:
        assert got[2] == written(want[3])
        assert sorted(got[1].tolist()) == sorted(a << 32 | b for a, b in want[2])


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 5), st.integers(1, 5), st.integers(1, 5), st.randoms(use_true_random=False))
def test_row_product(n, m, k, random):
    a = np.array([[random.random() < 0.4 for _ in range(m)] for _ in range(n)], int).reshape(n, m)
    b = np.array([[random.random() < 0.4 for _ in range(k)] for _ in range(m)], int).reshape(m, k)

    def csr(x):
        return alignment.Csr(np.concatenate([[0], np.cumsum(x.sum(1))]).astype(int), np.nonzero(x)[1], x.shape[1])

    row, column, value = csr(a).product(csr(b))
    dense = np.zeros((n, k), int)
    dense[row, column] = value
    assert (dense == a @ b).all()
    assert csr(a).product_sizes(csr(b)).tolist() == (a @ b).sum(1).tolist()
    assert (csr(a).transposed().product_sizes(csr(np.ones((n, 1), int))) == a.sum(0)).all()
