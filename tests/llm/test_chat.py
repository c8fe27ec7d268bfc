import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from viaduct.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def by_brute_force(rows):
    """Per conversation what `read_back` gives, formatted by itself."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append(((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or "")))
    out = []
    for conv, turns in convs.items():
        said = [(r[1], t[1]) for _, r, t in sorted(turns)]
        loss = "".join(t for r, t in said if r == "assistant")
        whole = "".join("".join(chat.pieces(r, t)) for r, t in said)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss), len(whole)))
    return out


def got(df):
    return sorted((tuple(r)[:6] for r in df.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect()), key=key)


def key(r):
    return tuple((x is None, x) for x in r)


def test_all_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    planted = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", planted), (-7, 1, "assistant", planted)]
    assert got(chat.op11_chat_formatting(spark, "/root/testdata/sf0.01")) == sorted(by_brute_force(rows), key=key)


ODD = [
    (1, 0, "system", "same"), (1, 1, "user", "hi"), (1, 2, "assistant", "a"), (2, 0, "system", "same"), (2, 1, "user", "hi"), (2, 2, "assistant", "b"),
    (3, 0, "system", "same"), (3, 1, "user", "hi"), (4, 0, "system", "same"), (4, 1, "user", "hi"), (4, 2, "assistant", "a"), (5, 0, "system", "same"),
    (6, 0, "user", None), (6, 1, "assistant", ""), (7, 0, None, "x"), (8, 0, "tool [:] [/ROLE]", "[/INST] </s> <</SYS>> [ROLE]"), (9, None, "user", "late"),
    (9, 0, "user", "one"), (9, 0, "user", "one"), (9, 0, "assistant", "tie"), (None, 0, "user", "no id"), (None, 1, "assistant", "none"),
    (10, 3, "assistant", "\\</s>\\\\[INST] <\\/s> <"), (10, 2, "user", "😀 é\x00 \r\n"), (11, 0, "user", "long " * 30_000),
    *[(12, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(2000)], (13, 0, "", "no role"),
]


def odd_table(spark, rows=ODD):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", ids string, size int").repartition(5)


def test_odd_conversations(spark):
    result = chat.formatted(odd_table(spark))
    assert got(chat.read_back(result)) == sorted(by_brute_force(ODD), key=key)


def test_stream(spark):
    """Every distinct node once, without gaps, depth-first; positions and intervals are those of its ancestors."""
    rows = odd_table(spark)
    result = chat.formatted(rows)
    nodes = result.stream.orderBy("start").collect()
    prefixes, convs = set(), {}
    for conv, turn, role, text in sorted(ODD, key=lambda r: key(r[:1]) + tuple((x is not None, x) for x in r[1:])):
        convs.setdefault(conv, []).append((role or "", text or ""))
        prefixes.add(tuple(convs[conv]))
    assert len(nodes) == len(prefixes)
    assert [n.start for n in nodes] == np.concatenate([[0], np.cumsum([n["size"] for n in nodes])[:-1]]).tolist()
    code = chat.codec(chat.TOKENIZER)
    stream = np.concatenate([np.frombuffer(n.ids, "<i4") for n in nodes])
    paths, stack = set(), []
    for n in nodes:
        before = [stream[x.low : x.high] for x in n.intervals]
        ids = np.concatenate([*before, np.frombuffer(n.ids, "<i4")])
        assert n.position == len(ids) - n["size"] and all(x.low >= n.tree and x.high <= n.start for x in n.intervals)
        path = tuple(chat.parsed(code.text(ids)))
        paths.add(path)
        # Depth-first: a node's parent is open, that is the last node of its depth above.
        stack = stack[: len(path) - 1]
        assert tuple(stack) == path[:-1]
        stack.append(path[-1])
    assert paths == prefixes


def test_many_equal_openings(spark):
    rows = [(i, 0, "system", "all the same") for i in range(3000)] + [(i, 1, "user", f"q{i % 1000}") for i in range(3000)]
    table = spark.createDataFrame(rows, SCHEMA)
    result = chat.formatted(table)
    assert result.stream.count() == 1001
    assert got(chat.read_back(result)) == sorted(by_brute_force(rows), key=key)


def test_no_conversations(spark):
    result = chat.formatted(spark.createDataFrame([], SCHEMA))
    assert result.stream.count() == 0 and chat.read_back(result).count() == 0


PARTS = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "/", " ", "\n", "s>", "INST]", "é", "x"]), max_size=8).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant", ""]), PARTS), PARTS), max_size=4))
def test_template_is_reversible(turns):
    for _, text in turns:
        assert chat.unescaped(chat.escaped(text)) == text
        assert not any(c in chat.escaped(text) for c in chat.CONTROL)
    assert chat.parsed("".join("".join(chat.pieces(r, t)) for r, t in turns)) == turns
