"""Chat formatting over a prefix tree.

Each turn becomes marks and an escaped text, tokenised in three pieces (mark, text, mark), so the loss mask,
the texts of assistant turns, falls on token boundaries. Control strings of the template inside a text or
a role get a backslash after their first character (one more if backslashes stand there), which `unescaped` takes off.

Conversations that share their initial turns share the nodes of a prefix tree. A node is known by a 128-bit
hash over its turn and its parent's hash, which one sorted pass over the turns carries along. Distinct
paths are sorted by their hashes; that order is depth-first, and a node belongs to the first path that
holds it (a minimum per hash, combined in the map tasks). Prefix sums over the parts of the sort and inside each part place
the nodes on one stream of tokens, so each node is emitted once and no task holds a whole tree, even if a
first turn opens a third of all conversations. What a conversation sees of the stream is a few intervals: nodes that follow their
parent directly lengthen its interval, called a run; a new interval begins where the path leaves the
stream. `formatted` gives for each node its place, tokens, position ids (tokens since the start of
its conversation, from ``position`` on), loss mask and the intervals its tokens may attend to besides themselves.

`read_back` rebuilds every conversation from that output alone: a path's intervals name the runs and
how many nodes of each, their tokens are decoded, parsed and unescaped.

Hot keys. All joins on node hashes, runs and paths have one row per key on one side, so Spark can split the
other side; conversations that are equal as a whole are one path. A single conversation is read as a stream: its
turns pass one task, in memory stay its hashes.

Defined results: turns are ordered by turn, role, text (nulls first); repeated rows are turns of their own; null roles and
texts are empty; rows without conv_id are one conversation with a null id; roles besides system, user and assistant are
kept with their name; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .alignment import byte_letters
from .common import map_arrow, staged

TOKENIZER = "byte_bpe_50k.json"
KEY_BYTES = 16

# The template: what opens and closes a turn of a role; other roles are named in their turn.
MARKS = {"system": ("<<SYS>> ", " <</SYS>>\n"), "user": ("[INST] ", " [/INST]\n"), "assistant": ("<s> ", " </s>\n")}
NAMED = ("[ROLE] ", " [:] ", " [/ROLE]\n")
CONTROL = sorted({m.strip() for marks in [*MARKS.values(), NAMED] for m in marks}, key=len, reverse=True)
LOSS_ROLE = "assistant"

_PLAIN = re.compile("|".join(re.escape(c[0]) + r"(?=\\*" + re.escape(c[1:]) + ")" for c in CONTROL))
_ESCAPED = re.compile("|".join("(?<=" + re.escape(c[0]) + r")\\(?=\\*" + re.escape(c[1:]) + ")" for c in CONTROL))
_TURN = re.compile(
    "|".join(f"{re.escape(a)}(?P<{role}>.*?){re.escape(b)}" for role, (a, b) in MARKS.items())
    + f"|{re.escape(NAMED[0])}(?P<role>.*?){re.escape(NAMED[1])}(?P<text>.*?){re.escape(NAMED[2])}",
    re.DOTALL,
)


def escaped(text: str) -> str:
    return _PLAIN.sub(lambda m: m[0] + "\\", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub("", text)


def pieces(role: str, text: str) -> tuple[str, str, str]:
    """(mark, escaped text, mark) of a turn."""
    if role in MARKS:
        return MARKS[role][0], escaped(text), MARKS[role][1]
    return NAMED[0] + escaped(role) + NAMED[1], escaped(text), NAMED[2]


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        role = m.lastgroup if m.lastgroup in MARKS else unescaped(m["role"])
        out.append((role, unescaped(m[m.lastgroup])))
    return out


class Codec:
    """Token ids of texts, and back."""

    def __init__(self, file: str) -> None:
        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file if os.path.isabs(file) else public_tokenizers.path(file))
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        self.bytes = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.marks: dict[str, bytes] = {}

    def texts(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<i4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def mark(self, mark: str) -> bytes:
        """A bounded cache: roles may be any text."""
        if mark not in self.marks:
            if len(self.marks) > 1000:
                self.marks.clear()
            self.marks[mark] = self.texts([mark])[0]
        return self.marks[mark]

    def text(self, ids: np.ndarray) -> str:
        return b"".join([self.bytes[i] for i in ids.tolist()]).decode("utf-8")


_codecs: dict[str, Codec] = {}


def codec(file: str) -> Codec:
    """One per worker."""
    if file not in _codecs:
        _codecs[file] = Codec(file)
    return _codecs[file]


_TURNS = "uid long, conv_id long, k int, ids binary, size long, loss_low long, loss_high long, path binary"
_TURN_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_TURN_NAMES = ["uid", "conv_id", "k", "ids", "size", "loss_low", "loss_high", "path"]


def _table(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _chains(file: str):
    """Turns with their tokens, then one row with the path of hashes per conversation; rows come sorted by conversation and turn."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(file)
        uid = (TaskContext.get().partitionId() << 33) - 1
        conv, key, path, k = object(), b"", [], 0
        for whole in batches:
            for low in range(0, whole.num_rows, 1024):
                batch = whole.slice(low, 1024)
                roles, texts = ([x or "" for x in batch.column(c).to_pylist()] for c in ("role", "text"))
                cut = [pieces(r, t) for r, t in zip(roles, texts, strict=True)]
                bodies = code.texts([p[1] for p in cut])
                out = []
                for conv_id, role, text, (head, _, foot), body in zip(batch.column("conv_id").to_pylist(), roles, texts, cut, bodies, strict=True):
                    if conv_id != conv:
                        if path:
                            out.append((uid, conv, None, None, None, None, None, b"".join(path)))
                        uid, conv, key, path, k = uid + 1, conv_id, b"", [], 0
                    r, t = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
                    key = hashlib.blake2b(key + len(r).to_bytes(8, "little") + r + t, digest_size=KEY_BYTES).digest()
                    path.append(key)
                    head, foot = code.mark(head), code.mark(foot)
                    lo, hi = len(head) // 4, (len(head) + len(body)) // 4
                    out.append((uid, conv_id, k, head + body + foot, hi + len(foot) // 4, lo, hi if role == LOSS_ROLE else lo, None))
                    k += 1
                yield _table(out, _TURN_TYPES, _TURN_NAMES)
        if path:
            yield _table([(uid, conv, None, None, None, None, None, b"".join(path))], _TURN_TYPES, _TURN_NAMES)

    return scan


_INTERVALS = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int32())]))
_PLACED = "rank long, k int, own boolean, last boolean, tree long, start long, size long, position long, run long, run_at int, intervals array<struct<low long, high long, turns int>>"
_PLACED_TYPES = [pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), *[pa.int64()] * 5, pa.int32(), _INTERVALS]
_PLACED_NAMES = ["rank", "k", "own", "last", "tree", "start", "size", "position", "run", "run_at", "intervals"]


def _along_paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own nodes and last nodes of paths with what they attend to; rows come sorted by path and depth."""
    seen: list[list[int]] = []
    tree = position = 0
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("rank", "k", "turns", "start", "size", "own"))
        for rank, k, turns, start, size, own in zip(*columns, strict=True):
            if not k:
                seen, tree, position = [], start, 0
            joins = bool(seen) and seen[-1][1] == start
            run, at = (seen[-1][0], seen[-1][2]) if joins else (start, 0)
            if own or k + 1 == turns:
                out.append((rank, k, own, k + 1 == turns, tree, start, size, position, run, at, [tuple(x) for x in seen]))
            if joins:
                seen[-1][1] += size
                seen[-1][2] += 1
            else:
                seen.append([start, start + size, 1])
            position += size
        if out:
            yield _table(out, _PLACED_TYPES, _PLACED_NAMES)


class Formatted:
    """Result of `formatted`.

    ``stream``: one row per node: tree (place of its root), start, size, position, run, run_at, intervals, ids (32-bit,
    little-endian), loss_low, loss_high; ordered by ``start`` it is the token stream.
    ``conversations``: conv_id, leaf. ``leaves``: leaf, intervals (the last turn's own interval included).
    """

    def __init__(self, stream: DataFrame, conversations: DataFrame, leaves: DataFrame, tokenizer: str) -> None:
        self.stream, self.conversations, self.leaves, self.tokenizer = stream, conversations, leaves, tokenizer


def formatted(rows: DataFrame, tokenizer: str = TOKENIZER) -> Formatted:
    """Rows (conv_id, turn, role, text) as a token stream of prefix trees."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    table = staged(map_arrow(rows, _chains(tokenizer), _TURNS), "chat-turns")
    turns = table.where("path IS NULL")
    whole = table.where("path IS NOT NULL").select("uid", "conv_id", "path", F.substring("path", -KEY_BYTES, KEY_BYTES).alias("leaf_key"))

    paths = whole.groupBy("path").agg(F.min("uid").alias("uid"))
    ranked = paths.repartitionByRange("path").sortWithinPartitions("path").withColumn("rank", F.monotonically_increasing_id())
    ranked = staged(ranked, "chat-paths")
    keys = F.expr(f"transform(sequence(0, length(path) div {KEY_BYTES} - 1), i -> substring(path, CAST(i * {KEY_BYTES} + 1 AS int), {KEY_BYTES}))")
    steps = ranked.select("rank", "uid", F.expr(f"CAST(length(path) div {KEY_BYTES} AS int)").alias("turns"), F.posexplode(keys).alias("k", "key"))

    owners = steps.groupBy("key").agg(F.min("rank").alias("rank"), F.min("k").alias("k"))
    nodes = owners.join(ranked.select("rank", "uid"), "rank").join(turns.select("uid", "k", "size"), ["uid", "k"])
    nodes = staged(nodes.withColumn("part", F.shiftright("rank", 33)), "chat-nodes")
    parts = nodes.groupBy("part").agg(F.sum("size").alias("total"))
    before = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = F.sum("size").over(Window.partitionBy("part").orderBy("rank", "k")) - F.col("size")
    nodes = nodes.withColumn("inside", inside).join(before, "part")
    nodes = staged(nodes.select("key", F.col("rank").alias("owner"), (F.col("before") + F.col("inside")).alias("start"), "size"), "chat-places")

    along = steps.join(nodes, "key").select("rank", "k", "turns", "start", "size", (F.col("owner") == F.col("rank")).alias("own"))
    along = along.repartition("rank").sortWithinPartitions("rank", "k")
    placed = staged(map_arrow(along, _along_paths, _PLACED), "chat-placed")
    content = turns.select("uid", "k", "ids", "loss_low", "loss_high")
    stream = placed.where("own").join(ranked.select("rank", "uid"), "rank").join(content, ["uid", "k"])
    stream = staged(stream.select("tree", "start", "size", "position", "run", "run_at", "intervals", "ids", "loss_low", "loss_high"), "chat-stream")
    own = F.struct(F.col("start").alias("low"), (F.col("start") + F.col("size")).alias("high"), F.lit(1).alias("turns"))
    longer = F.expr(
        "IF(run_at > 0, transform(intervals, x -> IF(x.low = run, named_struct('low', x.low, 'high', start + size, 'turns', x.turns + 1), x)), NULL)"
    )
    leaves = placed.where("last").select(F.col("rank").alias("leaf"), F.coalesce(longer, F.concat("intervals", F.array(own))).alias("intervals"))
    names = ranked.select(F.col("rank").alias("leaf"), F.substring("path", -KEY_BYTES, KEY_BYTES).alias("leaf_key"))
    conversations = whole.select("conv_id", "leaf_key").join(names, "leaf_key").select("conv_id", "leaf")
    return Formatted(stream, conversations, leaves, tokenizer)


_READ = "leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
_READ_NAMES = ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
_READ_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]


def _reader(file: str):
    """Digests of paths; rows come sorted by path and place in it."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(file)
        leaf = None
        n = loss_chars = chars = tokens = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("leaf", "ids", "loss_low", "loss_high"))
            for at, ids, low, high in zip(*columns, strict=True):
                if at != leaf:
                    if leaf is not None:
                        out.append((leaf, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, tokens))
                    leaf, n, loss_chars, chars, tokens = at, 0, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                numbers = np.frombuffer(ids, "<i4")
                text = code.text(numbers)
                for role, said in parsed(text):
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                masked = unescaped(code.text(numbers[low:high]))
                loss.update(masked.encode("utf-8", "surrogatepass"))
                loss_chars, chars, tokens = loss_chars + len(masked), chars + len(text), tokens + len(numbers)
            if out:
                yield _table(out, _READ_TYPES, _READ_NAMES)
        if leaf is not None:
            yield _table([(leaf, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, tokens)], _READ_TYPES, _READ_NAMES)

    return scan


def read_back(result: Formatted) -> DataFrame:
    """One row per conversation, from the stream and the intervals: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens."""
    runs = result.leaves.select("leaf", F.posexplode("intervals").alias("i", "x"))
    wanted = runs.select("leaf", "i", F.col("x.low").alias("run"), F.explode(F.expr("sequence(0, x.turns - 1)")).alias("run_at"))
    seen = wanted.join(result.stream.select("run", "run_at", "ids", "loss_low", "loss_high"), ["run", "run_at"])
    seen = seen.repartition("leaf").sortWithinPartitions("leaf", "i", "run_at").select("leaf", "ids", "loss_low", "loss_high")
    digests = staged(map_arrow(seen, _reader(result.tokenizer), _READ), "chat-read")
    return result.conversations.join(digests, "leaf").drop("leaf")


def op11_chat_formatting(spark, sf_dir: str) -> DataFrame:
    planted = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(formatted(rows.unionByName(more)))
