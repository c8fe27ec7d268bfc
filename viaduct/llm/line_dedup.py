"""Line dedup by a segment-partition edit join (DataFrame functions only).

A line (text between line feeds) of at least ``MIN_CHARS`` characters is dropped
when it stands earlier in the corpus (by document id, then line number), or
when an earlier line lies within ``EDITS`` edits of it. Of shorter lines, ``short`` takes those
in that aren't empty and stand earlier: two edits turn short lines into other ones
(another number, another name), so the near join alone has the lower bound.

Candidates. A line of length L is cut into ``EDITS + 1`` even segments; two
lines within ``EDITS`` edits agree on a whole segment of the shorter one. A
longer line probes the segments of lengths L to L - EDITS only at the positions
that the edits left and right of a segment still allow (12 substrings for two
edits). A signature is the hash of (indexed length, segment number, substring).

Work. Signatures are made where the text is read; equal lines share an id, so
the aggregate that finds signatures of several lines combines copies map-side.
Only lines of such signatures are listed. All their pairs are verified whose letter
counts differ by at most two per edit (an edit changes two counts by one at most, so
the filter in the join condition loses no pair): links are counted for every line, also
for one that an earlier link drops, so a group of alike lines costs its pairs.
Verification is bit-parallel in a band of ``2 EDITS + 1`` diagonals, over the whole
lines: see `within_edits`.

Lines are identified by 64 + 32 hash bits and the length. Defined results: null
text is one empty line; rows that repeat an id with the same
text are one document (a line number is dropped in all of them or in none), with other texts documents of
their own, in the order of a hash of their texts; a null id orders last; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, staged, text_or_empty

EDITS = 2
MIN_CHARS = 24
# Rows of two longs that may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 2_000_000
LAST = (1 << 63) - 1
# Letters whose counts must nearly agree in lines within a few edits.
LETTERS = "etaoinsrhdlu"


def bounded(rows: DataFrame) -> DataFrame:
    """Marked for broadcast within the checked size, as is beyond it."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, tid, pos, line) of every line; ``tid`` tells the texts of one id apart."""
    text = text_or_empty(F.col(f"`{text_col}`"))
    doc = F.col(f"`{id_col}`").cast("long").alias("doc")
    return docs.select(doc, F.xxhash64(text).alias("tid"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))


def signatures(lines: DataFrame, edits: int) -> DataFrame:
    """(lid, sig, own): all signatures a line probes; those of its own segments are among them (``own``).

    A line of 32-bit characters is cut by bytes, without counting characters anew
    for each piece. The last segments are one longer where the length isn't even.
    """
    parts = edits + 1
    wide = lines.select(F.xxhash64("line").alias("lid"), "length", F.encode("line", "UTF-32").alias("wide"))
    for less in range(parts):
        target = F.col("length") - less
        wide = wide.withColumns({f"b{less}": F.floor(target / parts).cast("int"), f"r{less}": F.pmod(target, F.lit(parts))})
    out = []
    for less in range(parts):
        base, longer = F.col(f"b{less}"), F.col(f"r{less}")
        for i in range(1, parts + 1):
            start = base * (i - 1) + F.greatest(F.lit(0), longer - (parts - i + 1)) + 1
            size = base + F.when(longer >= parts - i + 1, 1).otherwise(0)
            left, right = i - 1, parts - i
            for shift in range(max(-left, less - right), min(left, less + right) + 1):
                piece = F.substring("wide", 4 * (start + (shift - 1)) + 1, 4 * size)
                sig = F.xxhash64(F.col("length") - less, F.lit(i), piece)
                out.append(F.struct(sig.alias("sig"), F.lit(int(less == 0 and shift == 0)).alias("own")))
    return wide.select("lid", F.inline(F.array(*out)))


def within_edits(framed: Column, wide: Column, edits: int) -> Column:
    """Whether two lines lie within ``edits`` edits (at most 4), by banded bit-parallel matching.

    Lines are UTF-32 bytes, the first one framed by ``edits`` zero characters on
    either side, so the band of a step is a window of it. The state packs
    ``edits + 1`` vectors of ``2 edits + 1`` bits: bit b of vector d says that the first
    line's prefix ending on diagonal b matches what was read of the second one with at
    most d edits. A step reads one character: its equality mask over the window, then
    match, substitution, insertion and deletion on whole vectors.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    n, m = (F.length(wide) / 4).cast("int"), (F.length(framed) / 4).cast("int") - 2 * edits
    begin = sum(1 << (b + width * d) for d in range(edits + 1) for b in range(width) if 0 <= b - edits <= d)

    def mask(j: Column) -> Column:
        c, out = F.substring(wide, 4 * j + 1, 4), F.lit(0).cast("long")
        for b in range(width):
            out = out.bitwiseOR(F.when(F.substring(framed, 4 * (j + b) + 1, 4) == c, F.lit(1 << b).cast("long")).otherwise(F.lit(0).cast("long")))
        return out

    def step(state: Column, equal: Column) -> Column:
        old = [F.shiftright(state, width * d).bitwiseAND(full) for d in range(edits + 1)]
        new = old[0].bitwiseAND(equal)
        out = new
        for d in range(1, edits + 1):
            new = old[d].bitwiseAND(equal).bitwiseOR(old[d - 1]).bitwiseOR(F.shiftright(old[d - 1], 1)).bitwiseOR(F.shiftleft(new, 1)).bitwiseAND(full)
            out = out.bitwiseOR(F.shiftleft(new, width * d))
        return out

    read = F.transform(F.sequence(F.lit(0), n - 1), mask)
    end = F.aggregate(read, F.lit(begin).cast("long"), step)
    bit = F.call_function("shiftright", end, m - n + edits + width * edits).bitwiseAND(1)
    return F.when((F.abs(m - n) > edits) | (n < 1), F.lit(False)).otherwise(bit == 1)


def line_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS, short: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(occurrences, first occurrences, near links).

    occurrences: doc, tid, pos, lid; first: lid, doc, tid, pos of each distinct line; links:
    (lid, other), ``other`` being an earlier line within ``edits`` edits. With ``short``,
    occurrences and first hold the lines of 1 to ``min_chars - 1`` characters too.
    """
    every = lines_of(docs, id_col, text_col).withColumn("length", F.length("line"))
    every, lines = every.where(F.col("length") >= (1 if short else min_chars)), every.where(F.col("length") >= min_chars)
    key = [F.xxhash64("line").alias("lid"), F.hash("line").alias("h"), "length"]
    order = F.coalesce("doc", F.lit(LAST))
    occurrences = every.select("doc", order.alias("ord"), "tid", "pos", *key)
    # Smallest document first, then the smallest line number in it: two hash aggregates, map-side combined.
    in_doc = occurrences.groupBy("lid", "h", "length", "ord", "tid").agg(F.min("pos").alias("pos"))
    first_doc = in_doc.groupBy("lid", "h", "length").agg(F.min(F.struct("ord", "tid", "pos")).alias("first"))
    firsts = staged(first_doc.select("lid", "h", "length", "first.ord", "first.tid", "first.pos"), "lines-first")

    signed = signatures(lines, edits)
    shared = signed.groupBy("sig").agg(F.min("lid").alias("a"), F.max("lid").alias("b"), F.max("own").alias("own"))
    shared = staged(shared.where("a <> b AND own = 1").select("sig"), "lines-shared")
    members = signed.join(bounded(shared), "sig").groupBy("sig", "lid").agg(F.max("own").alias("own"))
    place = firsts.groupBy("lid").agg(F.min(F.struct("ord", "tid", "pos")).alias("at"))
    members = staged(members.join(place, "lid"), "lines-members")

    lids = staged(members.select("lid").distinct(), "lines-lids")
    texts = lines.select(F.xxhash64("line").alias("lid"), "line").join(bounded(lids), "lid").groupBy("lid", "line").count()
    counts = [F.regexp_count("line", F.lit(c)).cast("int").alias(f"n_{c}") for c in LETTERS]
    texts = staged(texts.select("lid", "line", F.array(*counts).alias("letters")), "lines-texts")

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs (lid, other) within the edits; ``other`` is the earlier line."""
        pairs = staged(pairs.select("lid", "other").distinct(), "lines-pairs")
        both = pairs.join(texts.select("lid", "line"), "lid").join(texts.select(F.col("lid").alias("other"), F.col("line").alias("earlier")), "other")
        frame = F.lit(bytes(4 * edits))
        framed = F.concat(frame, F.encode("earlier", "UTF-32"), frame).alias("framed")
        both = staged(both.select("lid", "other", framed, F.encode("line", "UTF-32").alias("wide")), "lines-wide")
        return staged(both.where(within_edits(F.col("framed"), F.col("wide"), edits)).select("lid", "other").distinct(), "lines-links")

    letters = texts.groupBy("lid").agg(*[F.min(F.col("letters")[i]).alias(f"c{i}") for i in range(len(LETTERS))])
    counted = staged(members.join(letters, "lid"), "lines-counted")
    other = {"lid": "other", "at": "other_at", "own": "other_own"} | {f"c{i}": f"d{i}" for i in range(len(LETTERS))}
    alike = " + ".join(f"abs(c{i} - d{i})" for i in range(len(LETTERS))) + f" <= {2 * edits}"
    # Every line meets every earlier line of its signatures, dropped or not, so links are whole.
    earlier = counted.withColumnsRenamed(other)
    before = F.struct("other_at", "other") < F.struct("at", "lid")
    pairs = counted.join(earlier, "sig").where(before).where(f"own + other_own > 0 AND {alike}")
    return occurrences, firsts, verified(pairs)


def dropped_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS, short: bool = True
) -> DataFrame:
    """(doc, tid, pos, near, links, length): lines to drop, ``near`` where no equal line stands earlier."""
    occurrences, firsts, links = line_classes(docs, id_col, text_col, edits, min_chars, short)
    near = links.groupBy("lid").agg(F.count("*").alias("links"))
    firsts = firsts.join(near, "lid", "left").withColumnsRenamed({"ord": "first_ord", "tid": "first_tid", "pos": "first_pos"})
    every = occurrences.join(firsts, ["lid", "h", "length"])
    repeat = (F.col("ord") != F.col("first_ord")) | (F.col("tid") != F.col("first_tid")) | (F.col("pos") != F.col("first_pos"))
    every = every.where(repeat | F.col("links").isNotNull())
    return every.select("doc", "tid", "pos", (~repeat).alias("near"), F.coalesce("links", F.lit(0)).alias("links"), "length")


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the dropped lines cut out of their texts; a null text stays null."""
    drop = dropped_lines(docs, id_col, text_col, **how).groupBy("doc", "tid").agg(F.collect_set("pos").alias("_drop"))
    kept = F.filter(F.split(F.col(f"_row.`{text_col}`"), "\n", -1), lambda _, i: ~F.array_contains("_drop", i))
    text = F.when(F.col("_drop").isNull(), F.col(f"_row.`{text_col}`")).otherwise(F.array_join(kept, "\n"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_i"), F.xxhash64(text_or_empty(F.col(f"`{text_col}`"))).alias("_t"))
    joined = rows.join(drop, F.col("_i").eqNullSafe(F.col("doc")) & (F.col("_t") == F.col("tid")), "left")
    return joined.select(*[(text if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    """One row per document: lines, dropped lines (equal, near), links of its near lines, dropped line numbers; repeats below ``MIN_CHARS`` apart."""
    docs = documents(spark, sf_dir)
    short = F.col("length") < MIN_CHARS
    numbers = lambda which: F.array_join(F.array_sort(F.collect_list(F.when(which, F.col("pos")))), ",")
    drop = dropped_lines(docs, short=True).groupBy("doc", "tid").agg(
        F.count_if(~F.col("near") & ~short).alias("n_equal"), F.count_if("near").alias("n_near"),
        F.sum("links").alias("n_links"), numbers(~short).alias("dropped"),
        F.count_if(short).alias("n_equal_short"), numbers(short).alias("dropped_short"),
    )
    every = docs.select("doc_id", F.xxhash64(text_or_empty("text")).alias("_t"), F.size(F.split(text_or_empty("text"), "\n", -1)).cast("long").alias("n_lines"))
    joined = every.join(drop, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("_t") == F.col("tid")), "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    listed = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return joined.select(
        "doc_id", "n_lines", number("n_equal"), number("n_near"), number("n_links"), listed("dropped"), number("n_equal_short"), listed("dropped_short")
    )
