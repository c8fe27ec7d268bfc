"""Mixing sources to target weights (DataFrame functions only).

A document's size is its number of words. Sources, by code point and null
last, weigh 5, 2, 1, repeating, and share all words; a target stops at three
times its source's words and the excess is reshared by weight until none is
above (water filling: sort sources by the share at which they saturate).

Within a source, whole epochs come first: a target of e times the source and
a rest takes each document e times. The rest is drawn without replacement by
Efraimidis-Spirakis: key ``-ln(u) / weight`` with ``u`` from the id and the
seed and the document's quality weight (share of words without junk marks);
documents in ascending key order, ids breaking ties, are taken while the prefix
sum of sizes fits the rest, and the document at the edge gives the words that
are still missing.

No source is ever sorted whole. ``1 - exp(-key)`` falls into ``BINS`` bins of
key order; sizes are summed by source and bin (map-side combined), whole bins
before the edge are taken, whole bins after it are not, and only the documents
of each source's edge bin are sorted.

Defined results: null text has size 0; a null source is a source of its own; a
null id orders first; rows with one id and one key split the edge in any but
a repeatable order (by id, size); sources without words have target 0; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, documents, staged

WEIGHTS = (5, 2, 1)
CAP = 3
BINS = 4096
JUNK = r"[%$&*#!|]"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.1 plus the share of characters that aren't junk marks (1.1 for an empty text)."""
    plain = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(plain), F.lit(1))
    return F.lit(0.1) + (n - F.regexp_count(plain, F.lit(JUNK))) / n


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from the id: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, epochs, rest) from rows (source, size).

    The windows run over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    choice = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    per = per.withColumn("w", choice.cast("long"))
    # Ascending saturation 3 * size / weight, compared as exact cross products of integers.
    by_share = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = by_share.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    per = per.select(
        "*", F.sum("source_size").over(every).alias("total"), F.row_number().over(by_share).alias("k"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("size_before"),
        (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("w_left"),
    )
    left = F.col("total") - cap * F.col("size_before")
    fits = F.col("w") * left <= cap * F.col("source_size") * F.col("w_left")
    first = F.min(F.when(fits, F.col("k"))).over(every)
    level = F.max(F.when(F.col("k") == first, left)).over(every)
    share = F.max(F.when(F.col("k") == first, F.col("w_left"))).over(every)
    per = per.select("source", "source_size", "w", "k", first.alias("first"), level.alias("level"), share.alias("share"))
    target = F.when(F.col("k") < F.col("first"), (cap * F.col("source_size")).cast("double")).otherwise(
        (F.col("w") * F.col("level")).cast("double") / F.col("share")
    )
    per = per.select("source", "source_size", target.alias("target"))
    words = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(cap), F.floor(words / F.col("source_size")))).otherwise(0)
    return per.select("*", epochs.cast("long").alias("epochs"), (words - epochs * F.col("source_size")).alias("rest"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 17, bins: int = BINS, keep: bool = False,
) -> DataFrame:
    """doc_id, size, source_size, target, taken (words), and the row as ``row`` if ``keep``."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), word_count(text).alias("size"),
        (-F.log(uniform(F.col(f"`{id_col}`"), seed)) / quality_weight(text)).alias("key"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep else []),
    )
    rows = rows.withColumn("bin", F.least(F.lit(bins - 1), F.floor((1 - F.exp(-F.col("key"))) * bins)).cast("int"))
    # Texts are read once for all statistics (and once more where the rows are kept).
    narrow = staged(rows.drop("row"), "mix-sizes")
    rows = rows if keep else narrow
    targets = staged(source_targets(narrow, weights, cap), "mix-targets")
    loads = narrow.groupBy("source", "bin").agg(F.sum("size").alias("load"))
    run = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    loads = loads.withColumn("upto", F.sum("load").over(run)).withColumnRenamed("source", "src")
    edges = targets.join(loads, F.col("source").eqNullSafe(F.col("src")), "left").groupBy(
        "source", "source_size", "target", "epochs", "rest"
    ).agg(
        F.coalesce(F.min(F.when(F.col("upto") >= F.col("rest"), F.col("bin"))), F.lit(bins)).alias("edge"),
        F.coalesce(F.max(F.when(F.col("upto") < F.col("rest"), F.col("upto"))), F.lit(0)).alias("below"),
    ).withColumnRenamed("source", "src")
    edges = staged(edges, "mix-edges")
    placed = rows.join(edges, F.col("source").eqNullSafe(F.col("src"))).drop("src")
    whole = placed.where("bin <> edge").withColumn("part", F.when(F.col("bin") < F.col("edge"), F.col("size")).otherwise(0))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("rest") - F.col("below") - F.coalesce(F.sum("size").over(order), F.lit(0))
    partial = placed.where("bin = edge").withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), room)))
    taken = (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken")
    columns = ["doc_id", "size", "source_size", "target", taken, *(["row", "epochs", "part"] if keep else [])]
    return whole.select(*columns).unionByName(partial.select(*columns))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows the mix takes, all their columns: a row for each epoch, then the part.

    The one document at a source's edge that is taken in part keeps its first words.
    """
    mixed = mix(docs, id_col, text_col, keep=True, **how).where("taken > 0")
    copies = F.concat(F.array_repeat("size", F.col("epochs").cast("int")), F.when(F.col("part") > 0, F.array("part")).otherwise(F.array()))
    each = mixed.select("row", "size", F.explode(copies).alias("words"))
    text = F.col(f"row.`{text_col}`")
    # Words with the white space before them, so that the part keeps the text's own spacing.
    spaced = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    part = F.array_join(F.slice(spaced, F.lit(1), F.col("words").cast("int")), "")
    cut = F.when(F.col("words") >= F.col("size"), text).otherwise(part)
    return each.select(*[(cut if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
         / (0.1::DOUBLE + (greatest(length(coalesce(text, '')), 1)
            - (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '%$&*#!|', ''))))::DOUBLE
            / greatest(length(coalesce(text, '')), 1)::DOUBLE) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::BIGINT AS w FROM d GROUP BY source),
f AS (SELECT *, sum(source_size) OVER ()::BIGINT AS total, row_number() OVER o AS k,
             coalesce(sum(source_size) OVER p, 0)::BIGINT AS size_before,
             (sum(w) OVER () - coalesce(sum(w) OVER p, 0))::BIGINT AS w_left
      FROM s WINDOW o AS (ORDER BY source_size::DOUBLE / w::DOUBLE, source IS NULL, source),
             p AS (ORDER BY source_size::DOUBLE / w::DOUBLE, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, (SELECT min(k) FROM f WHERE w * (total - 3 * size_before) <= 3 * source_size * w_left) AS first FROM f),
t AS (SELECT source, source_size, CASE WHEN k < first THEN (3 * source_size)::DOUBLE
        ELSE (w * (SELECT total - 3 * size_before FROM g WHERE k = first))::DOUBLE / (SELECT w_left FROM g WHERE k = first)::DOUBLE END AS target FROM g),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(round(target)::BIGINT / source_size))::BIGINT ELSE 0 END AS epochs FROM t),
r AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, round(e.target)::BIGINT - e.epochs * e.source_size AS rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM r
"""
