"""Content hash of a record.

The canonical text of a record lists its fields in name order as
``name=length:value`` joined by ``|``. The length prefix makes the text
unambiguous whatever a value holds. A field that is NULL or that the record's
file doesn't have is left out, so the hash depends on the record alone, not on
what is loaded with it. Distinct values give distinct text: integers, strings,
decimals and dates as they are, doubles as their round-trip text, timestamps as
ISO 8601 with microseconds where there are any. The hash is the first 32 hex
characters of the SHA-256 of that text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_HEX_CHARS = 32
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_text(c: Column) -> Column:
    """ISO 8601 text of a timestamp; the fraction only where it isn't zero.

    One pattern is formatted for each value: formatting costs more than all else of a row.
    """
    return F.replace(F.date_format(c, ISO_MICROS), F.lit(".000000"), F.lit(""))


def value_text(c: Column, dtype: T.DataType) -> Column:
    """Lossless text of one value; NULL stays NULL."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c)
    if isinstance(dtype, T.FloatType):
        return c.cast("double").cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.hex(c)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def canonical_text(fields: list[tuple[str, Column, T.DataType]]) -> Column:
    parts = []
    for name, column, dtype in sorted(fields, key=lambda f: f[0]):
        text = value_text(column, dtype)
        parts.append(F.concat(F.lit(f"{name}="), F.length(text).cast("string"), F.lit(":"), text))
    return F.concat_ws("|", *parts)


def content_hash(fields: list[tuple[str, Column, T.DataType]]) -> Column:
    """SHA-256 prefix of the canonical text of ``fields``."""
    return F.substring(F.sha2(canonical_text(fields), 256), 1, HASH_HEX_CHARS)


def struct_hash(struct_col: str, struct_type: T.StructType) -> Column:
    """Content hash of every field of a struct column (the whole payload)."""
    base = F.col(struct_col)
    return content_hash([(f.name, base.getField(f.name), f.dataType) for f in struct_type.fields])
