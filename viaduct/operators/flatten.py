"""Flatten a bronze document into the silver trip columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# payload field -> (silver name, silver type); fixed names of the trip schema.
TRIP_FIELDS = (
    ("VendorID", "id_operador", T.IntegerType()),
    ("tpep_pickup_datetime", "ts_inicio", T.TimestampType()),
    ("tpep_dropoff_datetime", "ts_fin", T.TimestampType()),
    ("trip_distance", "distancia_millas", T.DoubleType()),
    ("PULocationID", "id_zona_origen", T.IntegerType()),
    ("DOLocationID", "id_zona_destino", T.IntegerType()),
    ("passenger_count", "n_pasajeros", T.IntegerType()),
    ("total_amount", "importe_total", T.DoubleType()),
)
# Doubles whose NaN is kept: the distance rule must see a NaN distance.
KEEP_NAN = {"distancia_millas"}


def _conform(c: Column, found: T.DataType, dtype: T.DataType, keep_nan: bool) -> Column:
    out = c.try_cast(dtype)
    if isinstance(found, T.StringType) and isinstance(dtype, T.IntegerType):
        # Text of a source that holds the integer as a double ("1.0").
        out = F.coalesce(out, c.try_cast(T.DoubleType()).try_cast(dtype))
    if isinstance(dtype, T.DoubleType) and not keep_nan:
        out = F.when(~F.isnan(out), out)
    return out


def flatten_documents(docs: DataFrame) -> DataFrame:
    """One row per trip: typed trip fields + hash and source file.

    Raw values never raise: malformed text, NaN to int and overflow become
    NULL (``try_cast``), and a NaN amount becomes NULL.
    """
    payload_type = docs.schema["payload"].dataType
    present = set(payload_type.fieldNames())
    cols = []
    for src, dst, dtype in TRIP_FIELDS:
        if src in present:
            cols.append(_conform(F.col("payload").getField(src), payload_type[src].dataType, dtype, dst in KEEP_NAN).alias(dst))
        else:
            cols.append(F.lit(None).cast(dtype).alias(dst))
    cols += [
        F.col("_ingesta.hash_registro").alias("hash_registro"),
        F.col("_ingesta.fichero_origen").alias("fichero_origen"),
    ]
    return docs.select(*cols)
