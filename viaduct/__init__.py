"""viaduct: a Spark-native trip telemetry warehouse.

Raw trip records become nested bronze documents with lineage, are checked by
ordered quality rules, de-duplicated by content hash, enriched with corridor
KPIs and zone geometry, conformed to a typed star schema and answered by a set
of star-schema queries. Every step is a lazy ``DataFrame -> DataFrame``
function built from Spark SQL expressions; only writers and reports act.
"""

__version__ = "0.1.0"
