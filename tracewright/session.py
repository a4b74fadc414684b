"""Session settings that the plans of this package are made for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Cleaning some twenty text columns makes one very large generated method, which the JVM would only
    # interpret; beyond this size Spark generates smaller methods per operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "snappy",
    # Small sets per case stay in the hash table; the default turns to sorting after 128 keys.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings to a session builder. Partition counts are left to the cluster."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
