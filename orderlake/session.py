"""Session settings that the jobs are meant to run with.

The library never changes a running session. These are for the code that builds one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Order documents make wide projections. HotSpot does not compile methods over 8000 bytes;
    # above that size Spark's own split code is faster than one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Joins on order, email or currency rely on these to split partitions with a hot key.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
