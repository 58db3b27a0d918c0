"""Catalog table scan."""

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog by `database.table`; same plan as `select * from` it."""
    return spark.table(name)
